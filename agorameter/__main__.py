"""Command line: ``python -m agorameter flatten | ingest | enrich``.

Run it with ``spark-submit`` on a cluster; the session takes its resources from there.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorameter.functions.lexicon import default_scorer
from agorameter.functions.models import tweet_scorer
from agorameter.operators.normalize import (
    failed_videos,
    flatten_comments,
    flatten_videos,
    usable_videos,
)
from agorameter.plans.enrich import enrich
from agorameter.plans.ingest import ingest, with_reject_topic
from agorameter.schemas import COMMENTS_SECTION, DATASETS, POSTS_SECTION, RAW_VIDEO
from agorameter.session import build_session, remove_folder, shared_folder
from agorameter.sinks.files import write_channel_files
from agorameter.sinks.topics import write_topic_files, write_topics
from agorameter.sources.files import (
    FORMS,
    INDENTED,
    read_flat_comments,
    read_flat_videos,
    read_json_marked,
)
from agorameter.sources.tables import (
    hash_predicates,
    jdbc_options,
    prefix_ranges,
    read_exported_table,
    read_jdbc_table,
    sampled_ranges,
)
from agorameter.sources.topics import stream_topic, stream_topic_files
from agorameter.streaming import jobs, latest


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="agorameter", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    flatten = commands.add_parser("flatten", help="nested video files to flat records")
    flatten.add_argument("--raw", required=True, help="files of collected videos")
    flatten.add_argument("--videos", required=True, help="output folder of flat videos")
    flatten.add_argument("--video-comments", required=True, help="output folder of comments")
    flatten.add_argument("--form", choices=FORMS, default=INDENTED, help="form of the raw files")
    flatten.add_argument("--rejects", help="folder for unreadable records and failed videos; "
                         "without it an unreadable record fails the job")

    ingest = commands.add_parser("ingest", help="tables and flat records to topics")
    ingest.add_argument("--jdbc-url", help="database of the two tables")
    ingest.add_argument("--jdbc-parts", type=int, default=16, help="parallel table reads")
    ingest.add_argument("--posts", default=POSTS_SECTION, help="table name, or export folder")
    ingest.add_argument("--post-comments", default=COMMENTS_SECTION, help="the same for comments")
    ingest.add_argument("--videos", required=True)
    ingest.add_argument("--video-comments", required=True)
    ingest.add_argument("--form", choices=FORMS, default=INDENTED, help="form of the video files")
    ingest.add_argument("--rejects", default="rejects", help="topic for records that fit no other")
    split = ingest.add_mutually_exclusive_group()
    split.add_argument("--jdbc-hash", action="store_true",
                       help="split tables by a hash of the key, not by sampled ranges of it")
    split.add_argument("--jdbc-prefix", action="store_true",
                       help="split tables by ranges of keys that are random hexadecimal digits")

    enrich = commands.add_parser("enrich", help="topics to enriched records")
    enrich.add_argument("--dataset", action="append", choices=sorted(DATASETS), required=True)
    enrich.add_argument("--checkpoint", required=True, help="folder on shared storage")
    enrich.add_argument("--interval", help="keep running with this interval, e.g. '1 minute'")
    enrich.add_argument("--model", action="store_true", help="use the tweet classifiers")
    enrich.add_argument("--max-errors", type=float, default=0.05,
                        help="share of failed model calls in new records above which it ends")
    enrich.add_argument("--max-files", type=int, help="most topic files in one batch")
    enrich.add_argument("--max-offsets", type=int, help="most messages of a topic in one batch")
    enrich.add_argument("--min-partitions", type=int, help="split topics into more tasks")
    output = enrich.add_mutually_exclusive_group(required=True)
    output.add_argument("--out", help="folder for the enriched tables")
    output.add_argument("--search", help="nodes of the search store")
    enrich.add_argument("--search-port", type=int, default=9200)
    versions = enrich.add_mutually_exclusive_group()
    versions.add_argument("--latest", action="store_true",
                          help="keep only the latest version of each record; needs --out")
    versions.add_argument("--distinct", metavar="DELAY",
                          help="drop records that are repeated within this time, e.g. '1 day'")
    enrich.add_argument("--buckets", type=int, default=64,
                        help="buckets of a table of latest versions; fixed by its first batch")

    for command in (ingest, enrich):
        topics = command.add_mutually_exclusive_group(required=True)
        topics.add_argument("--servers", help="message broker")
        topics.add_argument("--topics", help="folder of topic files")
        command.add_argument("--topic-prefix", default="", help="put before dataset names")
    return parser


def run_flatten(spark: SparkSession, args: argparse.Namespace) -> None:
    """The files are read and parsed once, into a table that all outputs read."""
    stage = shared_folder(spark, "flatten")
    found = read_json_marked(spark, args.raw, RAW_VIDEO, args.form, long_counts=True)
    if not args.rejects:
        told = F.concat(
            F.lit(f"not a record of form {args.form} in "), "file", F.lit(": "), F.substring("raw", 1, 200)
        )
        reason = F.when(F.col("reason").isNotNull(), F.raise_error(told).cast("string"))
        found = found.withColumn("reason", reason)
    found.write.parquet(stage)
    staged = spark.read.schema(found.schema).parquet(stage)
    records = staged.where("reason IS NULL").select("data.*")
    if args.rejects:
        reason = F.lit("extraction failed").alias("reason")
        raw = F.to_json(F.struct(*records.columns)).alias("raw")
        failed = failed_videos(records).select(reason, raw)
        unreadable = staged.where("reason IS NOT NULL").select("file", "reason", "raw")
        rejects = unreadable.unionByName(failed, allowMissingColumns=True)
        rejects.write.mode("overwrite").parquet(args.rejects)
    videos = usable_videos(records)
    write_channel_files(flatten_videos(videos), args.videos)
    write_channel_files(flatten_comments(videos), args.video_comments)
    remove_folder(spark, stage)


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    def table(name: str) -> DataFrame:
        if args.jdbc_url:
            hashed = hash_predicates("uuid", args.jdbc_parts)
            if args.jdbc_hash:
                parts = hashed
            elif args.jdbc_prefix:
                parts = prefix_ranges("uuid", args.jdbc_parts)
            else:
                column = jdbc_options(args.jdbc_url, f"(SELECT uuid FROM {name}) AS listed")
                parts = sampled_ranges(read_jdbc_table(spark, column, hashed), "uuid", args.jdbc_parts)
            return read_jdbc_table(spark, jdbc_options(args.jdbc_url, name), parts)
        return read_exported_table(spark, name)

    messages = ingest(
        table(args.posts),
        table(args.post_comments),
        read_flat_videos(spark, args.videos, args.form, long_counts=True),
        read_flat_comments(spark, args.video_comments, args.form, long_counts=True),
        names={name: args.topic_prefix + name for name in DATASETS},
    )
    messages = with_reject_topic(messages, args.topic_prefix + args.rejects)
    if args.servers:
        write_topics(messages, args.servers)
    else:
        write_topic_files(messages, args.topics)


def run_enrich(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.latest and not args.out:
        raise SystemExit("--latest needs --out")
    scorer = tweet_scorer() if args.model else default_scorer()
    trigger = args.interval or jobs.AVAILABLE_NOW
    limit = {"maxOffsetsPerTrigger": str(args.max_offsets)} if args.max_offsets else {}

    def start(name: str):
        topic = args.topic_prefix + name
        if args.servers:
            messages = stream_topic(
                spark, args.servers, topic, min_partitions=args.min_partitions, **limit
            )
        else:
            messages = stream_topic_files(spark, args.topics, topic, args.max_files)
        records = enrich(messages, DATASETS[name], scorer, errors=args.model, long_counts=True)
        checkpoint = f"{args.checkpoint}/{name}"
        if args.model:
            records = jobs.with_call_counts(records)
        if args.distinct:
            records = jobs.without_repeats(records, DATASETS[name].key, args.distinct)
        if args.latest:
            key, *version = DATASETS[name].key
            write = latest.latest_writer(f"{args.out}/{name}", key, *version, buckets=args.buckets)
            return jobs.start_batch_sink(records, write, checkpoint, trigger, name)
        if args.out:
            return jobs.start_table_sink(
                records, f"{args.out}/{name}", checkpoint, trigger, name=name
            )
        options = jobs.search_options(args.search, args.search_port)
        return jobs.start_search_sink(
            records, topic, checkpoint, options, trigger, name, key=DATASETS[name].key
        )

    starters = [lambda name=name: start(name) for name in args.dataset]
    limit_of_errors = jobs.CallLimit(args.max_errors) if args.model else None
    (jobs.run_together if args.interval else jobs.run_in_turn)(starters, limit_of_errors)


RUN = {"flatten": run_flatten, "ingest": run_ingest, "enrich": run_enrich}


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    RUN[args.command](build_session(f"agorameter {args.command}"), args)


if __name__ == "__main__":
    main()
