"""Queries that write files or topics and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from agorameter.functions.text import parse_votes
from agorameter.operators import messages, normalize, route
from agorameter.schemas import FLAT_VIDEO, VIDEO_COMMENTS, with_long_counts
from agorameter.session import shared_folder
from agorameter.sinks import files as file_sinks
from agorameter.sinks import topics as topic_sinks
from agorameter.sources import files, tables, topics
from agorameter.testbed import inputs, sql
from agorameter.testbed.record_queries import FLAT_VIDEOS_SQL
from agorameter.testbed.registry import register


@register(sql.ROUTE_COUNTS)
def topic_files(spark, folder):
    """Messages sent to topic files and read back."""
    path = shared_folder(spark, "topics")
    routed = route.routed(route.route_messages(inputs.event_messages(spark, folder)))
    topic_sinks.write_topic_files(routed.withColumn("key", F.lit(None).cast("binary")), path)
    return topics.read_topic_files(spark, path).groupBy("topic").agg(F.count("*").alias("records"))


@register(FLAT_VIDEOS_SQL)
def channel_files(spark, folder):
    """Flat videos written per channel and read back."""
    path = shared_folder(spark, "videos")
    file_sinks.write_channel_files(normalize.flatten_videos(inputs.raw_videos(spark, folder)), path)
    return files.read_flat_videos(spark, path, files.LINES)


_NESTED_SQL = f"""SELECT id_video, channel, CAST(count(*) AS BIGINT) AS comments,
               CAST(sum(comment_votes) AS BIGINT) AS votes
        FROM ({sql.VIDEO_COMMENTS}) GROUP BY ALL"""


def _comments_and_votes(videos):
    return normalize.flatten_comments(videos).groupBy("id_video", "channel").agg(
        F.count("*").alias("comments"), F.sum("comment_votes").alias("votes")
    )


@register(_NESTED_SQL)
def nested_files(spark, folder):
    """Nested videos written as files, read back and flattened."""
    path = shared_folder(spark, "raw-videos")
    inputs.raw_videos(spark, folder).write.json(path)
    return _comments_and_votes(files.read_raw_videos(spark, path, files.LINES))


def _write_arrays(videos, record, separator, path) -> None:
    """Arrays of some fifty records, each in a file of its own."""
    body = F.array_join(F.collect_list(record), "," + separator)
    arrays = videos.groupBy(F.floor(F.col("id_video").cast("long") / 50)).agg(body.alias("body"))
    value = F.concat(F.lit("[" + separator), "body", F.lit(separator + "]"))
    arrays.select(value.alias("value")).write.option("maxRecordsPerFile", 1).text(path)


@register(_NESTED_SQL)
def array_files(spark, folder):
    """Files of one array without line ends."""
    path, videos = shared_folder(spark, "arrays"), inputs.raw_videos(spark, folder)
    _write_arrays(videos, F.to_json(F.struct(*videos.columns)), "", path)
    return _comments_and_votes(files.read_raw_videos(spark, path, files.ARRAY))


@register(_NESTED_SQL)
def indented_files(spark, folder):
    """Files of one array with an indent of four blanks."""
    path, videos = shared_folder(spark, "indented"), inputs.raw_videos(spark, folder)

    def field(name):
        value = F.regexp_replace(F.to_json(F.array(name)), r"\A\[|\]\z", "")
        return F.concat(F.lit(f'        "{name}": '), value)

    fields = F.array_join(F.array(*[field(c) for c in videos.columns]), ",\n")
    record = F.concat(F.lit("    {\n"), fields, F.lit("\n    }"))
    _write_arrays(videos, record, "\n", path)
    return _comments_and_votes(files.read_raw_videos(spark, path))


@register(
    """SELECT CAST(doc_id AS VARCHAR) AS id_video,
              CASE WHEN doc_id % 7 = 3 THEN 'not JSON' END AS reason,
              CASE WHEN doc_id % 7 <> 3 THEN 'part' END AS channel,
              CASE WHEN doc_id % 7 <> 3 THEN 3000000000 + doc_id END AS views
       FROM documents"""
)
def file_rejects(spark, folder):
    """Line files with damaged records: the others are read, with large counters."""
    path = shared_folder(spark, "damaged")
    doc_id = F.col("doc_id")
    views = (F.lit(3_000_000_000) + doc_id).alias("views")
    record = F.to_json(F.struct(doc_id.cast("string").alias("id_video"), views))
    damaged = F.expr("substring(value, 1, length(value) - 1)")
    sent = inputs.documents(spark, folder).select("doc_id", record.alias("value"))
    sent.select(F.when(doc_id % 7 == 3, damaged).otherwise(F.col("value"))).write.text(path)
    read = files.read_json_records(
        spark, path, FLAT_VIDEO, files.LINES, strict=False, long_counts=True
    )
    kept = files.with_file_channel(read).select("id_video", "channel", "views")
    rejects = files.read_json_rejects(spark, path, files.LINES).select(
        F.regexp_extract("raw", '"id_video":"([0-9]+)"', 1).alias("id_video"), "reason"
    )
    return kept.unionByName(rejects, allowMissingColumns=True)


@register(
    """SELECT event_id, 3000000000 + event_id AS views, 3000000000 + 2 * event_id AS comment_votes
       FROM events"""
)
def long_counters(spark, folder):
    """Counters beyond 32 bits through a reader, a message and the vote parser."""
    path = shared_folder(spark, "counters")
    large = F.lit(3_000_000_000) + F.col("event_id")
    fields = (
        F.col("event_id").cast("string").alias("comment_cid"),
        large.alias("views"),
        parse_votes((large + F.col("event_id")).cast("string")).alias("comment_votes"),
    )
    inputs.table(spark, folder, "events").select(*fields).write.json(path)
    read = files.read_flat_comments(spark, path, files.LINES, long_counts=True)
    sent = messages.to_messages(read, F.lit("yt_comments"))
    parsed = messages.parse_messages(sent, with_long_counts(VIDEO_COMMENTS.message))
    return parsed.select(
        F.col("comment_cid").cast("long").alias("event_id"), "views", "comment_votes"
    )


@register("SELECT url FROM pages")
def link_files(spark, folder):
    """Links written with stray blanks, read back stripped."""
    path = shared_folder(spark, "links")
    padded = F.concat(F.lit(" \t"), "url", F.lit("  "))
    file_sinks.write_links(inputs.table(spark, folder, "pages").select(padded.alias("url")), path)
    return files.read_links(spark, path)


@register('SELECT uuid, candidate, "like", love FROM (' + sql.POSTS + ")")
def exported_table(spark, folder):
    """The posts table exported and read back whole."""
    path = shared_folder(spark, "export")
    inputs.posts_table(spark, folder).write.parquet(path)
    return tables.read_exported_table(spark, path).select("uuid", "candidate", "like", "love")


@register(_NESTED_SQL)
def split_arrays(spark, folder):
    """One array per file without line ends, each file read in parts by several tasks."""
    path, videos = shared_folder(spark, "split"), inputs.raw_videos(spark, folder)
    _write_arrays(videos, F.to_json(F.struct(*videos.columns)), " ", path)
    found = _comments_and_votes(files.read_raw_videos(spark, path, files.SPLIT))
    return found
