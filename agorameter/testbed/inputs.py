"""The given tables in the shapes the operators read.

documents stand in for posts and collected videos, conversations for post comments,
events for mixed messages, nation and region for the channel metadata. Every column is
derived row by row, so the inputs grow with the tables and need no grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agorameter.functions.text import expand_once, watch_url
from agorameter.functions.time import epoch_iso_string
from agorameter.operators.messages import to_messages
from agorameter.operators.normalize import (
    flatten_comments,
    flatten_videos,
    iso_datetimes,
    tag,
    with_channel_metadata,
)
from agorameter.schemas import (
    COMMENTS_SECTION,
    FACEBOOK,
    POSTS_SECTION,
    REACTIONS,
    YOUTUBE,
)
from agorameter.session import spread

#: 2024-09-01 00:00:00 UTC, the start of the stand-in times.
START = 1_725_148_800
#: Divisors that turn a text length into seven different counters.
COUNTERS = dict(zip(REACTIONS, (101, 53, 31, 17, 13, 11, 7)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"))


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "conversations"))


def _reactions(size: Column) -> list[Column]:
    return [(size % d).cast("int").alias(name) for name, d in COUNTERS.items()]


def post_time() -> Column:
    return F.timestamp_seconds(F.lit(START) + (F.col("doc_id") * 86_399) % 12_096_000)


def posts_table(spark: SparkSession, folder: str) -> DataFrame:
    """documents as the relational posts table."""
    return documents(spark, folder).select(
        F.concat(F.lit("doc-"), "doc_id").alias("uuid"),
        F.timestamp_seconds(F.lit(START + 14_000_000) + F.col("doc_id") % 86_400).alias(
            "retrieving_time"
        ),
        post_time().alias("timestamp"),
        F.col("source").alias("candidate"),
        F.col("text").alias("content"),
        *_reactions(F.col("n_chars")),
    )


def comments_table(spark: SparkSession, folder: str) -> DataFrame:
    """conversations as the relational comments table; some belong to no post."""
    return conversations(spark, folder).select(
        F.concat_ws("-", "conv_id", "turn").alias("uuid"),
        F.concat(F.lit("doc-"), F.col("conv_id") * 15).alias("post_id"),
        F.concat(F.lit("src"), F.col("conv_id") % 20).alias("candidate"),
        F.timestamp_seconds(F.lit(START) + F.col("conv_id") * 3_600 + F.col("turn") * 60).alias(
            "timestamp"
        ),
        F.col("role").alias("account"),
        F.col("text").alias("content"),
        *_reactions(F.length("text")),
    )


def channels(spark: SparkSession, folder: str) -> DataFrame:
    """nation and region as channel metadata."""
    region = table(spark, folder, "region")
    nation = table(spark, folder, "nation")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_name").alias("channel"),
        F.col("r_name").alias("channel_bias"),
        F.concat(F.lit("S"), "n_nationkey").alias("state"),
    )


def plain_videos(spark: SparkSession, folder: str) -> DataFrame:
    """documents as collected videos without channel metadata.

    The first line of a text is the title, each further line one comment.
    """
    seconds = F.lit(START) + (F.col("doc_id") * 7_001) % 12_096_000
    lines = F.split("text", "\n")

    def comment(line: Column, i: Column) -> Column:
        return F.struct(
            F.concat_ws("-", "doc_id", i + 1).alias("cid"),
            epoch_iso_string(seconds + (i + 1) * 60).alias("published_at"),
            F.col("source").alias("author"),
            line.alias("text"),
            (F.length(line) % 50).cast("int").alias("votes"),
        )

    return documents(spark, folder).select(
        F.concat(F.lit("NATION_"), F.col("doc_id") % 25).alias("channel"),
        watch_url(F.col("doc_id").cast("string")).alias("url_video"),
        F.col("doc_id").cast("string").alias("id_video"),
        F.element_at(lines, 1).alias("title"),
        epoch_iso_string(seconds).alias("timestamp"),
        (F.col("n_chars") % 1_000).cast("int").alias("likes"),
        (F.col("n_chars") * 37 % 1_000_000).cast("int").alias("views"),
        F.col("text").alias("fullText"),
        F.lit(YOUTUBE).alias("social"),
        expand_once(
            F.struct(
                F.transform(F.slice(lines, F.lit(2), F.size(lines)), comment).alias("comments")
            )
        ),
    )


def raw_videos(spark: SparkSession, folder: str) -> DataFrame:
    """documents as collected videos with nested comments and channel metadata."""
    return with_channel_metadata(plain_videos(spark, folder), channels(spark, folder))


def as_post_messages(posts: DataFrame) -> DataFrame:
    posts = tag(iso_datetimes(posts), FACEBOOK, POSTS_SECTION)
    return to_messages(posts, F.lit("fb_posts"), F.col("uuid"))


def post_messages(spark: SparkSession, folder: str) -> DataFrame:
    return as_post_messages(posts_table(spark, folder))


def comment_messages(spark: SparkSession, folder: str) -> DataFrame:
    comments = tag(iso_datetimes(comments_table(spark, folder)), FACEBOOK, COMMENTS_SECTION)
    return to_messages(comments, F.lit("fb_comments"), F.col("uuid"))


def video_messages(spark: SparkSession, folder: str) -> DataFrame:
    return to_messages(flatten_videos(raw_videos(spark, folder)), F.lit("yt_videos"))


def video_comment_messages(spark: SparkSession, folder: str) -> DataFrame:
    return to_messages(flatten_comments(raw_videos(spark, folder)), F.lit("yt_comments"))


def tagged_events(spark: SparkSession, folder: str) -> DataFrame:
    """events as records of mixed platforms, some untagged, unknown or without a branch."""
    kind, value = F.col("event_type"), F.col("value")
    social = (
        F.when(kind.isin("click", "error", "purchase"), FACEBOOK)
        .when(kind == "signup", YOUTUBE)
        .when(value >= 20, YOUTUBE)
        .when(value >= 10, "elsewhere")
    )
    section = (
        F.when(kind == "click", POSTS_SECTION)
        .when(kind == "error", COMMENTS_SECTION)
        .when(kind == "purchase", "Stories")
    )
    return spread(table(spark, folder, "events")).select(
        "event_id",
        "ts",
        "value",
        social.alias("social"),
        section.alias("section"),
        F.when(kind == "signup", F.col("props")).alias("fullText"),
    )


def event_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The same records as JSON messages, next to their id."""
    records = iso_datetimes(tagged_events(spark, folder))
    body = F.to_json(F.struct(*records.columns))
    return records.select("event_id", body.cast("binary").alias("value"))
