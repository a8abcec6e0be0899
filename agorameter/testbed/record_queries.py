"""Queries that bring collected records into their flat form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorameter.functions import text, time
from agorameter.operators import normalize
from agorameter.schemas import FACEBOOK, POSTS_SECTION
from agorameter.sources import tables
from agorameter.testbed import inputs, sql
from agorameter.testbed.registry import register


@register(
    """SELECT 'Posts' AS section, 'doc-' || doc_id AS uuid, CAST(NULL AS VARCHAR) AS post_id,
              CAST(n_chars % 101 AS INTEGER) AS "like" FROM documents
       UNION ALL
       SELECT 'Comments_with_candidate_column', conv_id || '-' || turn, 'doc-' || (conv_id * 15),
              CAST(length(text) % 101 AS INTEGER) FROM conversations"""
)
def union_inputs(spark, folder):
    post_rows = normalize.tag(inputs.posts_table(spark, folder), FACEBOOK, POSTS_SECTION)
    comment_rows = normalize.tag(
        inputs.comments_table(spark, folder), FACEBOOK, "Comments_with_candidate_column"
    )
    return tables.union_inputs(post_rows, comment_rows).select("section", "uuid", "post_id", "like")


@register("SELECT doc_id, source, 'facebook' AS social, 'Posts' AS section FROM documents")
def tag_records(spark, folder):
    df = inputs.table(spark, folder, "documents").select("doc_id", "source")
    return normalize.tag(df, FACEBOOK, POSTS_SECTION)


@register(
    """SELECT event_id, CASE WHEN microsecond(ts) % 1000000 = 0
                             THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                             ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS ts,
              value, strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%S') AS minute
       FROM events"""
)
def iso_timestamps(spark, folder):
    df = inputs.table(spark, folder, "events").select(
        "event_id", "ts", "value", F.date_trunc("minute", "ts").alias("minute")
    )
    return normalize.iso_datetimes(df)


@register(
    "SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS moment FROM events"
)
def epoch_strings(spark, folder):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return inputs.table(spark, folder, "events").select(
        "event_id", time.epoch_iso_string(seconds).alias("moment")
    )


@register("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS published FROM orders")
def utc_strings(spark, folder):
    return inputs.table(spark, folder, "orders").select(
        "o_orderkey", time.utc_string("o_orderdate").alias("published")
    )


@register(
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view')
                             THEN event_id % 100
                             WHEN event_type = 'signup' THEN 3000000000 + event_id
                             ELSE 0 END AS votes FROM events"""
)
def votes_parse(spark, folder):
    kind = F.col("event_type")
    raw = (
        F.when(kind.isin("click", "view"), (F.col("event_id") % 100).cast("string"))
        .when(kind == "error", "")
        .when(kind == "purchase", "1.2K")
        .when(kind == "signup", (F.lit(3_000_000_000) + F.col("event_id")).cast("string"))
    )
    return inputs.table(spark, folder, "events").select(
        "event_id", text.parse_votes(raw).alias("votes")
    )


@register("SELECT doc_id, replace(lower(text), chr(10), ' ') AS fullText FROM documents")
def transcript_join(spark, folder):
    """Lines as transcript segments."""
    segments = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("text")))
    full_text = text.transcript(segments).alias("fullText")
    return inputs.documents(spark, folder).select("doc_id", full_text)


_FLAT_VIDEO_COLUMNS = (
    "channel, channel_bias, state, url_video, id_video, title, timestamp AS video_timestamp, "
)


@register(
    f"""SELECT {_FLAT_VIDEO_COLUMNS} video_likes, views, 'youtube' AS social,
               comment_id AS comment_cid, comment_published_at, comment_author, comment_text,
               comment_votes FROM ({sql.VIDEO_COMMENTS})"""
)
def flatten_comments(spark, folder):
    return normalize.flatten_comments(inputs.raw_videos(spark, folder))


FLAT_VIDEOS_SQL = f"""SELECT {_FLAT_VIDEO_COLUMNS} fullText, video_likes, views, comments,
                          'youtube' AS social FROM ({sql.VIDEOS})"""


@register(FLAT_VIDEOS_SQL)
def flatten_videos(spark, folder):
    return normalize.flatten_videos(inputs.raw_videos(spark, folder))


_LABELLED = """SELECT d.doc_id, l.quality, CASE WHEN l.quality = 1 THEN text END AS fullText
               FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def _labelled(spark, folder) -> DataFrame:
    """documents as videos whose transcript is there only for good quality."""
    labels = inputs.table(spark, folder, "labels").select("doc_id", "quality")
    joined = inputs.documents(spark, folder).join(labels, "doc_id", "left")
    return joined.select(
        F.col("doc_id").alias("id_video"),
        F.when(F.col("quality") == 1, F.col("text")).alias("fullText"),
    )


@register(f"SELECT doc_id AS id_video, fullText FROM ({_LABELLED}) WHERE fullText IS NOT NULL")
def usable_videos(spark, folder):
    return normalize.usable_videos(_labelled(spark, folder))


@register(f"SELECT doc_id AS id_video FROM ({_LABELLED}) WHERE fullText IS NULL")
def failed_videos(spark, folder):
    return normalize.failed_videos(_labelled(spark, folder)).select("id_video")


@register(
    """SELECT doc_id, 'Harbour9' AS channel, 'SIDE_B' AS channel_bias, 'QX' AS state
       FROM documents"""
)
def channel_constants(spark, folder):
    df = inputs.table(spark, folder, "documents").select("doc_id")
    return normalize.with_channel(df, "Harbour9", "QX", "SIDE_B")


@register(
    f"""SELECT c_custkey, 'NATION_' || c_nationkey AS channel, channel_bias, state FROM customer
        LEFT JOIN ({sql.CHANNELS}) ON channel = 'NATION_' || c_nationkey"""
)
def channel_metadata(spark, folder):
    rows = inputs.table(spark, folder, "customer").select(
        "c_custkey", F.concat(F.lit("NATION_"), "c_nationkey").alias("channel")
    )
    return normalize.with_channel_metadata(rows, inputs.channels(spark, folder))
