"""Queries on messages."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from agorameter.operators import messages
from agorameter.schemas import VIDEOS
from agorameter.testbed import inputs, sql
from agorameter.testbed.registry import register


@register("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def parse_json(spark, folder):
    merged = F.concat(F.lit('{"event_id":'), "event_id", F.lit(","), F.substring("props", 2, 1 << 20))
    sent = inputs.table(spark, folder, "events").select(merged.cast("binary").alias("value"))
    return messages.parse_messages(sent, StructType.fromDDL("event_id bigint, k int"))


@register(
    f"""SELECT event_id, social, section, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts
        FROM ({sql.EVENT_TAGS})"""
)
def decode_messages(spark, folder):
    schema = StructType.fromDDL("event_id bigint, social string, section string, ts string")
    parsed = messages.parse_messages(inputs.event_messages(spark, folder), schema)
    # Times with a zero fraction have no digits after the second.
    fraction = F.when(F.length("ts") == 19, F.concat("ts", F.lit(".000000"))).otherwise(F.col("ts"))
    return parsed.withColumn("ts", fraction)


@register(
    """SELECT event_id, substring(props, 1, length(props) - 1) AS _corrupt_record
       FROM events WHERE event_type = 'error'"""
)
def malformed_messages(spark, folder):
    """The messages of one kind lack their closing brace."""
    cut = F.expr("substring(props, 1, length(props) - 1)")
    sent = F.when(F.col("event_type") == "error", cut).otherwise(F.col("props"))
    rows = inputs.table(spark, folder, "events").select(
        "event_id", sent.cast("binary").alias("value")
    )
    return messages.malformed_messages(rows, StructType.fromDDL("k int")).drop("value")


@register(
    """SELECT event_id, event_type,
              CASE event_type WHEN 'click' THEN '59'
                   WHEN 'view' THEN CAST(event_id % 1000 AS VARCHAR) END AS views,
              CASE event_type WHEN 'click' THEN '59' WHEN 'signup' THEN '3000000000'
                   WHEN 'view' THEN CAST(event_id % 1000 AS VARCHAR) END AS long_views
       FROM events"""
)
def strict_counters(spark, folder):
    """A counter of another type, or too large for it, becomes NULL; the row stays."""
    kind = F.col("event_type")
    views = (
        F.when(kind == "click", "59")
        .when(kind == "error", '"59"')
        .when(kind == "purchase", "59.0")
        .when(kind == "signup", "3000000000")
        .otherwise((F.col("event_id") % 1_000).cast("string"))
    )
    events = inputs.table(spark, folder, "events").withColumn(
        "value", F.concat(F.lit('{"views":'), views, F.lit("}"))
    )
    return events.select(
        "event_id",
        "event_type",
        F.from_json("value", "views int")["views"].cast("string").alias("views"),
        F.from_json("value", "views bigint")["views"].cast("string").alias("long_views"),
    )


@register(
    f"""SELECT timestamp, channel, channel_bias, state, title, url_video, id_video, views,
               video_likes, comments FROM ({sql.VIDEOS})"""
)
def select_video_columns(spark, folder):
    parsed = messages.parse_messages(inputs.video_messages(spark, folder), VIDEOS.message)
    return messages.select_renamed(parsed, VIDEOS.columns, dict(VIDEOS.renames))
