"""Trends over a stream of enriched records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorameter.functions.time import event_time
from agorameter.schemas import SENTIMENTS


def with_event_time(df: DataFrame, time: str, delay: str) -> DataFrame:
    """Add a typed ``event_time`` and accept records up to ``delay`` late."""
    return df.withColumn("event_time", event_time(time)).withWatermark("event_time", delay)


def unreadable_times(df: DataFrame, time: str = "timestamp") -> DataFrame:
    """The records that no window of :func:`streaming_trend` holds, as their time is unreadable.

    No watermark ever passes them, so they are an output of their own, for example of
    ``start_table_sink``.
    """
    return df.filter(event_time(time).isNull())


def streaming_trend(
    df: DataFrame,
    dimensions: Sequence[str],
    time: str = "timestamp",
    window: str = "1 day",
    delay: str = "1 day",
) -> DataFrame:
    """Records, mean probabilities per window and dimension values, for append output.

    A window is written once, when the watermark has passed its end. State is one row
    per open window and dimension value, not per record.
    """
    return (
        with_event_time(df, time, delay)
        .groupBy(F.window("event_time", window).alias("window"), *dimensions)
        .agg(
            F.count("*").alias("records"),
            *[F.avg(F.col(x).cast("double")).alias(f"mean_{x}") for x in SENTIMENTS],
        )
        .select(F.col("window.start").alias("bucket"), *dimensions, "records",
                *[f"mean_{x}" for x in SENTIMENTS])
    )
