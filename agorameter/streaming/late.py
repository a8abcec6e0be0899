"""A trend over a stream that loses no record: what comes too late is a second output.

Records go through two stateful operators in a row: repeats are dropped, then windows are
counted, and both drop what lies behind the watermark. The same query also hands on what
arrived and what was accepted. What arrived, was not accepted and has not been accepted before
came too late, so the windows and the late records together hold each record once:

    <path>/trend/_batch=<n>/…            windows that closed with batch n
    <path>/accepted/_batch=<n>/_day=…/   keys that windows count, by the day of their time
    <path>/late/_batch=<n>/…             records that no window counts, with the reason

A batch that is repeated replaces its own folders and reads those of earlier batches only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from agorameter.functions.time import event_time
from agorameter.schemas import SENTIMENTS
from agorameter.streaming.latest import BATCH

TIME, DAY = "event_time", "_day"
ARRIVED, ACCEPTED, WINDOW = "arrived", "accepted", "window"
LATE, NO_KEY, NO_TIME = "late", "no key", "no time"
#: Files of a day that a batch writes, at most, so that a batch of one day has several tasks.
DAY_FILES = 4


def _means() -> list[Column]:
    return [F.avg(F.col(x).cast("double")).alias(f"mean_{x}") for x in SENTIMENTS]


def trend_and_arrivals(
    df: DataFrame,
    key: Sequence[str],
    dimensions: Sequence[str],
    time: str = "timestamp",
    window: str = "1 day",
    delay: str = "1 day",
) -> DataFrame:
    """``kind, record, trend``: records that arrived or were accepted, and closed windows.

    The stream to hand to :func:`late_writer`. Of accepted records only key and time are handed on,
    so each branch shuffles and computes no more than it needs. State is a key per accepted record of the time
    of ``delay``, and a row per open window and dimension value.
    """
    timed = df.withColumn(TIME, event_time(time))
    usable = reduce(and_, [F.col(c).isNotNull() for c in (*key, TIME)])

    def once(*columns: str) -> DataFrame:
        chosen = timed.where(usable).select(*dict.fromkeys([*key, TIME, *columns]))
        return chosen.withWatermark(TIME, delay).dropDuplicatesWithinWatermark(list(key))

    def record(*columns: str) -> Column:
        kinds = {f.name: f.dataType for f in timed.schema}
        fields = [F.col(c) if c in columns else F.lit(None).cast(kinds[c]).alias(c) for c in kinds]
        return F.struct(*fields).alias("record")

    windows = (
        once(*dimensions, *SENTIMENTS)
        .groupBy(F.window(TIME, window).alias("_window"), *dimensions)
        .agg(F.count("*").alias("records"), *_means())
        .select(
            F.struct(
                F.col("_window.start").alias("bucket"),
                *dimensions,
                "records",
                *[f"mean_{x}" for x in SENTIMENTS],
            ).alias("trend")
        )
    )
    parts = [
        timed.select(F.lit(ARRIVED).alias("kind"), record(*timed.columns)),
        once().select(F.lit(ACCEPTED).alias("kind"), record(*key, TIME)),
        windows.select(F.lit(WINDOW).alias("kind"), "trend"),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def late_writer(path: str, key: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """A repeatable batch writer for ``start_batch_sink`` of :func:`trend_and_arrivals`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, keys = batch.sparkSession, list(key)

        def put(df: DataFrame, name: str, *partitions: str) -> None:
            # Else every task writes a file of every day. A stream has no adaptive rebalancing.
            salt = F.pmod(F.xxhash64(*keys), F.lit(DAY_FILES))
            dealt = df.repartition(*partitions, salt) if partitions else df
            writer = dealt.write.mode("overwrite").partitionBy(*partitions)
            writer.parquet(f"{path}/{name}/{BATCH}={batch_id}")

        batch = batch.persist()
        try:
            put(batch.where(F.col("kind") == WINDOW).select("trend.*"), "trend")
            day = F.date_format(TIME, "yyyy-MM-dd").alias(DAY)
            accepted = batch.where(F.col("kind") == ACCEPTED).select("record.*").select(*keys, day)
            put(accepted, "accepted", DAY)
            arrived = batch.where(F.col("kind") == ARRIVED).select("record.*").withColumn(DAY, day)
            reason = F.when(reduce(and_, [F.col(c).isNotNull() for c in keys]), None).otherwise(NO_KEY)
            reason = F.coalesce(reason, F.when(F.col(TIME).isNull(), NO_TIME))
            apart = arrived.withColumn("reason", reason)
            # Repeats of one batch are one record.
            rest = (
                apart.where("reason IS NULL")
                .join(accepted, [*keys, DAY], "left_anti")
                .dropDuplicates(keys)
                .withColumn("reason", F.lit(LATE))
            )
            days = [r[0] for r in rest.select(DAY).distinct().collect()]
            for name in ("accepted", "late"):
                # Of what was counted before, only the days of these records are read.
                before = _before(spark, f"{path}/{name}", batch_id)
                if before is not None and days:
                    met = before.where(F.col(DAY).isin(days)).select(*keys, DAY)
                    rest = rest.join(met, [*keys, DAY], "left_anti")
            put(rest.unionByName(apart.where("reason IS NOT NULL")), "late", DAY)
        finally:
            batch.unpersist()

    return write


def _before(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """What earlier batches wrote; None where they wrote nothing."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise
    if DAY not in found.columns:
        return None
    return found.where(F.col(BATCH) < batch_id).withColumn(DAY, F.col(DAY).cast("string"))


def read_late(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The records that no window counts, with ``event_time`` and ``reason``; none gives an empty table."""
    wide = StructType(list(schema.fields)).add(TIME, "timestamp").add("reason", "string")
    return spark.read.schema(wide).parquet(f"{path}/late").select(*wide.names)
