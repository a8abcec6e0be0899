"""Reports that follow a stream, without reading the table again.

A batch changes a report by what entered the table of latest versions and what left it. Both are
reduced to partial aggregates per group, the latter with a minus, and stored as

    <path>/_batch=<n>/…     the change of every group that batch n touched

so a report is the sum of its changes. Sums are decimals: what was added can be taken back
exactly. A repeated batch replaces its own folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agorameter.plans.reports import bucket
from agorameter.schemas import SENTIMENTS
from agorameter.session import remove_folder
from agorameter.streaming.latest import BATCH, SIGN, committed

#: Holds 18 digits before and 12 behind the point.
EXACT = "decimal(30,12)"
#: Folder of the changes that were added up.
FOLDED = "folded"


def _partials() -> list[Column]:
    sign = F.col(SIGN).cast("long")
    return [
        F.sum(sign).alias("records"),
        *[F.sum(F.col(SIGN) * F.col(x).cast("double").cast(EXACT)).cast(EXACT).alias(f"sum_{x}") for x in SENTIMENTS],
        *[
            F.sum(F.when(F.col("sentiment_label") == x, sign).otherwise(0)).alias(f"{x}_records")
            for x in SENTIMENTS
        ],
    ]


def trend_changes(
    path: str, dimensions: Sequence[str], time: str = "timestamp", unit: str = "day"
) -> Callable[[DataFrame, int], None]:
    """What a batch changes in the trend, for the ``changed`` of ``latest_writer``."""

    def write(rows: DataFrame, batch_id: int) -> None:
        groups = rows.groupBy(bucket(time, unit).alias("bucket"), *dimensions).agg(*_partials())
        groups.coalesce(1).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def _added(changes: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    names = [c for c in changes.columns if c == "records" or c.endswith("_records")]
    sums = [f"sum_{x}" for x in SENTIMENTS]
    return changes.groupBy("bucket", *dimensions).agg(
        *[F.sum(c).alias(c) for c in names], *[F.sum(c).cast(EXACT).alias(c) for c in sums]
    )


def read_trend(spark: SparkSession, path: str, table: str, dimensions: Sequence[str]) -> DataFrame:
    """The trend of the latest versions in ``table``, as ``sentiment_trend`` of them gives it.

    Only changes of committed batches count.
    """
    changes = spark.read.parquet(path).join(committed(spark, table), BATCH, "left_semi")
    groups = _added(changes, dimensions).where("records <> 0")
    return groups.select(
        "bucket",
        *dimensions,
        "records",
        *[(F.col(f"sum_{x}") / F.col("records")).cast("double").alias(f"mean_{x}") for x in SENTIMENTS],
        *[f"{x}_records" for x in SENTIMENTS],
    )


def fold_changes(spark: SparkSession, path: str, table: str, dimensions: Sequence[str]) -> None:
    """Put the changes of all committed batches into the folder of the last one.

    Run it while no batch is being written. The sum is written beside the folders first, so a
    failure before they are dropped loses nothing.
    """
    batches = sorted(r[0] for r in committed(spark, table).collect())
    if len(batches) < 2:
        return
    changes = spark.read.parquet(path).join(committed(spark, table), BATCH, "left_semi")
    beside = f"{path.rstrip('/')}-{FOLDED}"
    _added(changes, dimensions).coalesce(1).write.mode("overwrite").parquet(beside)
    last = batches.pop()
    spark.read.parquet(beside).write.mode("overwrite").parquet(f"{path}/{BATCH}={last}")
    for batch in batches:
        remove_folder(spark, f"{path}/{BATCH}={batch}")
    remove_folder(spark, beside)
