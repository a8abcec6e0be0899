"""What the operators share: session preparation, cutting lineage, id filters."""

from __future__ import annotations

import tempfile

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agorameter.session import shipped

#: A batch for Python is bounded by bytes, as one text can be very long.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 * 1024 * 1024),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches, ship the package, and name the checkpoint folder.

    The folder is the one in ``spark.checkpoint.dir``; a temporary one is made only for a
    local session that names none.
    """
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
            base = tempfile.mkdtemp(prefix="agorameter-")
        context.setCheckpointDir(base)
    shipped(spark)
    return spark


def cut(df: DataFrame) -> DataFrame:
    """Compute once into the shared checkpoint folder; later stages and retries read it."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def empty_safe(text: str = "text") -> Column:
    """The text, a missing one as empty."""
    return F.coalesce(F.col(text), F.lit(""))


#: Slots of an id filter: one bit each, so a filter has 1 MB however many ids it holds.
SLOTS = 1 << 23


def slot(column: str) -> Column:
    """The place of an id in an id filter."""
    return F.pmod(F.xxhash64(F.col(column)), F.lit(SLOTS))


def id_filter(
    ids: DataFrame, column: str, place: Column | None = None, size: int = SLOTS
) -> np.ndarray:
    """A bitmap of fixed size that says which ids may be among ``ids``.

    It only saves shuffles: a clear bit proves absence, a set bit is decided by the join.
    At most ``size / 64`` rows of 16 bytes come to the driver. ``place`` gives the place of an id
    where it is not :func:`slot` of its column; it is less than ``size``.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("slot", F.lit(64)).cast("int"))
    words = (
        ids.select((slot(column) if place is None else place).alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .toPandas()
    )
    bitmap = np.zeros(max(1, size // 64), dtype=np.int64)
    bitmap[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    return bitmap


def among(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """False where a slot is surely not of an id of the filter."""
    return (bitmap[slots >> 6] >> (slots & 63)) & 1 == 1


def maybe_among(bitmap: np.ndarray, column: str) -> Column:
    """:func:`among` as a condition on an id column."""

    @F.pandas_udf("boolean")
    def look(slots):
        import pandas as pd

        return pd.Series(among(bitmap, slots.to_numpy()))

    return look(slot(column))


#: At most so many groups of a table can hold this share of its rows each, or more.
HEAVY = 1000


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str) -> DataFrame:
    """Each row with the columns of its group, a row of no group with nulls.

    ``groups`` has one row per group and its number of rows in ``size``. A group that holds a
    share of ``1 / HEAVY`` of the rows in groups is sent to every task, and there are at most
    ``HEAVY`` of these; all others meet their rows by a shuffle that no key can tilt. Both
    tables are read twice: hand over cut ones.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    heavy = F.col(size) * HEAVY >= F.lit(total)
    few = groups.where(heavy).withColumn("__heavy", F.lit(True))
    met = rows.join(F.broadcast(few), on, "left")
    added = [c for c in groups.columns if c not in on]
    light = met.where("__heavy IS NULL").drop("__heavy", *added)
    return met.where("__heavy").drop("__heavy").unionByName(
        light.join(groups.where(~heavy), on, "left")
    )
