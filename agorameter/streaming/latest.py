"""A table with the latest version of each record, kept up to date by a stream.

Records live in buckets by a hash of their key. Each bucket that a batch touches is rewritten
from its present files and the batch, a group of buckets at a time, as

    <path>/data/_batch=<n>/_bucket=<b>/…    the bucket as batch n left it
    <path>/commits/_batch=<n>/…             the buckets of batch n; written last, so it commits

so a stored version is always compared, however long ago it came: no state can expire, and a
lost executor costs nothing but its tasks. A batch that is repeated replaces its own folders
and reads those of earlier batches only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from agorameter.plans.reports import latest_snapshot, with_place
from agorameter.session import dropped_shuffles, remove_folder
from agorameter.sinks.files import CODEC

#: The version of records that have none of their own: the batch they came with.
ARRIVAL = "_arrival"
BUCKET = "_bucket"
BATCH = "_batch"
#: The batch with which a row entered a table whose changes are handed on.
SINCE = "_since"
#: Parts in which a batch rewrites its buckets, at most: what is shuffled at a time is as much less.
ROUNDS = 4
#: Times the mean from which a bucket's rows of a batch are reduced to one per key before the shuffle.
UNEVEN = 4


def _bucket(key: str, buckets: int):
    """Rows without a key are spread over all buckets, as they are never compared."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.uuid())), F.lit(buckets)).cast("int")


def _commits(spark: SparkSession, path: str, before: int | None = None) -> dict[int, tuple[int, int]]:
    """Per bucket the last batch that wrote it, and the number of buckets then.

    There are as many rows as buckets, whatever the size of the table.
    """
    try:
        found = spark.read.schema(f"bucket int, buckets int, {BATCH} long").parquet(f"{path}/commits")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return {}
    if before is not None:
        found = found.where(F.col(BATCH) < before)
    last = found.groupBy("bucket").agg(F.max(F.struct(BATCH, "buckets")).alias("last"))
    return {r.bucket: (r["last"][BATCH], r["last"]["buckets"]) for r in last.collect()}


def _stored(
    spark: SparkSession, path: str, batches: dict[int, int], schema: StructType | None
) -> DataFrame:
    """The present files of some buckets, with the bucket."""
    folders = [f"{path}/data/{BATCH}={n}/{BUCKET}={b}" for b, n in sorted(batches.items())]
    reader = spark.read.option("basePath", f"{path}/data")
    if schema is None:
        return reader.parquet(*folders).drop(BATCH, SINCE)
    wide = StructType(list(schema.fields)).add(BUCKET, "integer")
    if not folders:
        return spark.createDataFrame([], wide)
    return reader.schema(wide).parquet(*folders).select(*wide.names)


#: 1 for a version that entered the table with a batch, -1 for the one it replaced.
SIGN = "_sign"


def _changes(old: DataFrame, new: DataFrame, key: str, batch_id: int) -> DataFrame:
    """What a batch changed: new winners, and old ones that lost; repeats change nothing.

    Both are read from the files of the buckets before and after, so only the columns that the
    report asks for are read.
    """
    entered = new.where(F.col(SINCE) == batch_id)
    left = old.join(entered.select(key), key, "left_semi").select(*old.columns)
    signed = entered.withColumn(SIGN, F.lit(1)).unionByName(left.withColumn(SIGN, F.lit(-1)))
    return signed.drop(SINCE, BUCKET)


def _rounds(spark: SparkSession, buckets: list[int]) -> Iterator[list[int]]:
    """The buckets in a few groups, none of which is too small for the cores."""
    step = max(spark.sparkContext.defaultParallelism, -(-len(buckets) // ROUNDS))
    return (buckets[i : i + step] for i in range(0, len(buckets), step))


def latest_writer(
    path: str,
    key: str,
    version: str | None = None,
    buckets: int = 64,
    changed: Callable[[DataFrame, int], None] | None = None,
    keep_replaced: bool = True,
) -> Callable[[DataFrame, int], None]:
    """A repeatable batch writer for ``start_batch_sink``: one row per key, the latest version.

    Without ``version`` a later batch wins. Equal versions are settled by the other columns,
    rows without a key are all kept. ``buckets`` is fixed by the first batch of a table; choose
    it so that a bucket of the full table is read and written by one task. ``changed(rows,
    batch_id)`` gets the rows that entered and left the table, with :data:`SIGN`, before the
    batch is committed; it has to be repeatable. Without ``keep_replaced`` a batch deletes what
    the one before it replaced, which no repeat can ask for any more: the table takes twice its
    size at most, and a reader that opened it two batches ago loses its files.
    """

    def rewrite(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if version is None:
            batch = batch.withColumn(ARRIVAL, F.lit(batch_id).cast("long"))
        order = version or ARRIVAL
        known = _commits(spark, path, before=batch_id)
        if not keep_replaced:
            _drop_before(spark, path, known)
        count = next((n for _, n in known.values()), buckets)
        schema = StructType(list(batch.schema.fields)).add(SINCE, "long")
        # Materialised once: the bucket of a row without key has to stay the same.
        rows = batch.withColumns({SINCE: F.lit(batch_id).cast("long"), BUCKET: _bucket(key, count)}).persist()
        target = f"{path}/data/{BATCH}={batch_id}"
        try:
            sizes = {r[0]: r[1] for r in rows.groupBy(BUCKET).count().collect()}
            touched = sorted(sizes)
            present = {b: known[b][0] for b in touched if b in known}
            even = max(sizes.values(), default=0) * len(sizes) <= UNEVEN * sum(sizes.values())
            remove_folder(spark, target)
            for group in _rounds(spark, touched):
                new = rows.where(F.col(BUCKET).isin(group))
                if not even:
                    new = latest_snapshot(new, key, order, within=(BUCKET,))
                old = _stored(spark, path, {b: present[b] for b in group if b in present}, schema)
                # More parts than buckets, as few of them then meet in one.
                both = old.unionByName(new).repartition(4 * len(group), BUCKET)
                # Of equal rows the one that came first stays.
                placed = with_place(both, key, order, within=(BUCKET,), last=(SINCE,))
                merged = placed.where("_place = 1").drop("_place", *(() if changed else (SINCE,)))
                writer = merged.write.mode("append").option("compression", CODEC)
                writer.partitionBy(BUCKET).parquet(target)
            if changed:
                old = _stored(spark, path, present, schema)
                now = _stored(spark, path, dict.fromkeys(touched, batch_id), schema)
                changed(_changes(old, now, key, batch_id), batch_id)
            done = spark.createDataFrame([(b, count) for b in touched], "bucket int, buckets int")
            done.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/{BATCH}={batch_id}")
        finally:
            rows.unpersist()

    def write(batch: DataFrame, batch_id: int) -> None:
        with dropped_shuffles(batch.sparkSession):
            rewrite(batch, batch_id)

    return write


def read_latest(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The table as the last committed batch left it; with a schema also where there is none."""
    batches = {b: n for b, (n, _) in _commits(spark, path).items()}
    return _stored(spark, path, batches, schema).drop(BUCKET)


def committed(spark: SparkSession, path: str) -> DataFrame:
    """The batches that the table consists of, in column ``_batch``."""
    return spark.read.schema(f"bucket int, {BATCH} long").parquet(f"{path}/commits").select(BATCH).distinct()


def _drop_before(spark: SparkSession, path: str, known: dict[int, tuple[int, int]]) -> None:
    """Delete the buckets that the last batch of ``known`` replaced."""
    last = max((n for n, _ in known.values()), default=None)
    if last is None:
        return
    for bucket, (batch, _) in _commits(spark, path, before=last).items():
        if known[bucket][0] == last:
            remove_folder(spark, f"{path}/data/{BATCH}={batch}/{BUCKET}={bucket}")


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Delete the buckets that a later committed batch replaced; returns how many.

    Run it while no batch is being written; readers that opened the table before lose their files.
    """
    current = {b: n for b, (n, _) in _commits(spark, path).items()}
    if not current:
        return 0
    all_written = spark.read.schema(f"bucket int, {BATCH} long").parquet(f"{path}/commits").collect()
    dropped = 0
    for row in all_written:
        if row[BATCH] < current[row.bucket]:
            dropped += remove_folder(spark, f"{path}/data/{BATCH}={row[BATCH]}/{BUCKET}={row.bucket}")
    return dropped
