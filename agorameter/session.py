"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings. Partition counts and memory belong to the cluster, not here.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A batch handed to a Python model holds whole texts: bound it by size, not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def build_session(app_name: str = "agorameter", **settings: str) -> SparkSession:
    """Get or create a session with the library's settings, overridden by ``settings``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting a temporary folder is used, in local mode only: on a cluster
    other machines could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="agorameter-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder, in whatever store it is; false if there was none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


#: Delete the shuffle files of a query when it ends, not when the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run in this block leave no shuffle files; a lost cached part is computed anew."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


#: Partitions that a user asks for inputs of too few splits, such as one small file.
INPUT_PARTITIONS = "agorameter.inputPartitions"


def spread(df: DataFrame) -> DataFrame:
    """Deal a batch input out to the number of partitions in ``agorameter.inputPartitions``.

    Without that setting the input is returned as it is: splits are the source's business.
    """
    wanted = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(wanted)) if wanted and not df.isStreaming else df


def shipped(spark: SparkSession) -> None:
    """Make the package importable in the Python workers, wherever the driver was started."""
    import shutil
    import tempfile
    from pathlib import Path

    import agorameter

    if getattr(spark.sparkContext, "_agorameter_shipped", False):
        return
    # Only staged here: the driver serves the file to all workers.
    root = Path(agorameter.__file__).parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='agorameter-')}/agorameter", "zip", root.parent, root.name
    )
    spark.sparkContext.addPyFile(archive)
    spark.sparkContext._agorameter_shipped = True
