"""Message topics as streaming or batch DataFrames with ``key``, ``value`` and ``topic``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from agorameter.schemas import layout

ENVELOPE = layout("key binary, value binary, topic string")


def topic_options(
    servers: str, topic: str, min_partitions: int | None = None, **extra: str
) -> dict[str, str]:
    """Options of a topic scan from the earliest offset that tolerates aged-out data.

    ``min_partitions`` splits narrow topics into more tasks, without a shuffle.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        **extra,
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def stream_topic(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """A topic as a stream; needs the Kafka package on the classpath."""
    chosen = topic_options(servers, topic, **options)
    return spark.readStream.format("kafka").options(**chosen).load()


def read_topic(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """The present content of a topic as a batch."""
    chosen = topic_options(servers, topic, **options)
    return spark.read.format("kafka").options(**chosen).load()


def stream_topic_files(
    spark: SparkSession, path: str, topic: str, max_files: int | None = None, clean: bool = False
) -> DataFrame:
    """A topic kept as files, as ``write_topic_files`` lays them out.

    With ``clean`` the files of a batch are deleted once it is done, for a topic of one reader.
    """
    reader = spark.readStream.schema(StructType(ENVELOPE.fields[:2]))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if clean:
        reader = reader.option("cleanSource", "delete")
    return reader.parquet(f"{path}/topic={topic}")


def files_per_batch(spark: SparkSession, path: str, topic: str, batches: int) -> int:
    """The ``max_files`` that reads what a topic holds now in at most ``batches`` micro-batches.

    A batch into a table costs as much as the table, so a backlog read in steps of fixed size
    costs the square of its size.
    """
    files = spark.read.schema(StructType(ENVELOPE.fields[:2])).parquet(f"{path}/topic={topic}").inputFiles()
    return max(1, -(-len(files) // batches))


def read_topic_files(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    """The present content of topic files; all topics unless one is named."""
    df = spark.read.schema(ENVELOPE).parquet(path)
    return df if topic is None else df.filter(df["topic"] == topic)
