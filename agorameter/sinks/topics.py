"""Message writers. Rows have ``key``, ``value`` and ``topic``; one pass serves all topics."""

from __future__ import annotations

from pyspark.sql import DataFrame

from agorameter.sinks.files import CODEC, FILE_RECORDS, sized


def write_topics(df: DataFrame, servers: str, **options: str) -> None:
    """Send each row to the topic it names; needs the Kafka package on the classpath."""
    (
        df.select("key", "value", "topic")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .options(**options)
        .save()
    )


def write_topic_files(df: DataFrame, path: str, mode: str = "append", dealt: bool = True) -> None:
    """Keep each row in the folder of the topic it names, in files sized by their bytes.

    Without ``dealt`` the rows are not shuffled and each task writes its own files, for rows of
    one topic from an input of even splits.
    """
    rows = df.select("key", "value", "topic")
    writer = (sized(rows, "topic") if dealt else rows).write.option("maxRecordsPerFile", FILE_RECORDS)
    writer.option("compression", CODEC).partitionBy("topic").mode(mode).parquet(path)
