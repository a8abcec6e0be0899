"""Message bytes to typed columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from agorameter.functions.text import expand_once

CORRUPT = "_corrupt_record"


def decode(value: Column | str = "value") -> Column:
    """Message bytes as text."""
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def parse_messages(df: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """The message's fields as columns.

    Keys outside the schema are ignored. A field of the wrong type becomes NULL and the
    others are kept; a malformed message becomes a row of NULLs. A message is parsed once,
    also where a later filter reads one of its fields.
    """
    return df.select(expand_once(F.from_json(decode(value), schema)))


def malformed_messages(df: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """The rows of ``df`` whose message cannot be read with ``schema``, with its text.

    A message counts as malformed when it is not a JSON object or a field has a wrong
    type; the text is added in column ``_corrupt_record``.
    """
    extended = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = F.from_json(decode(value), extended, {"columnNameOfCorruptRecord": CORRUPT})
    return df.withColumn(CORRUPT, parsed[CORRUPT]).filter(F.col(CORRUPT).isNotNull())


def select_renamed(
    df: DataFrame, columns: tuple[str, ...], renames: Mapping[str, str]
) -> DataFrame:
    """Rename, then keep ``columns`` in the order given."""
    return df.withColumnsRenamed(dict(renames)).select(*columns)


def to_messages(
    df: DataFrame, topic: Column | str = "topic", key: Column | None = None
) -> DataFrame:
    """Rows as JSON messages ``(key, value, topic)``; NULL fields are left out."""
    topic = F.col(topic) if isinstance(topic, str) else topic
    body = [c for c in df.columns if c != "topic"]
    return df.select(
        (F.lit(None) if key is None else key).cast("binary").alias("key"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in body])).cast("binary").alias("value"),
        topic.alias("topic"),
    )
