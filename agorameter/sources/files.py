"""JSON and text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from agorameter.functions.text import strip_whitespace
from agorameter.schemas import FLAT_VIDEO, FLAT_VIDEO_COMMENT, RAW_VIDEO, with_long_counts
from agorameter.sources.arrays import read_array_texts

#: One array per file, one record per line, an array pretty-printed record by record, or an
#: array of any layout that many tasks read in parts.
ARRAY, LINES, INDENTED, SPLIT = FORMS = ("array", "lines", "indented", "split")


def read_json_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType,
    form: str = INDENTED,
    strict: bool = True,
    long_counts: bool = False,
) -> DataFrame:
    """JSON files with a fixed schema, one row per record.

    A file holds an array with an indent of four blanks (``indented``), any other array
    (``array``), or one record per line (``lines``). A text that is no record of this form
    fails the job, also for a mere count; without ``strict`` it is left out here and returned
    by :func:`read_json_rejects`. A field of the wrong type becomes NULL.

    An ``array`` file cannot be split and lies in the memory of one task; the other forms are
    read in parts. ``split`` reads arrays of any layout, at the cost of scanning them before. ``long_counts`` reads counters as 64-bit integers. Columns that stem from
    folder names are left out; ``_metadata.file_name`` comes along for
    :func:`with_file_channel`.
    """
    schema = with_long_counts(schema) if long_counts else schema
    texts = _texts(spark, paths, form)
    good = _is_record(form)
    if strict:
        told = F.concat(
            F.lit(f"not a record of form {form} in "), "file", F.lit(": "), F.substring("value", 1, 200)
        )
        good = F.when(good, True).otherwise(F.raise_error(told).cast("boolean"))
    kept = texts.where(good)
    if form == ARRAY:
        rows = kept.select("file", F.inline(F.from_json("value", ArrayType(schema))))
    else:
        data = F.from_json("value", schema).alias("data")
        rows = kept.select("file", F.inline(F.array(data)))
    name = F.element_at(F.split("file", "/"), -1)
    return rows.select(*schema.names, F.struct(name.alias("file_name")).alias("_metadata"))


def read_json_rejects(
    spark: SparkSession, paths: str | Sequence[str], form: str = INDENTED
) -> DataFrame:
    """``file, reason, raw`` of the texts that are no records of the form."""
    reason = F.when(F.try_parse_json("value").isNull(), "not JSON").otherwise(f"not of form {form}")
    return _texts(spark, paths, form).where(~_is_record(form)).select(
        "file", reason.alias("reason"), F.col("value").alias("raw")
    )


def read_json_marked(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType,
    form: str = INDENTED,
    long_counts: bool = False,
) -> DataFrame:
    """``file, data, reason, raw`` of every text: a record, or why it is none and the text.

    Both come from one scan, so a job that keeps rejects beside records writes this table
    once and reads its columns as often as it likes.
    """
    schema = with_long_counts(schema) if long_counts else schema
    texts = _texts(spark, paths, form).withColumn("good", _is_record(form))
    raw = F.when(~F.col("good"), F.col("value")).alias("raw")
    reason = F.when(F.col("good"), None).when(F.try_parse_json("value").isNull(), "not JSON")
    reason = reason.otherwise(f"not of form {form}").alias("reason")
    value = F.when(F.col("good"), F.col("value"))
    if form == ARRAY:
        found = F.explode_outer(F.from_json(value, ArrayType(schema)))
        rows = texts.select("file", found.alias("data"), reason, raw, "good")
        # An empty array has no record; a reject keeps its row.
        return rows.where("data IS NOT NULL OR NOT good").drop("good")
    return texts.select("file", F.from_json(value, schema).alias("data"), reason, raw)


def _texts(spark: SparkSession, paths: str | Sequence[str], form: str) -> DataFrame:
    """``file, value``: the text of each record, or of each array; ``begun``: it begins like one."""
    if form not in FORMS:
        raise ValueError(f"form has to be one of {FORMS}")
    paths = [paths] if isinstance(paths, str) else list(paths)
    if form == SPLIT:
        return read_array_texts(spark, paths)
    file = F.col("_metadata.file_path").alias("file")
    if form == INDENTED:
        return _indented_texts(spark.read.option("lineSep", "\n    },\n").text(paths), file)
    texts = spark.read.text(paths, wholetext=form == ARRAY)
    texts = texts.select(file, "value", F.lit(True).alias("begun"))
    return texts.where(F.col("value").rlike(r"\S"))


def _indented_texts(pieces: DataFrame, file: Column) -> DataFrame:
    """Records of pretty-printed arrays, cut where a brace ends a line at the first level.

    A JSON string has no raw line end, so the cut cannot fall into a value; deeper levels
    have more blanks. This lets many tasks read parts of one large file. A piece that does
    not begin like a record stays whole and fails as one.
    """
    value = F.col("value")
    kept = pieces.select(file, "value").filter(~value.rlike(r"\A\s*(\[\s*\])?\s*\z"))
    is_last = value.rlike(r"\n    \}\s*\]\s*\z")
    closed = F.when(is_last, F.regexp_replace(value, r"\]\s*\z", "")).otherwise(
        F.concat(value, F.lit("}"))
    )
    begun = value.rlike(r"\A(\[\n)?    \{\n")
    record = F.when(begun, F.regexp_replace(closed, r"\A\[\n", "")).otherwise(value)
    # Bound here, so that the checks and the parser see one value.
    bound = F.struct(record.alias("value"), begun.alias("begun"))
    return kept.select("file", F.inline(F.array(bound)))


def _is_record(form: str) -> Column:
    """Whether the text is JSON of the right kind: an object, or an array of objects."""
    first, last = ("{", "}") if form != ARRAY else ("[", "]")
    value = F.col("value")
    shaped = value.rlike(rf"\A\s*\{first}") & value.rlike(rf"\{last}\s*\z")
    return F.coalesce(F.col("begun") & shaped & F.try_parse_json(value).isNotNull(), F.lit(False))


def read_raw_videos(
    spark: SparkSession, paths: str | Sequence[str], form: str = INDENTED, **options
) -> DataFrame:
    """Collected videos with their nested comments."""
    return _plain(read_json_records(spark, paths, RAW_VIDEO, form, **options))


def read_flat_videos(
    spark: SparkSession, paths: str | Sequence[str], form: str = INDENTED, **options
) -> DataFrame:
    return _plain(read_json_records(spark, paths, FLAT_VIDEO, form, **options))


def read_flat_comments(
    spark: SparkSession, paths: str | Sequence[str], form: str = INDENTED, **options
) -> DataFrame:
    return _plain(read_json_records(spark, paths, FLAT_VIDEO_COMMENT, form, **options))


def _plain(records: DataFrame) -> DataFrame:
    return records.drop("_metadata")


def read_links(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One stripped link per line, in column ``url``."""
    return spark.read.text(paths).select(strip_whitespace("value").alias("url"))


def with_file_channel(df: DataFrame, column: str = "channel") -> DataFrame:
    """Channel code taken from file names such as ``ABC.json`` or ``ABC_videos.json``."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^([A-Za-z0-9]+)", 1)
    return df.select("*", "_metadata").withColumn(column, name).drop("_metadata")
