"""Relational tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC scan, split into ``partitions`` ranges of a number or time column.

    Rows outside the bounds are read too: bounds only place the cuts. A MySQL address asks
    for a cursor, without which its driver ignores the fetch size and holds a whole part.
    """
    if url.startswith("jdbc:mysql:") and "useCursorFetch" not in url:
        url += ("&" if "?" in url else "?") + "useCursorFetch=true"
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **extra}
    if partitions > 1:
        if not partition_column or not bounds:
            raise ValueError("a split scan needs partition_column and bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": bounds[0],
            "upperBound": bounds[1],
            "numPartitions": str(partitions),
        }
    return options


def hash_predicates(column: str, partitions: int) -> list[str]:
    """Conditions that split a table evenly by the hash of a text key.

    Ranges of time or votes are uneven when most rows fall into a few days. Each row
    meets exactly one condition, also one without a key.
    """
    parts = [f"MOD(CRC32({column}), {partitions}) = {i}" for i in range(partitions)]
    return [f"{parts[0]} OR {column} IS NULL", *parts[1:]]


def prefix_ranges(column: str, partitions: int, digits: int = 3) -> list[str]:
    """Conditions that split a table by ranges of a key of random hexadecimal digits.

    An index on the key serves each range, so the table is read once in all. Each row meets
    exactly one condition, also one without a key or with other characters.
    """
    space = 16**digits
    if not 1 <= partitions <= space:
        raise ValueError(f"between 1 and {space} ranges")
    cuts = [f"{space * i // partitions:0{digits}x}" for i in range(1, partitions)]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < '{cuts[0]}' OR {column} IS NULL", *inner, f"{column} >= '{cuts[-1]}'"]


#: Keys that place the cuts of :func:`sampled_ranges`, in expectation.
SAMPLE = 100_000


def sampled_ranges(
    keys: DataFrame, column: str, partitions: int, sample: int = SAMPLE, seed: int = 1
) -> list[str]:
    """Conditions that split a table into ranges of about equal size, whatever its keys look like.

    ``keys`` holds the key column; the cuts are quantiles of a sample of it, so a range is off
    by a few hundredths of its size. Each row meets exactly one condition, also one without a key.
    """
    if partitions < 1:
        raise ValueError("at least one range")
    known = keys.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("key"))
    total = known.count()
    chosen = known if total <= sample else known.sample(sample / total, seed)
    found = sorted((r.key for r in chosen.toLocalIterator()), key=lambda k: k.encode())
    cuts = sorted({found[len(found) * i // partitions] for i in range(1, partitions)} if found else (), key=str.encode)
    if not cuts:
        return ["1 = 1"]
    quoted = ["'" + c.replace("\\", "\\\\").replace("'", "''") + "'" for c in cuts]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(quoted, quoted[1:])]
    return [f"{column} < {quoted[0]} OR {column} IS NULL", *inner, f"{column} >= {quoted[-1]}"]


def read_jdbc_table(
    spark: SparkSession, options: Mapping[str, str], predicates: Sequence[str] = ()
) -> DataFrame:
    """A whole table through JDBC, one task per predicate if there are any.

    The driver jar has to be on the classpath.
    """
    if not predicates:
        return spark.read.format("jdbc").options(**options).load()
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(
        options["url"], options["dbtable"], predicates=list(predicates), properties=rest
    )


def read_exported_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A whole table from an export in a columnar format."""
    return spark.read.format(fmt).load(path)


def union_inputs(*inputs: DataFrame) -> DataFrame:
    """All rows of all inputs, columns matched by name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), inputs)
