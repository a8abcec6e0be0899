"""Choosing what to collect: search ranges, keyword and type filters, order, first seen."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorameter.schemas import KEYWORDS, TILE_DAYS


def date_tiles(df: DataFrame, start: str, end: str, days: int = TILE_DAYS) -> DataFrame:
    """Split each row's range ``[start, end)`` into tiles of ``days`` days.

    Adds ``tile_no``, ``tile_start`` and ``tile_end``; the last tile is cut at the end
    of the range, and an empty range has no tile.
    """
    step = F.expr(f"interval {int(days)} days")
    cuts = F.when(F.col(start) < F.col(end), F.sequence(F.col(start), F.col(end), step))
    tiles = df.select("*", F.posexplode(cuts).alias("tile_no", "tile_start"))
    return tiles.filter(F.col("tile_start") < F.col(end)).withColumn(
        "tile_end", F.least(F.col("tile_start") + step, F.col(end))
    )


def tile_number(moment: Column, start: Column, days: int = TILE_DAYS) -> Column:
    """Number of the tile a time falls in, by arithmetic instead of a range join."""
    elapsed = F.unix_micros(moment.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.floor(elapsed / F.lit(days * 86_400_000_000)).cast("int")


def published_between(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows in the half-open range, so that adjacent ranges share none."""
    return df.filter((F.col(column) >= start) & (F.col(column) < end))


def keyword_search(df: DataFrame, column: str, query: str = KEYWORDS) -> DataFrame:
    """Rows whose text holds one of the ``|``-separated keywords, in any case.

    The text is lower-cased once and searched as bytes, which is many times faster than
    a case-insensitive pattern.
    """
    words = [w.strip() for w in query.split("|") if w.strip()]
    if not words:
        raise ValueError("the query has no keyword")

    def holds_any(text: Column) -> Column:
        return reduce(or_, [text.contains(F.lower(F.lit(w))) for w in words])

    return df.filter(F.exists(F.array(F.lower(column)), holds_any))


def of_type(df: DataFrame, kind: str = "video", channel: str | None = None) -> DataFrame:
    """Search items of one kind and, if given, of one channel."""
    kept = df.filter(F.col("type") == kind)
    return kept if channel is None else kept.filter(F.col("channel_id") == channel)


def first_seen(df: DataFrame, key: str, order: str) -> DataFrame:
    """Each key once, with the position it was first seen at.

    Partial minima are taken before the shuffle, so a key repeated without end costs one
    row per input partition.
    """
    return df.groupBy(key).agg(F.min(order).alias(order))


def newest_first(df: DataFrame, published: str, *ties: str) -> DataFrame:
    """All rows, newest first: a range-partitioned sort."""
    return df.orderBy(F.desc(published), *ties)


def popular_first(df: DataFrame, group: str, votes: str, *ties: str) -> DataFrame:
    """All rows by group, most votes first.

    The sort ranges cover votes and ties too, so a large group spans many tasks.
    """
    return df.orderBy(group, F.desc(votes), *ties)


#: Parts that a group is split into before its best rows meet.
SALTS = 256


def most_popular(df: DataFrame, k: int, group: str, votes: str, *ties: str) -> DataFrame:
    """The ``k`` rows with most votes per group, numbered in ``popularity``.

    Two steps for every ``k``: a group is reduced to the best ``k`` of each of its salted
    parts, then to the best of these, so a large group does not gather in one task.
    """
    order = [F.desc(votes), *ties]
    salt = F.pmod(F.xxhash64(votes, *ties), F.lit(SALTS))
    part = Window.partitionBy(group, "_salt").orderBy(*order)
    df = df.withColumn("_salt", salt).withColumn("_place", F.row_number().over(part))
    df = df.filter(F.col("_place") <= k).drop("_salt", "_place")
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("popularity", place).filter(F.col("popularity") <= k)
