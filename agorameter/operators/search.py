"""Searches with many keywords, and of many channels with ranges of their own."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorameter.functions.text import watch_url
from agorameter.operators.collect import date_tiles, of_type
from agorameter.schemas import TILE_DAYS
from agorameter.session import shipped

#: Keywords that an automaton in every worker may hold, and the characters of all of them.
MOST_KEYWORDS, MOST_CHARACTERS = 1_000_000, 50_000_000
#: Hits that a worker holds before it hands them on; a text is not divided.
HELD_HITS = 50_000
HIT = "keyword string, start int, end int"


def lowered(text: str) -> str:
    """Lower case with one character for each of the text, so that places stay."""
    low = text.lower()
    if len(low) == len(text):
        return low
    return "".join(x if len(x := c.lower()) == 1 else c for c in text)


def automaton(keywords: Iterable[str]):
    """All keywords in one trie with links from each state to the longest suffix in the trie."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for keyword in keywords:
        low = lowered(keyword)
        machine.add_word(low, (len(low), keyword))
    machine.make_automaton()
    return machine


def keyword_hits(
    df: DataFrame, text: str, keywords: Iterable[str], keep: Iterable[str] = ()
) -> DataFrame:
    """Every place of every keyword, in any case: the ``keep`` columns, ``keyword, start, end``.

    A text is read once, whatever the number of keywords; hits may overlap. Places count
    characters from 0, the end exclusive. Keywords are parts of words too; equal ones in
    different case are one, named as the smallest. A null text has no hit. The keywords go to
    every worker, so their number and size are bounded.
    """
    chosen: dict[str, str] = {}
    for keyword in sorted(set(keywords)):
        chosen.setdefault(lowered(keyword), keyword)
    chosen.pop("", None)
    if not chosen:
        raise ValueError("there is no keyword")
    if len(chosen) > MOST_KEYWORDS or sum(map(len, chosen)) > MOST_CHARACTERS:
        raise ValueError("too many keywords for one automaton; search in several passes")
    spark, names = df.sparkSession, list(keep)
    shipped(spark)
    shared = spark.sparkContext.broadcast(list(chosen.values()))

    def handed(batch: pa.RecordBatch, rows: list, found: list) -> pa.RecordBatch:
        kept = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[1:]]
        columns = list(zip(*found, strict=True)) if found else [[]] * 3
        kinds = (pa.string(), pa.int32(), pa.int32())
        hits = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*kept, *hits], names=[*names, "keyword", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(shared.value)
        for batch in batches:
            rows, found = [], []
            for i, cell in enumerate(batch.column(0)):
                value = cell.as_py()
                for last, (size, keyword) in machine.iter(lowered(value)) if value else ():
                    rows.append(i)
                    found.append((keyword, last + 1 - size, last + 1))
                if len(rows) >= HELD_HITS:
                    yield handed(batch, rows, found)
                    rows, found = [], []
            yield handed(batch, rows, found)

    schema = df.select(*names).schema.add("keyword", "string").add("start", "integer").add("end", "integer")
    return df.select(F.col(text).alias("__text"), *names).mapInArrow(run, schema)


def _bin(moment: Column, days: int) -> Column:
    """The bin of a time, of the length of a tile."""
    return F.floor(F.unix_micros(moment.cast("timestamp")) / F.lit(days * 86_400_000_000))


def assign_tiles(
    items: DataFrame,
    searches: DataFrame,
    channel: str = "channel",
    time: str = "published",
    start: str = "start",
    end: str = "end",
    days: int = TILE_DAYS,
) -> DataFrame:
    """Each item with every tile ``[tile_start, tile_end)`` of its channel's searches that holds it.

    ``searches`` has a channel and a range per row. Tiles and items meet in bins as long as a
    tile, so the join is on equal values and a tile is in two bins at most; the exact borders are
    checked after it. Items without channel or time belong to no tile.
    """
    tiles = date_tiles(searches.select(channel, start, end), start, end, days)
    # The last instant of a tile, so that one that ends at a border of bins is in one less.
    last = F.col("tile_end").cast("timestamp") - F.expr("INTERVAL 1 MICROSECOND")
    bins = F.sequence(_bin(F.col("tile_start"), days), _bin(last, days))
    binned = tiles.select(channel, "tile_no", "tile_start", "tile_end", F.explode(bins).alias("_bin"))
    met = items.withColumn("_bin", _bin(F.col(time), days)).join(binned, [channel, "_bin"])
    inside = (F.col(time) >= F.col("tile_start")) & (F.col(time) < F.col("tile_end"))
    return met.where(inside).drop("_bin")


def channel_links(
    items: DataFrame, searches: DataFrame, keywords: Iterable[str], days: int = TILE_DAYS
) -> DataFrame:
    """Addresses of videos on a topic in the ranges of many channels.

    ``items`` as for ``video_links``; ``searches`` has ``channel_id, start, end``. Each address
    comes once per channel: ``channel_id, tile_no, published, url``, of its earliest tile.
    """
    videos = of_type(items, "video").select("channel_id", "video_id", "title", "published")
    hits = keyword_hits(videos, "title", keywords, ("channel_id", "video_id", "published"))
    on_topic = hits.select("channel_id", "video_id", "published").distinct()
    placed = assign_tiles(on_topic, searches, "channel_id", days=days)
    return placed.groupBy("channel_id", watch_url(F.col("video_id")).alias("url")).agg(
        F.min("tile_no").alias("tile_no"), F.min("published").alias("published")
    )
