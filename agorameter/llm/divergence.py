"""How the sources of a language differ in the words they use, exactly, in whole numbers.

A term is a run of letters, kept if at least ``LEAST_DOCS`` documents of its language have it. A
group, that is a source within a language, gives every kept term the smoothed share
``p = 1 + floor(10^9 (count + 1) / (N + V))``; two shares differ by ``floor((p - q)^2 / q)``.

1. A task counts the terms of its documents by group and sends one row per group, term and
   stretch of input. The terms of a language that stay are numbered without gaps, so that all
   its blocks of ids but the last hold ``1 << BLOCK_BITS`` terms.
2. Every group has one array of sorted ids and counts per block. Pairs of groups are tasks: the
   arrays of ``TILE`` groups meet those of ``TILE`` others, block by block. Each unordered
   pair is merged once: the ids of the shorter array gallop through the longer one, which
   prices the overlap, the terms of one side only, and the rest of the block, which neither
   has, all in both directions. The values of the blocks are then summed.
3. The terms a group uses more than its language come from the same counts, in one pass; each
   task keeps the best of a group before they meet.

A group of a third of all rows has longer arrays than others, but in blocks of the same size.

Nulls and edge cases: a null text, language or source is an empty one, and the empty language
and source are like any other; a group without terms has all counts 0; a language without kept
terms has pairs of value 0; rows are documents, repeated ones and those without id too; an
empty table gives no row; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorameter.llm.common import cut, empty_safe, join_groups, prepare

#: Letters of ASCII, and bytes of all other characters.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
LEAST_DOCS = 3
#: The scale of a share.
SCALE = 1_000_000_000
#: Best terms of a group that are returned.
BEST = 200
#: Different terms by group that a task holds before it sends them.
HELD = 200_000
#: Ids in a block, as a power of two, and groups on either side of a tile.
BLOCK_BITS = 16
TILE = 16

COUNTED = "lang string, source string, term string, n long, docs long"
VALUES = "lang string, source string, item string, value long"


def terms(data: bytes) -> list[bytes]:
    """The terms of a text, in order; only A-Z is lower-cased."""
    return TERM.findall(data.lower())


def _counted(docs: DataFrame) -> DataFrame:
    """Occurrences and documents of every term, by group and stretch of input."""

    def send(found: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, documents) in found.items():
            names = list(counts)
            arrays = [
                pa.array([lang] * len(names), pa.string()),
                pa.array([source] * len(names), pa.string()),
                pa.array(names, pa.binary()).cast(pa.string()),
                pa.array([counts[t] for t in names], pa.int64()),
                pa.array([documents[t] for t in names], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in COUNTED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = {}, 0
        for batch in batches:
            for lang, source, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts, documents = found.setdefault((lang, source), (Counter(), Counter()))
                own, before = terms(data), len(counts)
                counts.update(own)
                documents.update(set(own))
                held += len(counts) - before
                if held >= HELD:
                    yield from send(found)
                    found, held = {}, 0
        yield from send(found)

    return docs.mapInArrow(run, COUNTED)


def shares(counts: np.ndarray, whole: int) -> np.ndarray:
    """``1 + floor(SCALE (count + 1) / whole)`` by long division, as the product can overflow."""
    share, rest = np.divmod(counts + 1, whole)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, whole)
        share = share * 1000 + digits
    return share + 1


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``floor((p - q)^2 / q)``, which fits 64 bits."""
    return (p - q) ** 2 // q


def _priced(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The sums of the differences in both directions."""
    return np.array((difference(own, other).sum(), difference(other, own).sum()), dtype=np.int64)


def merge(a: tuple, b: tuple, block_terms: int) -> np.ndarray:
    """Both values of a pair over one block; a side is ``(ids, shares, share of an absent term)``."""
    if len(a[0]) > len(b[0]):
        return merge(b, a, block_terms)[::-1]
    (ids_a, p_a, none_a), (ids_b, p_b, none_b) = a, b
    # Sorted needles: each search starts where the last one ended.
    place = np.searchsorted(ids_b, ids_a)
    met = np.zeros(len(ids_a), dtype=bool)
    inside = place < len(ids_b)
    met[inside] = ids_b[place[inside]] == ids_a[inside]
    apart = np.ones(len(ids_b), dtype=bool)
    apart[place[met]] = False
    absent = block_terms - len(ids_a) - int(apart.sum())
    return (
        _priced(p_a[met], p_b[place[met]])
        + _priced(p_a[~met], none_b)
        + _priced(none_a, p_b[apart])
        + absent * _priced(none_a, none_b)
    )


def _share(count: str | int, whole: str) -> Column:
    """:func:`shares` as an expression; decimals hold the product."""
    product = f"cast({SCALE} AS decimal(10,0)) * (cast({count} AS decimal(20,0)) + 1)"
    return F.expr(f"1 + ({product}) div cast({whole} AS decimal(20,0))")


def _side(row: dict) -> tuple:
    ids = np.array(row["ids"] or (), dtype=np.int64)
    counts = np.array(row["counts"] or (), dtype=np.int64)
    whole = max(1, row["total"] + row["kept"])
    return ids, shares(counts, whole), shares(np.zeros(1, dtype=np.int64), whole)


def _pair_values(low: pa.Table, high: pa.Table) -> pa.Table:
    """Both values of each pair of a group of the one side and a later group of the other."""
    rows: list[tuple] = []
    left, right = low.to_pylist(), high.to_pylist()
    others = [(b, _side(b)) for b in right]
    for a in left:
        side = _side(a)
        for b, other in others:
            if a["place"] < b["place"]:
                ab, ba = merge(side, other, a["block_terms"])
                rows.append((a["lang"], a["source"], b["source"], int(ab)))
                rows.append((a["lang"], b["source"], a["source"], int(ba)))
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    kinds = [pa.string()] * 3 + [pa.int64()]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.Table.from_arrays(arrays, names=[c.split()[0] for c in VALUES.split(", ")])


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of every ordered pair of sources of a language."""
    block = F.shiftright("id", BLOCK_BITS).alias("block")
    place = F.col("id").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int").alias("at")
    arrays = (
        kept.select("lang", block, place, F.inline("by"))
        .groupBy("lang", "source", "block")
        .agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("found"))
        .select("lang", "source", "block", F.col("found.at").alias("ids"), F.col("found.n").alias("counts"))
    )
    blocks = kept.groupBy("lang", block).agg(F.count("*").alias("block_terms"))
    sides = (
        groups.join(blocks, "lang", "left")
        .fillna({"block": -1, "block_terms": 0})
        .join(arrays, ["lang", "source", "block"], "left")
        .withColumn("tile", F.floor(F.col("place") / TILE))
    )
    sides = cut(sides.drop("terms", "lang_total"))
    last = F.floor((F.col("sources") - 1) / TILE)
    low = sides.withColumns({"one": F.col("tile"), "two": F.explode(F.sequence("tile", last))})
    high = sides.withColumns({"two": F.col("tile"), "one": F.explode(F.sequence(F.lit(0).cast("long"), "tile"))})
    key = ["lang", "block", "one", "two"]
    met = low.groupBy(*key).cogroup(high.groupBy(*key)).applyInArrow(_pair_values, VALUES)
    return met.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _numbered(kept: DataFrame) -> DataFrame:
    """The kept terms with an ``id`` that counts the terms of a language without gaps.

    The terms of a language are one run of rows in each partition, so only the sizes of the
    runs have to be added up.
    """
    part = F.shiftright("row", 33).alias("part")
    runs = kept.groupBy("lang", part).agg(F.count("*").alias("size"), F.min("row").alias("first"))
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    return (
        kept.select("lang", "row", "by", part)
        .join(starts, ["lang", "part"])
        .select("lang", "by", (F.col("start") + F.col("row") - F.col("first")).alias("id"))
    )


def _over_used(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value, rank`` of the terms a group uses more than its language."""
    rows = kept.select("lang", "term", F.col("total").alias("everywhere"), F.inline("by"))
    met = join_groups(rows, groups.where("terms > 0"), ["lang", "source"], "terms")
    p, q = _share("n", "total + kept"), _share("everywhere", "lang_total + kept")
    more = met.withColumns({"p": p, "q": q}).where("p > q")
    value = F.expr("((p - q) * (p - q)) div q")
    return _ranked(more.select("lang", "source", F.col("term").alias("item"), value.alias("value"))).where(
        F.col("rank") <= BEST
    )


def _ranked(values: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return values.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank``: other sources and over-used terms of each group.

    Part ``pair``: every other source of the language, by the summed differences of all kept
    terms. Part ``term``: the ``BEST`` terms by which the group exceeds its language most.
    """
    prepare(docs.sparkSession)
    rows = docs.select(empty_safe("lang").alias("lang"), empty_safe("source").alias("source"), "text")
    counted = _counted(rows.select("lang", "source", empty_safe("text").cast("binary")))
    # Dealt out by term once: both groupings follow in place.
    by_source = (
        counted.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    kept = cut(
        by_source.groupBy("lang", "term")
        .agg(
            F.sum("docs").alias("docs"),
            F.sum("n").alias("total"),
            F.collect_list(F.struct("source", "n")).alias("by"),
        )
        .where(F.col("docs") >= LEAST_DOCS)
        .drop("docs")
        .sortWithinPartitions("lang")
        .withColumn("row", F.monotonically_increasing_id())
    )
    own = kept.select("lang", F.inline("by")).groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count("*").alias("terms")
    )
    whole = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_total"))
    of_lang = Window.partitionBy("lang")
    groups = cut(
        rows.select("lang", "source")
        .distinct()
        .join(own, ["lang", "source"], "left")
        .join(whole, "lang", "left")
        .fillna(0, ["total", "terms", "kept", "lang_total"])
        .withColumns(
            {
                "place": F.row_number().over(of_lang.orderBy("source")) - 1,
                "sources": F.count("*").over(of_lang),
            }
        )
    )
    pairs = _ranked(_pairs(_numbered(kept), groups)).withColumn("part", F.lit("pair"))
    over = _over_used(kept, groups).withColumn("part", F.lit("term"))
    return pairs.unionByName(over).select("lang", "source", "part", "item", "value", "rank")
