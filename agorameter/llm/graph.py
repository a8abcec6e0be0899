"""Connected components by repeated joins; nothing but counts comes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorameter.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """``(key, component)`` for every end of an edge ``(a, b)``, the smallest key it reaches.

    Alternates two steps until the edges stay the same: link each larger neighbour of a node,
    then each smaller one, to the smallest of its neighbourhood. The edges never grow in
    number and end as one star per component, after about log(size) rounds.
    """
    links = cut(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    state = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
            .select(F.col("e.b").alias("a"), F.col("e.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        links, before = cut(small), state
        state = _state(links)
        if state == before:
            break
    roots = links.select(F.col("b").alias("key"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("key"), F.col("b").alias("component")).unionByName(roots)


def _state(links: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    row = links.agg(
        F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.shiftright(F.xxhash64("b", "a"), 24))
    ).first()
    return tuple(row)
