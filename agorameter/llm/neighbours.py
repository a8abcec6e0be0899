"""Nearest neighbours by collision-counting hashing over sorted projections.

Every vector is indexed: it is dealt to a shard, and a shard keeps one sorted array per random
projection. For each query a window around its own projection grows in every array at once
(virtual rehashing), and a vector that lies in enough of the windows is a candidate. The windows
are the first whose candidates are a stated share of the shard, sought from those of the query
before; then exact cosines are computed. The queries are a stated set; they meet the shards in blocks, and only the best of
each shard go on to the merge.

Nulls and edge cases: vectors that are null, zero or hold null or non-finite components take no
part, nor do rows without an id; vectors meet only those of their length; a query's own id is
no candidate; rows that share an id hold one vector and count once; equal scores go to the
smaller id; with fewer candidates than asked all are returned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorameter.llm.common import cut, prepare
from agorameter.llm.embedding_dedup import unit, usable

#: Projections, and the share of them in whose windows a candidate lies.
PROJECTIONS = 128
COLLISIONS = 0.5
#: Candidates that a query verifies per shard: a floor and a share of its vectors.
LEAST = 96
SHARE = 0.12
#: Half-width of the first windows in standard deviations, and the factor of each growth.
FIRST = 0.4
GROWTH = 1.06
#: Vectors of a shard and queries of a block.
SHARD = 4096
BLOCK = 512
SEED = 20240923


class Index:
    """The sorted projections of one shard."""

    def __init__(self, x: np.ndarray):
        self.x = x
        chance = np.random.default_rng((SEED, x.shape[1]))
        self.planes = chance.standard_normal((x.shape[1], PROJECTIONS))
        projected = x @ self.planes
        order = np.argsort(projected, axis=0, kind="stable")
        self.sorted = np.take_along_axis(projected, order, axis=0).T.copy()
        # The place of each vector in each sorted array.
        kind = np.uint16 if len(x) < 1 << 16 else np.uint32
        self.ranks = np.empty(self.sorted.shape, dtype=kind)
        np.put_along_axis(self.ranks, order.T, np.arange(len(x), dtype=kind)[None, :], axis=1)
        self.spread = max(float(projected.std()), 1e-9)

    def candidates(self, queries: np.ndarray, least: int = LEAST, share: float = SHARE):
        """For each query the vectors that lie in enough windows, as arrays of places."""
        n = len(self.x)
        wanted = min(n, least + int(np.ceil(share * n)))
        if wanted == n:
            return [np.arange(n)] * len(queries)
        projected = queries @ self.planes
        needed = int(np.ceil(COLLISIONS * PROJECTIONS))
        widest = max(float(self.sorted.max()), float(projected.max()))
        widest -= min(float(self.sorted.min()), float(projected.min()))
        widths = [FIRST * self.spread]
        while widths[-1] <= widest:
            widths.append(widths[-1] * GROWTH)
        ends: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def windows(w: int) -> tuple[np.ndarray, np.ndarray]:
            """Where the windows of a width start and how many vectors they hold, by query."""
            if w not in ends:
                low, high = (
                    np.array([
                        np.searchsorted(places, around + way * widths[w], side)
                        for places, around in zip(self.sorted, projected.T, strict=True)
                    ])
                    for way, side in ((-1, "left"), (1, "right"))
                )
                ends[w] = low.T.astype(self.ranks.dtype), (high - low).T.astype(self.ranks.dtype)
            return ends[w]

        def collided(q: int, w: int) -> np.ndarray:
            """The vectors that lie in enough windows of a width around a query."""
            low, held = windows(w)
            # A place before the window wraps around to a large number.
            inside = self.ranks - low[q][:, None] < held[q][:, None]
            counts = inside.view(np.uint8).sum(axis=0, dtype=np.min_scalar_type(PROJECTIONS))
            return np.flatnonzero(counts >= needed)

        found, w = [], 0
        for q in range(len(queries)):
            best, w = self._grow(lambda w, q=q: collided(q, w), w, len(widths) - 1, wanted)
            found.append(best)
        return found

    def _grow(self, collided, w: int, widest: int, wanted: int) -> tuple[np.ndarray, int]:
        """The vectors of the first width that has enough of them, or of the widest, and that width.

        Wider windows hold what narrower ones do, so the width is sought from that of the query before.
        """
        below, found, step = -1, collided(w), 1
        if len(found) >= wanted:
            enough = w
            while below < 0 < enough:
                w = max(0, enough - step)
                tried = collided(w)
                if len(tried) < wanted:
                    below = w
                    break
                enough, found, step = w, tried, step * 2
        else:
            enough, below = widest, w
            while True:
                w = min(widest, below + step)
                if w == below:
                    return found, w
                found = collided(w)
                if len(found) >= wanted:
                    enough = w
                    break
                below, step = w, step * 2
        while enough - below > 1:
            w = (below + enough) // 2
            tried = collided(w)
            if len(tried) >= wanted:
                enough, found = w, tried
            else:
                below = w
        return found, enough


def _blocks(n: int, size: int) -> int:
    return max(1, -(-n // size))


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    least: int = LEAST,
    share: float = SHARE,
) -> DataFrame:
    """``query_id, rank, <key>, score`` of the ``k`` nearest found for each query."""
    prepare(vectors.sparkSession)
    kind = vectors.schema[key].dataType.simpleString()
    rows = vectors.select(
        F.col(key).alias("key"), F.col(vector).alias("vector"), is_query.alias("query")
    ).where(F.col("key").isNotNull() & usable(F.col("vector")))
    rows = cut(rows.dropDuplicates(["key"]).withColumn("size", F.size("vector")))
    n = rows.agg(F.count("*"), F.count_if("query")).first()
    shards, blocks = _blocks(n[0], SHARD), _blocks(n[1], BLOCK)
    shard = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(shards))
    block = F.pmod(F.xxhash64("key", F.lit(2)), F.lit(blocks))
    indexed = rows.select(
        "size", "key", "vector", shard.alias("shard"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
    )
    asked = rows.where("query").select(
        "size", "key", "vector", block.alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
    )

    def find(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        columns: dict[str, list] = {"query_id": [], "key": [], "score": []}
        if len(data) and len(queries):
            raw = np.stack(data["vector"].to_numpy()).astype(np.float64)
            asked = np.stack(queries["vector"].to_numpy()).astype(np.float64)
            keys, own = data["key"].to_numpy(), queries["key"].to_numpy()
            found = Index(unit(raw)).candidates(unit(asked), least, share)
            (raw, lengths), (asked, sizes) = scaled(raw), scaled(asked)
            for q, places in enumerate(found):
                places = places[keys[places] != own[q]]
                scores = (raw[places] * asked[q]).sum(axis=1) / (lengths[places] * sizes[q])
                best = np.lexsort((keys[places], -scores))[:k]
                columns["query_id"] += [own[q]] * len(best)
                columns["key"] += keys[places[best]].tolist()
                columns["score"] += scores[best].tolist()
        return pd.DataFrame(columns)

    grouping = ["size", "shard", "block"]
    best = (
        indexed.groupBy(*grouping)
        .cogroup(asked.groupBy(*grouping))
        .applyInPandas(find, f"query_id {kind}, key {kind}, score double")
    )
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "key")
    return (
        best.withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("key").alias(key), "score")
    )


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that a power of two brings near one, which takes no rounding, and their lengths."""
    x = x * np.exp2(-np.frexp(np.abs(x).max(axis=1, initial=0))[1].astype(float))[:, None]
    return x, np.sqrt((x * x).sum(axis=1))
