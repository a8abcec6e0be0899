"""Near-duplicate vectors by sorted projection passes.

In each pass a vector gets a code of random hyperplane signs, and all vectors are ordered by
their codes. Each is compared with the ``NEXT`` ones after it in the order, and its window widens
over the whole run of vectors that share the head of its code. The number of vectors sets the
length of a head, and that sets the number of passes: a pair at the threshold shares no head
with chance ``MISS`` or less, however many vectors there are and however dense they lie, and
a nearer pair with a smaller one.

The order is cut into blocks of a fixed size. A block is compared within itself, with the first
ones of the next block as context, and, where a run goes on, with the other blocks of the run, one
pair of blocks to a task; so a task is bounded however long a run is. It emits a spanning forest
of its verified pairs, not all of them, and the passes' pairs are united. Components are then
completed: all pairs inside a component are counted, in tiles of bounded size.

Nulls and edge cases: vectors that are null, zero or hold null or non-finite components link
with nothing, as do rows without an id (component null); vectors of different lengths don't
link; equal vectors are compared once, as a class with its number of ids; rows that share an id
count as one; an empty table gives no row; labels and other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorameter.llm.common import cut, prepare
from agorameter.llm.graph import components

#: The chance that a pair at the threshold is not compared in any pass, at most.
MISS = 0.001
#: Vectors that share a head on average, at most, if they lie at random.
MEAN = 512
#: Signs of a code, and of a head at least.
BITS = 48
LEAST_HEAD = 4
#: Each vector is compared with so many after it, whatever their heads.
NEXT = 32
#: Vectors of a block of the order, and rows compared at a time.
BLOCK = 4096
SLAB = 256
#: Members of a component that meet in one tile, on either side.
TILE = 1024
SEED = 20240917


def usable(vector: Column) -> Column:
    """Whether all components are finite and one is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(values, dtype=np.float64).reshape(-1, size)


def unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that the squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def plan(n: int, threshold: float) -> tuple[int, int]:
    """Signs of a head, and passes, for ``n`` vectors."""
    head = min(BITS, max(LEAST_HEAD, math.ceil(math.log2(max(n, 1) / MEAN))))
    share = (1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi) ** head
    return head, 1 if share >= 1 else math.ceil(math.log(MISS) / math.log1p(-max(share, 1e-6)))


def codes(x: np.ndarray, passes: int) -> Iterator[np.ndarray]:
    """The code of each vector, pass by pass; the first sign is the highest bit."""
    chance = np.random.default_rng((SEED, x.shape[1]))
    weights = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    for _ in range(passes):
        yield ((x @ chance.standard_normal((x.shape[1], BITS))) >= 0) @ weights


def forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Pairs that connect what all of them connect."""
    parent: dict[int, int] = {}

    def root(i: int) -> int:
        while (up := parent.setdefault(i, i)) != i:
            parent[i] = parent[up]
            i = parent[i]
        return i

    kept = []
    for a, b in pairs:
        x, y = root(a), root(b)
        if x != y:
            parent[y] = x
            kept.append((a, b))
    return kept


def linked(x: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Pairs that connect what the near pairs of ``left`` with ``right`` connect."""
    found = []
    for start in range(0, len(left), SLAB):
        part = left[start : start + SLAB]
        others = left[start:] if left is right else right
        near = x[part] @ x[others].T >= threshold
        i, j = np.nonzero(near)
        # Each of the others hangs on the first that it is near, and the rest of those on that one.
        first = near.argmax(axis=0)
        hung = np.unique(j)
        shared = np.zeros((len(part), len(part)), dtype=bool)
        shared[i, first[j]] = True
        i, j = np.nonzero(shared)
        a, b = np.r_[part[first[hung]], part[j]], np.r_[others[hung], part[i]]
        apart = a != b
        found += zip(a[apart].tolist(), b[apart].tolist(), strict=True)
    return forest(found)


def _ordered(classes: DataFrame, head: int, passes: int) -> DataFrame:
    """``rank, size, pass, head, key, vector``: the place of each vector in the order of all passes."""
    kind = classes.schema["key"].dataType.simpleString()
    vector = classes.schema["vector"].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                for p, made in enumerate(codes(unit(matrix(part.column(1), int(size))), passes)):
                    number = pa.array(np.full(len(made), p, np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(2), number, pa.array(made), part.column(0), part.column(1)],
                        names=("size", "pass", "code", "key", "vector"),
                    )

    schema = f"size int, pass int, code long, key {kind}, vector {vector}"
    coded = classes.select("key", "vector", F.size("vector").alias("size")).mapInArrow(code, schema)
    order = ["size", "pass", "code", "key"]
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = coded.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered = cut(dealt.withColumn("row", F.monotonically_increasing_id()))
    # The row number holds the partition and the place in it; sizes of partitions give the rank.
    part = F.shiftright("row", 33)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    firsts, total = {}, 0
    for row in sizes:
        firsts[row.part], total = total, total + row.n
    first = F.element_at(F.create_map(*(F.lit(x) for pair in firsts.items() for x in pair)), part)
    place = F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    rank = (first + place) if firsts else place
    return ordered.select(
        rank.cast("long").alias("rank"),
        "size",
        "pass",
        F.shiftright("code", BITS - head).alias("head"),
        "key",
        "vector",
    )


def near_edges(classes: DataFrame, threshold: float) -> DataFrame:
    """``(a, b)``: verified pairs that connect all vectors found near each other."""
    kind = classes.schema["key"].dataType.simpleString()
    ranked = _ordered(classes, *plan(classes.count(), threshold))
    block = F.floor(F.col("rank") / BLOCK)
    run = ["size", "pass", "head"]
    # Runs over several blocks, by block: no block has more than a block's rows of one.
    wide = (
        ranked.groupBy(*run)
        .agg(F.min(block).alias("from"), F.max(block).alias("to"))
        .where(F.col("from") < F.col("to"))
        .withColumn("block", F.explode(F.sequence("from", "to")))
    )
    own = F.col("block")

    def pair(low: Column, high: Column) -> Column:
        return F.struct(low.alias("low"), high.alias("high"))

    def pairs(blocks: Column, of: Callable[[Column], Column]) -> Column:
        return F.coalesce(F.transform(blocks, of), F.array().cast("array<struct<low:bigint,high:bigint>>"))

    context = (F.col("rank") % BLOCK < NEXT) & (own > 0)
    earlier = F.when(F.col("from") < own, F.sequence(F.col("from"), own - 1))
    later = F.when(own < F.col("to"), F.sequence(own + 1, F.col("to")))
    met = F.concat(
        F.array(pair(own, own)),
        pairs(F.when(context, F.array(own - 1)), lambda b: pair(b, b)),
        pairs(earlier, lambda b: pair(b, own)),
        pairs(later, lambda b: pair(own, b)),
    )
    dealt = (
        ranked.withColumn("block", block)
        .join(wide, [*run, "block"], "left")
        .select("rank", *run, "key", "vector", F.inline(met))
        .repartition("low", "high")
    )

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("rank")
        low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
        rank, size = rows["rank"].to_numpy(), rows["size"].to_numpy()
        run_of = np.stack([rows[c].to_numpy() for c in run])
        found: list[tuple[int, int]] = []
        for length in np.unique(size):
            places = np.flatnonzero(size == length)
            x = unit(matrix(rows["vector"].combine_chunks().take(pa.array(places)), int(length)))
            at, of = rank[places] // BLOCK, run_of[:, places]
            if low != high:
                near = linked(x, np.flatnonzero(at == low), np.flatnonzero(at == high), threshold)
            else:
                near = neighbours(x, of, int((at == low).sum()), threshold)
            found += [(int(places[i]), int(places[j])) for i, j in near]
        kept = np.array(found, dtype=np.int64).reshape(-1, 2)
        keys = rows["key"].combine_chunks()
        return pa.table({"a": keys.take(pa.array(kept[:, 0])), "b": keys.take(pa.array(kept[:, 1]))})

    return dealt.groupBy("low", "high").applyInArrow(compare, f"a {kind}, b {kind}")


def neighbours(
    x: np.ndarray, runs: np.ndarray, own: int, threshold: float
) -> list[tuple[int, int]]:
    """Near pairs in windows over rows in order; the first ``own`` are the block's, the rest context.

    ``runs`` has a column of length, pass and head for each row. A window never leaves its pass.
    """
    found: list[tuple[int, int]] = []
    borders = np.flatnonzero((runs[:, 1:own] != runs[:, : own - 1]).any(axis=0)) + 1 if own > 1 else []
    edges = [0, *borders, own]
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        if end - start > 1:
            places = np.arange(start, end)
            found += linked(x, places, places, threshold)
    for ahead in range(1, min(NEXT, len(x) - 1) + 1):
        left = np.arange(min(own, len(x) - ahead))
        right = left + ahead
        # Of one pass, but not of one run, which has been compared.
        new = (runs[1, left] == runs[1, right]) & ((runs[2, left] != runs[2, right]) | (right >= own))
        left, right = left[new], right[new]
        near = np.einsum("ij,ij->i", x[left], x[right]) >= threshold
        found += zip(left[near].tolist(), right[near].tolist(), strict=True)
    return forest(found)


def _links(members: DataFrame, threshold: float, kind: str) -> DataFrame:
    """``key, links``: the ids that a class links with, over all members of its component."""
    sizes = members.groupBy("component").agg(F.count("*").alias("members"))
    tiles = F.ceil(F.col("members") / TILE).cast("int")
    own = F.pmod(F.xxhash64("key"), tiles).cast("int")
    dealt = (
        members.join(sizes.where("members > 1"), "component")
        .select("component", "key", "vector", "ids", own.alias("own"), tiles.alias("tiles"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
    )

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        low, high = int(rows["low"].iloc[0]), int(rows["high"].iloc[0])
        x = unit(np.stack(rows["vector"].to_numpy()).astype(np.float64))
        ids, keys, own = (rows[c].to_numpy() for c in ("ids", "key", "own"))
        total = np.zeros(len(rows), dtype=np.int64)
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        for start in range(0, len(left), TILE):
            part = left[start : start + TILE]
            near = x[part] @ x[right].T >= threshold
            if low == high:
                near &= part[:, None] != right[None, :]
            total[part] += near @ ids[right]
            if low != high:
                total[right] += ids[part] @ near
        return pd.DataFrame({"key": keys, "links": total})

    # By the whole key: the rows come dealt out by component, which would keep one in one task.
    tile = ["component", "low", "high"]
    counted = dealt.repartition(*tile).groupBy(*tile).applyInPandas(count, f"key {kind}, links long")
    return counted.groupBy("key").agg(F.sum("links").alias("links"))


def deduplicate(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.9,
) -> DataFrame:
    """``key, n_links, component_id, kept`` of each row.

    Found are pairs that are neighbours in the order of a pass or share a head there, all but
    ``MISS`` of those at the threshold, and all pairs inside the components that these connect.
    """
    prepare(vectors.sparkSession)
    kind = vectors.schema[key].dataType.simpleString()
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    good = rows.where(F.col("key").isNotNull() & usable(F.col("vector")))
    # Two seeds: 128 bits tell the classes of equal vectors apart.
    digest = F.array(F.xxhash64("vector"), F.xxhash64("vector", F.lit(SEED)))
    marked = good.withColumn("digest", digest)
    classes = cut(
        marked.groupBy("digest", "key")
        .agg(F.first("vector").alias("vector"))
        .groupBy("digest")
        .agg(F.min("key").alias("key"), F.first("vector").alias("vector"), F.count("*").alias("ids"))
    )
    labels = components(near_edges(classes, threshold))
    members = cut(classes.join(labels, "key"))
    links = _links(members.select("component", "key", "vector", "ids"), threshold, kind)
    summary = (
        classes.select("digest", F.col("key").alias("class"), "ids")
        .join(labels.withColumnRenamed("key", "class"), "class", "left")
        .join(links.withColumnRenamed("key", "class"), "class", "left")
    )
    linked = (
        marked.select("key", "digest")
        .distinct()
        .join(summary, "digest")
        .groupBy("key")
        .agg(
            F.sum(F.coalesce("links", F.lit(0)) + F.col("ids") - 1).alias("n_links"),
            F.min(F.coalesce("component", "class")).alias("component_id"),
        )
    )
    return rows.select("key").join(linked, "key", "left").select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "key").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "key") == F.col("key"), F.lit(True)).alias("kept"),
    )
