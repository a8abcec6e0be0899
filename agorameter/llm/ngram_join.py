"""Jaccard self-join on word shingles by token-combination prefixes.

Each text becomes the set of the hashes of its shingles, sorted by how often a hash falls into
its slot of a table counted over the whole corpus, rarest first. Texts with equal sets are one
class. Two linked sets of different classes share

* a token among the first ``n - ceil(t n) + 1`` of both; where it is rare it is indexed alone, or
* only frequent tokens. Then the prefix is extended so far that the errors which the threshold
  allows cannot break all pairs of neighbouring frequent tokens, and these pairs are indexed:
  a token missing on the other side breaks two pairs, one that is only there breaks one.

Entries are split by classes of sizes that can link. The members of an entry are compared
with the smallest one only, its pivot, which joins most groups of copies. Then the members
that are still in different components are compared with each other, in tiles of bounded size
inside a task: a profile of 128 bytes, counts and parities of the tokens by parts of their hash,
bounds the overlap of two sets from above, and only pairs that the bound lets through leave the task. All
such candidates are verified on the whole sets, so no link is lost and none is wrong, and no
group emits all its pairs.

Nulls and edge cases: a null text or one without words has an empty set and links with
nothing, like a row without an id, whose component is null; rows that share an id hold one
text and count as one document; an empty table gives no row; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorameter.llm.common import among, cut, id_filter, prepare, slot
from agorameter.llm.graph import components
from agorameter.llm.words import LOWER, mix, window_hashes, word_hashes

#: Slots of the table of token counts: fixed in size however large the corpus.
SLOT_BITS = 18
#: Members of an entry that meet in one tile, on either side.
TILE = 512
#: Parts that a profile counts the tokens in, and those of which it keeps the parity, in bytes.
PARTS = 64
PARITY = 64
#: Sets from this size on have parities of as many more parts, so that they don't fill up.
LARGE = 1024
LARGE_PARITY = 1024


def shingles(data: bytes | None, size: int) -> np.ndarray:
    """The sorted set of a text's shingles; a shorter text is one shingle."""
    words = word_hashes(data or b"", LOWER)
    return np.unique(window_hashes(words, min(size, max(1, len(words)))))


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def token_counts(rows: DataFrame, size: int) -> np.ndarray:
    """Tokens of all documents per slot; a task sums up its documents first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, dtype=np.int64)
        for batch in batches:
            for data in batch.column(1).to_pylist():
                np.add.at(total, _slots(shingles(data, size)), 1)
        slots = np.flatnonzero(total)
        for i in range(0, len(slots), 1 << 16):
            part = slots[i : i + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"slot": pa.array(part), "n": pa.array(total[part])})

    summed = rows.mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = summed.toPandas()
    total = np.zeros(1 << SLOT_BITS, dtype=np.int64)
    total[found["slot"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    return total


def rare_limit(counts: np.ndarray) -> float:
    """A count that chance hardly reaches: a token beyond it is frequent."""
    mean = float(counts.mean())
    return mean + 8 * np.sqrt(mean) + 16


def signatures(tokens: np.ndarray, counts: np.ndarray, limit: float, percent: int) -> np.ndarray:
    """Index entries of a set: rare tokens of its prefix, or else pairs of frequent ones too."""
    n = len(tokens)
    by_slot = counts[_slots(tokens)]
    order = np.lexsort((tokens, by_slot))
    tokens, by_slot = tokens[order], by_slot[order]
    rare = int(np.searchsorted(by_slot, limit, side="right"))
    prefix = n - -(-percent * n // 100) + 1
    alone = mix(tokens[: min(prefix, rare)])
    if rare >= prefix:
        return alone
    # With a tokens missing in the other set and b only there, a + t b <= (1 - t) n. The rare
    # tokens are all missing, so at most 2 ((1 - t) n - rare) pairs are broken.
    longer = 2 * ((100 - percent) * n - 100 * rare) // 100 + 2
    chosen = tokens[rare : rare + longer]
    pairs = mix(chosen[:-1] * np.uint64(0x9E3779B97F4A7C15) + chosen[1:] + np.uint64(1))
    return np.concatenate((alone, pairs))


def _indexed(rows: DataFrame, size: int, percent: int, shared, limit: float) -> DataFrame:
    """``key, n, digest, entries, profile`` of each document."""
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, entries, profiles = [], [], [], []
            for data in batch.column(1).to_pylist():
                tokens = shingles(data, size)
                sizes.append(len(tokens))
                digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                found = signatures(tokens, shared.value, limit, percent) if len(tokens) else tokens
                entries.append(found.view(np.int64))
                profiles.append(profile(tokens))
            offsets = np.concatenate(([0], np.cumsum([len(e) for e in entries])))
            values = np.concatenate(entries) if entries else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    lists,
                    pa.array(profiles, pa.binary()),
                ],
                names=("key", "n", "digest", "entries", "profile"),
            )

    schema = f"key {kind}, n long, digest binary, entries array<long>, profile binary"
    return rows.mapInArrow(run, schema)


def profile(tokens: np.ndarray) -> bytes:
    """The tokens in each part of the hash range, 255 for that many or more, and parities.

    The parities of the numbers of tokens are kept for more and other parts.
    """
    counted = np.bincount((tokens >> np.uint64(58)).astype(np.int64), minlength=PARTS)
    made = np.minimum(counted, 255).astype(np.uint8).tobytes() + _parities(tokens, PARITY)
    return made + _parities(tokens, LARGE_PARITY) if len(tokens) >= LARGE else made


def _parities(tokens: np.ndarray, size: int) -> bytes:
    parts = (tokens >> np.uint64(20)).astype(np.int64) % (8 * size)
    return np.packbits((np.bincount(parts, minlength=8 * size) & 1).astype(np.uint8)).tobytes()


def large_may_link(x: bytes, y: bytes, n: int, m: int, percent: int) -> bool:
    """The same as :func:`may_link` by the parities that only large sets have."""
    base = PARTS + PARITY
    if len(x) == base or len(y) == base:
        return True
    odd = np.frombuffer(x, np.uint8)[base:] ^ np.frombuffer(y, np.uint8)[base:]
    shared = (n + m - int(np.bitwise_count(odd).sum())) // 2
    return 100 * shared >= percent * (n + m - shared)


def may_link(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """False where the profiles prove that two sets of n and m tokens don't reach the threshold.

    Sets share at most the smaller count of each part, and differ in at least one token for
    each part of different parity.
    """
    counts_x, counts_y = x[..., :PARTS], y[..., :PARTS]
    shared = np.minimum(counts_x, counts_y).sum(axis=-1, dtype=np.int64)
    full = ((counts_x == 255) & (counts_y == 255)).any(axis=-1)
    shared = np.where(full, np.minimum(n, m), shared)
    differ = np.bitwise_count(x[..., PARTS:] ^ y[..., PARTS:]).sum(axis=-1, dtype=np.int64)
    shared = np.minimum(shared, (n + m - differ) // 2)
    return 100 * shared >= percent * (n + m - shared)


def _comparable(a: str, b: str, percent: int) -> Column:
    """Whether sets of these sizes can reach the threshold."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _sets(rows: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """``key, tokens`` of the documents in any pair, and a few others."""
    kind = rows.schema["key"].dataType.simpleString()
    needed = id_filter(pairs.select(F.explode(F.array("a", "b")).alias("key")), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(among(needed, batch.column(2).to_numpy()))
            sets = [shingles(data, size).tobytes() for data in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.binary())], names=("key", "tokens")
            )

    # The filter is looked up here, not by a second Python step that would get all texts.
    marked = rows.select("key", "data", slot("key").alias("slot"))
    return marked.mapInArrow(run, f"key {kind}, tokens binary")


def _profiles(made: list[bytes]) -> np.ndarray:
    """The parts of profiles that all sets have, as rows."""
    size = PARTS + PARITY
    return np.frombuffer(b"".join([p[:size] for p in made]), np.uint8).reshape(-1, size)


def _shared(entries: DataFrame) -> DataFrame:
    """The rows of entries with several members, with their number and the smallest key."""
    groups = entries.groupBy("entry").agg(F.count("*").alias("members"), F.min("key").alias("a"))
    return entries.join(groups.where("members > 1"), "entry")


def _by_size(entries: DataFrame, percent: int) -> DataFrame:
    """Shared entries, split by classes of sizes that reach the threshold with each other.

    A class spans sizes up to the ratio of the threshold, so two sets that can link are in the
    same or in neighbouring classes; each member goes to its class and to the next one. A
    class that only guests from the one before share has nothing new.
    """
    ratio = max(float(np.log(100 / percent)), 1e-6)
    # The small addend keeps sizes at the very ratio in neighbouring classes.
    level = F.floor(F.log("n") / (ratio + 1e-9))
    both = _shared(entries).select("entry", "key", "n", F.posexplode(F.array(level, level + 1)))
    members = both.select(F.xxhash64("entry", "col").alias("entry"), "key", "n", F.col("pos").alias("guest"))
    groups = members.groupBy("entry").agg(
        F.count("*").alias("members"), F.min("key").alias("a"), F.min("guest").alias("guests")
    )
    kept = groups.where("members > 1 AND guests = 0").drop("guests")
    return members.drop("guest").join(kept, "entry")


def _screened(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that the profiles let through."""
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(i).to_numpy() for i in (2, 3))
            x, y = (batch.column(i).to_pylist() for i in (4, 5))
            passed = may_link(_profiles(x), _profiles(y), n, m, percent)
            for i in np.flatnonzero(passed).tolist():
                passed[i] = large_may_link(x[i], y[i], int(n[i]), int(m[i]), percent)
            kept = pa.array(passed, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [c.filter(kept) for c in batch.columns[:2]], names=("a", "b")
            )

    one = classes.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("profile").alias("p_a"))
    two = classes.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("profile").alias("p_b"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "p_a", "p_b")
    return both.where(_comparable("n_a", "n_b", percent)).mapInArrow(run, f"a {kind}, b {kind}")


def _linked(pairs: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets reach the threshold."""
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(*(batch.column(i).to_pylist() for i in (2, 3)), strict=True):
                left, right = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(left, right, assume_unique=True))
                linked.append(100 * common >= percent * (len(left) + len(right) - common))
            kept = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [c.filter(kept) for c in batch.columns[:2]], names=("a", "b")
            )

    sets = _sets(rows, pairs, size)
    both = (
        pairs.join(sets.select(F.col("key").alias("a"), F.col("tokens").alias("x")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("tokens").alias("y")), "b")
        .select("a", "b", "x", "y")
    )
    return both.mapInArrow(run, f"a {kind}, b {kind}")


def _apart(index: DataFrame, labels: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of one entry in different components that the profiles let through.

    The members of an entry are dealt to tiles, and each pair of tiles is a run of rows in one
    task, of at most some two tiles of rows; only what passes the bound is emitted.
    """
    kind = index.schema["key"].dataType.simpleString()
    labelled = (
        index.where("members > 2")
        .join(labels, "key", "left")
        .select("entry", "members", "a", "key", "n", F.coalesce("component", "key").alias("label"))
    )
    mixed = (
        labelled.where("key <> a")
        .groupBy("entry")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low <> high")
        .select("entry")
    )
    tiles = F.ceil(F.col("members") / TILE).cast("int")
    own = F.pmod(F.xxhash64("key"), tiles).cast("int")
    dealt = (
        labelled.where("key <> a")  # the pivot has met all
        .join(mixed, "entry")
        .join(classes.select("key", "profile"), "key")
        .select("entry", "key", "n", "label", "profile", own.alias("own"), tiles.alias("tiles"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
        .select(
            "entry", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            "key", "n", "label", "profile", "own",
        )
    )
    run_of = ["entry", "low", "high"]

    def compare(rows: pa.Table) -> list[tuple]:
        keys, n, labels, own = (rows.column(c).to_numpy() for c in ("key", "n", "label", "own"))
        made = rows.column("profile").to_pylist()
        profiles = _profiles(made)
        low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        found = []
        for i in left.tolist():
            others = right[right > i] if low == high else right
            others = others[labels[others] != labels[i]]
            smaller, larger = np.minimum(n[others], n[i]), np.maximum(n[others], n[i])
            others = others[smaller * 100 >= larger * percent]
            if len(others):
                passed = may_link(profiles[others], profiles[i], n[others], n[i], percent)
                for j in others[passed].tolist():
                    if not large_may_link(made[i], made[j], int(n[i]), int(n[j]), percent):
                        continue
                    found.append((min(keys[i], keys[j]), max(keys[i], keys[j])))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def emit(found: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
            found = sorted(set(found))
            return pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in found], key_type) for i in (0, 1)], names=("a", "b")
            )

        for batch in batches:
            part = pa.Table.from_batches([batch])
            whole = part if rest is None else pa.concat_tables([rest, part])
            marks = np.stack([whole.column(c).to_numpy() for c in run_of])
            starts = np.flatnonzero(np.r_[True, (marks[:, 1:] != marks[:, :-1]).any(axis=0)])
            found: list[tuple] = []
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if b - a > 1:
                    found += compare(whole.slice(a, b - a))
            rest = whole.slice(int(starts[-1]))  # the last run may go on
            yield emit(found, batch.schema.field("key").type)
        if rest is not None and rest.num_rows > 1:
            yield emit(compare(rest), rest.schema.field("key").type)

    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.repartition(parts, *run_of).sortWithinPartitions(*run_of)
    return ordered.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` of each row.

    Sets of ``size`` words link from ``percent`` of Jaccard similarity; at least 80, so that
    a prefix has enough pairs. The component is the smallest key reachable by links.
    """
    if not 80 <= percent <= 100:
        raise ValueError("percent must be between 80 and 100")
    prepare(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("data"))
    counts = token_counts(rows, size)
    limit = rare_limit(counts)
    shared = rows.sparkSession.sparkContext.broadcast(counts)
    found = cut(_indexed(rows, size, percent, shared, limit))
    usable = found.where("n > 0 AND key IS NOT NULL")
    classes = cut(
        usable.groupBy("digest").agg(
            F.min("key").alias("key"),
            *(F.first(c).alias(c) for c in ("n", "entries", "profile")),
        )
    )
    entries = classes.select(F.explode("entries").alias("entry"), "key", "n")
    index = cut(_by_size(entries, percent))
    profiles = classes.select("key", "n", "profile")
    pivots = index.where("key <> a").select("a", F.col("key").alias("b")).distinct()
    first = cut(_screened(pivots, profiles, percent))
    edges = cut(_linked(first, rows, size, percent))
    second = cut(_apart(index, components(edges), profiles, percent))
    edges = edges.unionByName(_linked(second, rows, size, percent))
    labels = components(edges)
    return (
        found.select("key", "n", "digest")
        .join(classes.select("digest", F.col("key").alias("class")), "digest", "left")
        .join(labels.select(F.col("key").alias("class"), "component"), "class", "left")
        .select(
            F.col("key").alias(key),
            F.col("n").alias("n_shingles"),
            F.when(F.col("key").isNull(), None)
            .when(F.col("n") == 0, F.col("key"))
            .otherwise(F.coalesce("component", "class"))
            .alias("component_id"),
        )
    )
