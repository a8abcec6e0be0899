"""Exact duplicates by Patricia tries over partitions of length and content hash.

Two texts are equal if they are after each run of ASCII white space became one space.

1. Every row gets the length and the digest of its text. Texts whose length and content hash
   stand alone have no copy and go no further.
2. The other texts are put into a compressed radix trie in the task that reads them, so copies
   within a stretch of input leave it as one row with its smallest id and its number of rows.
3. These rows are dealt out by length and hash into buckets of bounded size. One trie per
   bucket takes their full byte strings; a terminal node holds the smallest id of its text.
4. A trie that outgrows ``BUDGET`` spills its heaviest subtrees: their terminals leave the task
   as rows named after the subtree, and so do all texts that run into its stub later. The
   spilled subtrees are the buckets of the next round, until none is left.

Nulls and edge cases: a null text is an empty one; an empty text is a text like any other; a
null id is larger than all others, so such a row stays only where no copy has an id; of rows
that share text and smallest id one stays; an empty table gives no row; columns other than
the id and the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorameter.llm.common import SLOTS, cut, id_filter, join_groups, prepare
from agorameter.llm.words import SPACES

#: Bytes of different texts in a bucket, on average.
BUCKET = 1 << 20
#: Bytes that a trie holds before it spills subtrees, and what a node counts besides its label.
BUDGET = 1 << 25
NODE = 200
#: Bytes of texts in a batch that leaves a task.
SENT = 1 << 23

ROW = "bucket long, subtree binary, length long, digest binary, data binary, least long, n long, n_least long"


def normalised(data: bytes | None) -> bytes:
    """The text with each run of ASCII white space as one space."""
    data = (data or b"").translate(SPACES)
    while b"  " in data:
        data = data.replace(b"  ", b" ")
    return data


class Owner:
    """A text's smallest id, its rows, its rows with that id, and its digest."""

    __slots__ = ("least", "n", "n_least", "digest")

    def __init__(self, least: int | None, n: int, n_least: int, digest: bytes):
        self.least, self.n, self.n_least, self.digest = least, n, n_least, digest

    def join(self, other: Owner) -> None:
        self.n += other.n
        if other.least == self.least:
            self.n_least += other.n_least
        elif self.least is None or (other.least is not None and other.least < self.least):
            self.least, self.n_least = other.least, other.n_least


class _Node:
    __slots__ = ("label", "children", "owner", "stub")

    def __init__(self, label: bytes, owner: Owner | None = None):
        self.label, self.owner = label, owner
        self.children: dict[int, _Node] = {}
        self.stub = False


def _shared(a: bytes, b: bytes, start: int) -> int:
    """How many bytes ``a`` and ``b[start:]`` have in common at their beginning."""
    low, high = 0, min(len(a), len(b) - start)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[start + low : start + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A radix trie over byte strings, each edge labelled with all bytes up to the next fork."""

    def __init__(self) -> None:
        self.root = _Node(b"")
        self.held = 0
        self.terminals = 0

    def insert(self, key: bytes, owner: Owner) -> bytes | None:
        """Add a string; if its subtree was spilled, only return the path to it."""
        node, place = self.root, 0
        while place < len(key):
            child = node.children.get(key[place])
            if child is None:
                leaf = _Node(key[place:], owner)
                node.children[key[place]] = leaf
                self.held += len(leaf.label) + NODE
                self.terminals += 1
                return None
            if child.stub:
                return key[: place + 1]
            if not key.startswith(child.label, place):
                shared = _shared(child.label, key, place)
                fork = _Node(child.label[:shared])
                child.label = child.label[shared:]
                fork.children[child.label[0]] = child
                node.children[key[place]] = fork
                self.held += NODE
                child = fork
            place += len(child.label)
            node = child
        if node.owner is None:
            node.owner = owner
            self.terminals += 1
        else:
            node.owner.join(owner)
        return None

    def owners(self, node: _Node | None = None, path: bytes = b"") -> Iterator[tuple[bytes, Owner]]:
        """All strings below a node, ``path`` leading to it, with their owners."""
        stack = [(self.root if node is None else node, path)]
        while stack:
            node, path = stack.pop()
            whole = path + node.label
            if node.owner is not None:
                yield whole, node.owner
            stack.extend((child, whole) for child in node.children.values())

    def _weights(self) -> tuple[dict[int, int], set[int]]:
        """What every subtree holds, and which hold a stub, by the identity of their tops."""
        order, stack = [], [self.root]
        while stack:
            node = stack.pop()
            order.append(node)
            stack.extend(node.children.values())
        weights, open_ones = {}, set()
        for node in reversed(order):
            below = [id(c) for c in node.children.values()]
            weights[id(node)] = sum(weights[c] for c in below)
            weights[id(node)] += 0 if node.stub else len(node.label) + NODE
            if node.stub or any(c in open_ones for c in below):
                open_ones.add(id(node))
        return weights, open_ones

    def spill(self, most: int, stubs: bool) -> Iterator[tuple[bytes, bytes, Owner]]:
        """Take out the heaviest subtrees until ``most`` bytes are left, or none can go.

        Gives ``(path, string, owner)`` of their terminals, all of one subtree with the path of
        its top. With ``stubs`` a stub stays in its place and turns later strings away, so a
        subtree that already holds one stays, and only what hangs from it can go.
        """
        weights, open_ones = self._weights()
        node, path = self.root, b""
        while len(node.children) == 1 and node.owner is None:
            child = next(iter(node.children.values()))
            if child.stub or not child.children:
                break
            node, path = child, path + child.label
        # A string that ends at a fork stays, all others are below one of its children.
        found, stack = [], [(node, path)]
        while stack:
            node, path = stack.pop()
            for first, child in node.children.items():
                if id(child) not in open_ones:
                    found.append((weights[id(child)], path, first, node))
                elif not child.stub:
                    stack.append((child, path + child.label))
        for weight, path, first, node in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if self.held <= most:
                break
            child = node.children[first]
            for whole, owner in self.owners(child, path):
                yield path + bytes([first]), whole, owner
                self.terminals -= 1
            self.held -= weight
            if stubs:
                child.stub, child.children, child.owner, child.label = True, {}, None, b""
            else:
                del node.children[first]


class _Sender:
    """Rows of :data:`ROW` in batches of bounded size."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.held = 0

    def add(self, bucket: int, subtree: bytes, data: bytes, owner: Owner, whole: bool = True):
        row = (bucket, subtree, len(data), owner.digest, data if whole else None)
        self.rows.append((*row, owner.least, owner.n, owner.n_least))
        self.held += NODE + (len(data) if whole else 0)
        if self.held >= SENT:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            names = [c.split()[0] for c in ROW.split(", ")]
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary()] + [pa.int64()] * 3
            columns = zip(*self.rows, strict=True)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        self.rows, self.held = [], 0


def content_hash(digest: bytes) -> int:
    """The 64 bits of a digest that rows are dealt out by."""
    return int.from_bytes(digest[:8], "little", signed=True)


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, length, hash, digest`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, hashes, digests = [], [], []
            for data in batch.column(1).to_pylist():
                data = normalised(data)
                digest = hashlib.sha256(data).digest()
                lengths.append(len(data))
                hashes.append(content_hash(digest))
                digests.append(digest)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(lengths, pa.int64()),
                    pa.array(hashes, pa.int64()),
                    pa.array(digests, pa.binary()),
                ],
                names=("doc_id", "length", "hash", "digest"),
            )

    return docs.mapInArrow(run, "doc_id long, length long, hash long, digest binary")


def _combined(rows: DataFrame, again: np.ndarray, buckets: int, budget: int) -> DataFrame:
    """One row per text and stretch of input, in the form :data:`ROW`.

    ``again`` is a filter of the hashes that more than one row has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, sender = Trie(), _Sender()

        def send(found):
            for _, data, owner in found:
                bucket = (content_hash(owner.digest) ^ len(data)) % buckets
                yield from sender.add(bucket, b"", data, owner)

        for batch in batches:
            for key, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = normalised(data)
                digest = hashlib.sha256(data).digest()
                place = content_hash(digest) % SLOTS
                if not again[place >> 6] >> (place & 63) & 1:
                    continue
                trie.insert(data, Owner(key, 1, 1, digest))
                if trie.held > budget:
                    yield from send(trie.spill(budget // 2, stubs=False))
        yield from send((b"", data, owner) for data, owner in trie.owners())
        yield from sender.flush()

    return rows.mapInArrow(run, ROW)


def _round(texts: DataFrame, budget: int) -> DataFrame:
    """Owners of all texts of each bucket, without ``data``; what was spilled keeps it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, sender, current, limit = Trie(), _Sender(), None, budget

        def settled():
            for data, owner in trie.owners():
                yield from sender.add(*current, data, owner, whole=False)

        def named(path: bytes) -> bytes:
            return hashlib.blake2b(path, digest_size=16).digest()

        for batch in batches:
            for bucket, subtree, _, digest, data, least, n, ties in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if (bucket, subtree) != current:
                    yield from settled()
                    trie, current, limit = Trie(), (bucket, subtree), budget
                owner = Owner(least, n, ties, digest)
                path = trie.insert(data, owner)
                if path is not None:
                    yield from sender.add(bucket, named(path), data, owner)
                elif trie.held > limit and trie.terminals > 1:
                    for path, whole, cut_off in trie.spill(budget // 2, stubs=True):
                        yield from sender.add(bucket, named(path), whole, cut_off)
                    # Forks above stubs stay; they must not start a spill with every text.
                    limit = max(budget, 2 * trie.held)
        yield from settled()
        yield from sender.flush()

    dealt = texts.repartition("bucket", "subtree").sortWithinPartitions("bucket", "subtree")
    return dealt.mapInArrow(run, ROW)


def owners(texts: DataFrame, budget: int = BUDGET) -> DataFrame:
    """``length, digest, keep_id, n, n_least`` of each text of a table in the form :data:`ROW`."""
    parts = []
    while True:
        done = cut(_round(texts, budget))
        parts.append(done.where("data IS NULL"))
        texts = done.where("data IS NOT NULL")
        if texts.isEmpty():
            break
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.select("length", "digest", F.col("least").alias("keep_id"), "n", "n_least")


def groups(docs: DataFrame, budget: int = BUDGET, bucket: int = BUCKET) -> DataFrame:
    """Each row's ``doc_id, keep_id, group_size, kept, text_sha256``."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("data"))
    keyed = cut(_keyed(rows).withColumn("row", F.monotonically_increasing_id()))
    again = cut(keyed.groupBy("length", "hash").count().where("count > 1"))
    size = again.agg(F.sum("length")).first()[0] or 0
    seen = id_filter(again, "hash", F.pmod("hash", F.lit(SLOTS)))
    texts = _combined(rows, seen, max(1, -(-size // bucket)), budget)
    found = cut(owners(texts, budget))
    met = join_groups(keyed, found.where("n > 1"), ["length", "digest"], "n")
    least = F.col("n").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))
    if not found.where("n_least > 1").isEmpty():
        met = cut(met)
        tied = met.where(least & (F.col("n_least") > 1))
        first = tied.groupBy("length", "digest").agg(F.min("row").alias("row"))
        first = first.select("row", F.lit(True).alias("first"))
        met = met.join(first, "row", "left")
        least &= F.coalesce("n_least", F.lit(1)).eqNullSafe(1) | F.coalesce("first", F.lit(False))
    return met.select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        least.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns.

    Equal rows with one id differ in white space at most; any of them stays.
    """

    @F.pandas_udf("string")
    def digest(data):
        import pandas as pd

        return pd.Series([hashlib.sha256(normalised(x)).hexdigest() for x in data], dtype=object)

    found = groups(docs).where("kept").select("doc_id", "text_sha256").distinct()
    rows = docs.select(
        F.struct(*docs.columns).alias("own"),
        F.col("doc_id").cast("long").alias("key"),
        digest(F.col("text").cast("binary")).alias("digest"),
    )
    met = rows.join(
        found, rows["key"].eqNullSafe(found["doc_id"]) & (rows["digest"] == found["text_sha256"])
    )
    return met.dropDuplicates(["key", "digest"]).select("own.*")
