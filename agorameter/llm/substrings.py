"""Removal of repeated runs of words, by level-wise doubling of windows.

Windows of a starting length that repeat are extended to twice that length, level by level, up
to the asked window or until no candidate survives. Longer windows need no level: a word that
one of them would remove is removed by the repeated windows inside it.

* The first level reads every text but keeps a window only if its hash is the least among the
  neighbours of one asked window (winnowing). A repeated window holds the same least one at
  each of its places, so none is lost, and about a sixth of the places is left.
* A later level hashes only the windows inside the reach of surviving ones.
* A task compares its own windows before the shuffle and sends one row per different hash, so
  a passage in a third of all rows arrives as one row per stretch of input. Rows it already
  knows to be repeated travel under keys of their own.
* A document whose whole word sequence equals an earlier one's takes no part in later levels:
  all its windows start earlier in that one.

Nulls and edge cases: a null text has no words; texts shorter than the window are kept; ties
cannot occur, as a place is a document and a start; rows that share an id hold one text and
are one document, so they don't remove each other's words; a null id sorts first; an empty table gives no row;
extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agorameter.llm.common import among, cut, id_filter, maybe_among, prepare, slot
from agorameter.llm.words import SPACES, mix, window_hashes, word_hashes

WINDOW = 20
#: Windows that a task gathers before it compares and sends them.
STRETCH = 1 << 17


class _Sender:
    """Gathers windows of a task; sends the first of each hash, and the others as known."""

    def __init__(self, key_type: pa.DataType):
        self.key_type = key_type
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.keys: list = []
        self.size = 0

    def add(self, key, starts: np.ndarray, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(starts):
            self.parts.append((starts, hashes))
            self.keys.append(key)
            self.size += len(starts)
        if self.size >= STRETCH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        starts = np.concatenate([p[0] for p in self.parts])
        hashes = np.concatenate([p[1] for p in self.parts])
        own = np.repeat(np.arange(len(self.keys)), [len(p[0]) for p in self.parts])
        ordered = sorted({k for k in self.keys if k is not None})
        place = {None: -1} | {k: i for i, k in enumerate(ordered)}
        ranks = np.array([place[k] for k in self.keys])
        order = np.lexsort((starts, ranks[own], hashes))
        table = np.stack((hashes.view(np.int64), ranks[own], starts))[:, order]
        other = np.ones(len(order), dtype=bool)  # a place that rows with one id share counts once
        other[1:] = (table[:, 1:] != table[:, :-1]).any(axis=0)
        order = order[other]
        hashes, starts, own = hashes[order], starts[order], own[order]
        first = np.ones(len(hashes), dtype=bool)
        first[1:] = hashes[1:] != hashes[:-1]
        group = np.cumsum(first) - 1
        copies = np.bincount(group)[group]
        places = mix(own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + starts.astype(np.uint64))
        sent = np.where(first, hashes, mix(hashes ^ places))
        keys = pa.array(self.keys, self.key_type)
        for i in range(0, len(sent), 1 << 17):
            part = slice(i, i + (1 << 17))
            yield pa.RecordBatch.from_pydict(
                {
                    "hash": pa.array(sent[part].view(np.int64)),
                    "key": keys.take(pa.array(own[part])),
                    "start": pa.array(starts[part].astype(np.int32)),
                    "known": pa.array(~first[part]),
                    "copies": pa.array(np.minimum(copies[part], 2).astype(np.int8)),
                }
            )
        self.parts, self.keys, self.size = [], [], 0


def winnowed(words: np.ndarray, size: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows of ``size`` words that are least in some ``window``."""
    hashes = window_hashes(words, size)
    span = window - size + 1
    if len(hashes) < span:
        return np.zeros(0, dtype=np.int64), hashes[:0]
    near = sliding_window_view(hashes, span)
    starts = np.unique(near.argmin(axis=1) + np.arange(len(near)))
    return starts, hashes[starts]


def within_reach(survivors: np.ndarray, size: int, longer: int, window: int, n: int) -> np.ndarray:
    """Starts of the ``longer`` windows in any asked window that holds a survivor of ``size``."""
    edges = np.zeros(n + 1, dtype=np.int64)
    low = np.maximum(survivors - (window - size), 0)
    high = np.minimum(survivors + window - longer, n - longer)
    good = high >= low
    np.add.at(edges, low[good], 1)
    np.add.at(edges, high[good] + 1, -1)
    return np.flatnonzero(np.cumsum(edges[:n]) > 0)


def _first_level(docs: DataFrame, size: int, window: int, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = None
        for batch in batches:
            sender = sender or _Sender(batch.schema.field(0).type)
            for key, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield from sender.add(key, *winnowed(word_hashes(data or b"", SPACES), size, window))
        if sender:
            yield from sender.flush()

    return docs.mapInArrow(run, schema)


def _next_level(docs: DataFrame, size: int, window: int, schema: str) -> DataFrame:
    longer = min(2 * size, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = None
        for batch in batches:
            sender = sender or _Sender(batch.schema.field(0).type)
            for key, data, starts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = word_hashes(data or b"", SPACES)
                survivors = np.array(starts, dtype=np.int64)
                reach = within_reach(survivors, size, longer, window, len(words))
                yield from sender.add(key, reach, window_hashes(words, longer)[reach])
        if sender:
            yield from sender.flush()

    return docs.mapInArrow(run, schema)


def _surviving(sent: DataFrame, last: bool) -> DataFrame:
    """Starts per document: of repeated windows, at the last level of those not the first."""
    same = Window.partitionBy("hash", "known")
    if last:
        again = F.rank().over(same.orderBy("key", "start")) > 1
    else:
        again = F.sum("copies").over(same) > 1
    return (
        sent.select("key", "start", (F.col("known") | again).alias("again"))
        .where("again")
        .groupBy("key")
        .agg(F.collect_list("start").alias("starts"))
    )


def _with_key(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("data"))


def _joined(rows: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the key, a null one equal to itself."""
    return rows.join(other, rows["key"].eqNullSafe(other["key"]), how).drop(other["key"])


def whole_copies(rows: DataFrame, window: int) -> DataFrame:
    """Keys of documents whose word sequence, at least a window long, an earlier one has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, digests = [], []
            for i, data in enumerate(batch.column(1).to_pylist()):
                words = (data or b"").translate(SPACES).split()
                if len(words) >= window:
                    kept.append(i)
                    digests.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(kept, pa.int64())), pa.array(digests, pa.binary())],
                names=("key", "digest"),
            )

    kind = rows.schema["key"].dataType.simpleString()
    found = cut(rows.mapInArrow(run, f"key {kind}, digest binary"))
    # A struct orders a null key first, where min() alone would skip it.
    first = found.groupBy("digest").agg(F.min(F.struct("key")).alias("first"), F.count("*").alias("n"))
    return (
        found.join(first.where("n > 1"), "digest")
        .where(~F.col("key").eqNullSafe(F.col("first.key")))
        .select("key")
        .distinct()
    )


def repeated_starts(docs: DataFrame, key: str, text: str, window: int, start: int) -> DataFrame:
    """``key``, ``starts`` of windows that also start earlier, ``copy``: a whole copy has none."""
    rows = _with_key(docs, key, text)
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"hash long, key {kind}, start int, known boolean, copies byte"
    copies = cut(whole_copies(rows, window))
    size = min(start, window)
    last = size == window
    survivors = _surviving(_first_level(rows, size, window, schema), last)
    if last:
        survivors = _joined(survivors, copies, "left_anti")
    while not last:
        alone = cut(_joined(survivors, copies, "left_anti"))
        chosen = rows.where(maybe_among(id_filter(alone, "key"), "key"))
        longer = min(2 * size, window)
        last = longer == window
        sent = _next_level(
            _joined(chosen, alone).select("key", "data", "starts"), size, window, schema
        )
        survivors, size = _surviving(sent, last), longer
    starts = survivors.withColumn("copy", F.lit(False)).unionByName(
        copies.select("key", F.array().cast("array<int>").alias("starts"), F.lit(True).alias("copy"))
    )
    return cut(starts)


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    start: int | None = None,
    keep: list[str] | None = None,
    digest: bool = False,
) -> DataFrame:
    """Each row with ``n_words``, ``n_removed`` and the kept words joined by one space.

    Removed is each word in a window whose words also start earlier: in a document with a
    smaller id, or earlier in the same one. The kept words replace the text if any word is
    removed, or with ``digest`` come as ``kept_sha256`` for every row. ``keep`` names the
    columns to return besides, by default all; those that have a new name go.
    """
    prepare(docs.sparkSession)
    starts = repeated_starts(docs, key, text, window, start or max(1, window // 2))
    made = {"n_words", "n_removed", "kept_sha256" if digest else text}
    columns = list(docs.columns if keep is None else keep)
    columns = [c for c in columns if c == text or c not in made]
    carried = [F.lit(0).alias("__"), *(F.col(c) for c in columns if digest or c != text)]
    own = F.struct(*carried).alias("own")
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("data"), own)
    bitmap = id_filter(starts, "key")
    # Rows that stay as they are are left out or kept by the function that makes the result: a
    # filter before it would be a second Python worker in the same task.
    apart = rows.select(
        "data",
        F.lit(None).cast("array<int>").alias("starts"),
        F.lit(None).cast("boolean").alias("copy"),
        "own",
        slot("key").alias("slot"),
    )
    met = _joined(rows.where(maybe_among(bitmap, "key")), starts, "left").select(
        "data", "starts", "copy", "own"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_columns == 5:
                batch = batch.filter(pa.array(~among(bitmap, batch.column(4).to_numpy())))
            sizes, removed, kept = [], [], []
            for data, first, copy in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = (data or b"").translate(SPACES).split()
                if copy:
                    left = []
                elif first:
                    edges = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(edges, first, 1)
                    np.add.at(edges, np.array(first) + window, -1)
                    left = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
                else:
                    left = words
                sizes.append(len(words))
                removed.append(len(words) - len(left))
                if digest:
                    kept.append(hashlib.sha256(b" ".join(left)).hexdigest())
                else:
                    kept.append(data if len(left) == len(words) else b" ".join(left))
            if digest:
                last = pa.array(kept, pa.string())
            else:
                last = pa.array(kept, pa.binary())
            arrays = [batch.column(3), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), last]
            yield pa.RecordBatch.from_arrays(arrays, names=("own", "n_words", "n_removed", "kept"))

    schema = apart.select("own").schema.add("n_words", "long").add("n_removed", "long")
    schema = schema.add("kept", "string" if digest else "binary")
    result = apart.mapInArrow(run, schema).unionByName(met.mapInArrow(run, schema))
    if digest:
        last = F.col("kept").alias("kept_sha256")
        return result.select(*(F.col(f"own.`{c}`") for c in columns), "n_words", "n_removed", last)
    values = [F.col("kept").cast("string").alias(c) if c == text else F.col(f"own.`{c}`") for c in columns]
    return result.select(*values, F.col("n_words"), F.col("n_removed"))
