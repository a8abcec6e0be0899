"""Best-fit packing of token pieces into sequences, by hierarchical residual packing.

Each input partition packs its own pieces best-fit, longest first, and emits the nearly full
sequences. Underfull sequences become the items of the next round: they meet in groups of a
fixed size, are packed again as wholes, and what is still underfull goes on, until one group
held them all or a round no longer merges anything.

Nulls and edge cases: a null text is empty and has the closing id alone; rows that repeat an id
are packed one by one; an empty table gives no row; extra columns are not read. A text of any
length is cut, so a piece never exceeds a sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorameter.llm.common import cut, prepare
from agorameter.llm.tokens import encoder

SIZE = 2048
#: Sequences with at most this many free places are emitted at once.
SLACK = 8
#: Most items that are packed together in one task.
ITEMS = 50_000
#: A round that merges away less than this share of its items is the last.
GAIN = 0.01
PIECE = "{key} {type}, piece int, start long, length long, ids_crc32 long"


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and place of each item, longest items first, each into the fullest bin."""
    bins = np.zeros(len(lengths), dtype=np.int64)
    places = np.zeros(len(lengths), dtype=np.int64)
    free: list[list[int]] = [[] for _ in range(size + 1)]  # open bins by free places
    some = 0  # bit f: a bin with f free places is open
    made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fits = some >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            target = free[room].pop()
            if not free[room]:
                some ^= 1 << room
        else:
            room, target, made = size, made, made + 1
        bins[i], places[i] = target, size - room
        left = room - length
        if left:
            if not free[left]:
                some |= 1 << left
            free[left].append(target)
    return bins, places


def _packed(lengths: np.ndarray, size: int, first: int) -> dict[str, np.ndarray]:
    bins, places = best_fit(lengths, size)
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    return {"bin": bins + first, "offset": places, "fill": fill[bins]}


def pack(
    docs: DataFrame,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    size: int = SIZE,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: its document, extent and checksum, its sequence and place in it.

    ``with_ids`` adds the ids of the piece, from which :func:`sequences` builds sequences.
    """
    spark = prepare(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    shape = PIECE.format(key="key", type=kind) + (", ids binary" if with_ids else "")
    end = np.array([end_id], dtype="<u4").tobytes()

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        first = (TaskContext.get().partitionId() << 34) if TaskContext.get() else 0
        rows: list[tuple] = []
        schema = None
        for batch in batches:
            schema = schema or batch.schema.field("key").type
            texts = batch.column("text").to_pylist()
            for name, body in zip(batch.column("key").to_pylist(), texts, strict=True):
                ids = encode(body or "") + end
                total = len(ids) // 4
                for piece, start in enumerate(range(0, total, size)):
                    part = ids[4 * start : 4 * (start + size)]
                    row = (name, piece, start, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, part) if with_ids else row)
            while len(rows) >= ITEMS:
                yield local(rows[:ITEMS], first, schema)
                rows, first = rows[ITEMS:], first + ITEMS
        if rows:
            yield local(rows, first, schema)

    def local(rows: list[tuple], first: int, key_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        lengths = np.array(columns[3], dtype=np.int64)
        arrays = {
            "key": pa.array(columns[0], key_type),
            "piece": pa.array(columns[1], pa.int32()),
            **{
                name: pa.array(columns[i], pa.int64())
                for i, name in enumerate(("start", "length", "ids_crc32"), 2)
            },
        }
        if with_ids:
            arrays["ids"] = pa.array(columns[5], pa.binary())
        for name, values in _packed(lengths, size, first).items():
            arrays[name] = pa.array(values)
        return pa.RecordBatch.from_pydict(arrays)

    columns = f"{shape}, bin long, offset long, fill long"
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    packed = cut(texts.mapInArrow(tokenized, columns))
    done, level = [packed.where(F.col("fill") >= size - SLACK)], 0
    open_rows = packed.where(F.col("fill") < size - SLACK)
    while True:
        level += 1
        items = open_rows.select("bin").distinct().count()
        groups = -(-items // ITEMS)
        if items < 2:
            break
        open_rows = cut(_merge(open_rows, groups, level, size, columns))
        done.append(open_rows.where(F.col("fill") >= size - SLACK))
        open_rows = open_rows.where(F.col("fill") < size - SLACK)
        if groups == 1:
            break
        merged = done[-1].select("bin").distinct().count()
        left = open_rows.select("bin").distinct().count()
        if merged + left > (1 - GAIN) * items:
            break
    for part in done:
        open_rows = open_rows.unionByName(part)
    names = ["piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    del spark
    return open_rows.select(
        F.col("key").alias(key), *names, F.col("bin").alias("sequence_id"), "offset"
    )


def _merge(rows: DataFrame, groups: int, level: int, size: int, columns: str) -> DataFrame:
    """Pack whole underfull sequences again, in groups; their pieces move along."""

    def again(part: pd.DataFrame) -> pd.DataFrame:
        ids, inverse = np.unique(part["bin"].to_numpy(), return_inverse=True)
        fills = np.zeros(len(ids), dtype=np.int64)
        fills[inverse] = part["fill"].to_numpy()
        group = int(part["group"].iloc[0])
        packed = _packed(fills, size, (level << 56) + (group << 28))
        part = part.drop(columns="group")
        part["offset"] = part["offset"].to_numpy() + packed["offset"][inverse]
        part["bin"], part["fill"] = packed["bin"][inverse], packed["fill"][inverse]
        return part

    group = F.pmod(F.xxhash64("bin", F.lit(level)), F.lit(groups))
    return rows.withColumn("group", group).groupBy("group").applyInPandas(again, columns)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id`` and ``ids``, an array of at most ``size`` ids."""

    def join(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("offset")
        ids = np.frombuffer(b"".join(part["ids"]), dtype="<u4").astype(np.int64)
        return pd.DataFrame({"sequence_id": part["sequence_id"].iloc[:1], "ids": [ids.tolist()]})

    return (
        packed.select("sequence_id", "offset", "ids")
        .groupBy("sequence_id")
        .applyInPandas(join, "sequence_id long, ids array<long>")
    )
