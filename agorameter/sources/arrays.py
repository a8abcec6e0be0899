"""JSON arrays of any layout, read in parts by many tasks.

Spark cuts the files at closing braces, so that a piece of text is at most about a record long
wherever a part begins. What a piece means depends on all the text before it: whether it starts
inside a string, and how deep. Both follow from a structural scan in two steps:

1. Each part of a file counts its quotes, and its brackets for either start, in or out of a
   string. One small row per part is composed in order into the state at the start of each part.
   The sizes tell whether the last piece of a file ended with a brace or with the file.
2. Each part walks its pieces from that state. A record is complete where the depth returns to
   one. The ends of a part, which belong to records that cross a border, are put together by
   file and order.

A task holds one batch of pieces and one record; a record may span any number of parts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agorameter.session import shipped

#: What the state of a part says; a part of a file that is no array has the last one.
OUTSIDE, INSIDE, NO_ARRAY = 0, 1, 2
SPACE = " \t\r\n"
PARTS = "file string, block long, place int, value string, begun boolean"


def read_array_texts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``file, value, begun``: the text of each record, and whether it stands where one may.

    Text that is no record of an array comes too, not ``begun``: what follows an array or
    precedes it, a record without a comma before it, an array without an end, and the first
    piece of a file that does not begin like an array. The files are scanned once when this is
    called, for one row of some 25 bytes per part, and twice when the result is read.
    """
    shipped(spark)
    pieces = _pieces(spark, [paths] if isinstance(paths, str) else list(paths))
    states = spark.sparkContext.broadcast(_states(pieces))
    walked = pieces.mapInArrow(lambda batches: _walk(batches, states.value), PARTS)
    whole = walked.where("place IS NULL").select("file", "value", "begun")
    return whole.unionByName(_joined(walked.where("place IS NOT NULL")))


def _pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``key, file, block, value``: pieces that ended with a brace, in order within their part."""
    texts = spark.read.option("lineSep", "}").text(paths)
    block = F.col("_metadata.file_block_start")
    file = F.col("_metadata.file_path")
    size = (F.octet_length("value") + 1).cast("long").alias("size")
    extra = F.col("_metadata.file_size").alias("file_size")
    key = F.xxhash64(file, block).alias("key")
    return texts.select(key, file.alias("file"), block.alias("block"), "value", size, extra)


def _segments(value: str) -> list[str]:
    """The text between quotes; every second one is in a string."""
    return value.replace("\\\\", "").replace('\\"', "").split('"')


def _deeper(segments: list[str]) -> int:
    return sum(s.count("{") + s.count("[") - s.count("]") for s in segments)


def _runs(keys: np.ndarray) -> list[tuple[int, int]]:
    """The ranges of equal neighbours."""
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else []
    return list(zip(starts, [*starts[1:], len(keys)], strict=True))


def _states(pieces: DataFrame) -> tuple[np.ndarray, ...]:
    """Sorted keys of all parts, the state and the depth at their start, and the piece without brace."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row: list | None = None

        def emit() -> pa.RecordBatch:
            names = ("key", "file", "block", "odd", "outside", "inside", "array", "pieces", "size", "file_size")
            return pa.RecordBatch.from_pydict({n: [v] for n, v in zip(names, row, strict=True)})

        for batch in batches:
            keys = batch.column(0).to_numpy()
            for start, end in _runs(keys):
                if row is None or row[0] != int(keys[start]):
                    if row is not None:
                        yield emit()
                    file, block = (batch.column(i)[int(start)].as_py() for i in (1, 2))
                    first = (batch.column(3)[int(start)].as_py() or "").lstrip("\ufeff" + SPACE)
                    whole = batch.column(5)[int(start)].as_py()
                    row = [int(keys[start]), file, block, False, 0, 0, first.startswith("["), 0, 0, whole]
                odd, outside, inside = row[3:6]
                row[7] += int(end - start)
                row[8] += int(batch.column(4).slice(start, end - start).to_numpy().sum())
                for value in batch.column(3).slice(start, end - start).to_pylist():
                    segments = _segments(value)
                    even, uneven = _deeper(segments[0::2]), _deeper(segments[1::2])
                    outside += uneven if odd else even
                    inside += even if odd else uneven
                    odd ^= len(segments) % 2 == 0
                    # The brace that ended the piece closes something unless it is in a string.
                    outside -= not odd
                    inside -= odd
                row[3:6] = odd, outside, inside
        if row is not None:
            yield emit()

    schema = "key long, file string, block long, odd boolean, outside long, inside long, array boolean, "
    schema += "pieces long, size long, file_size long"
    found = pieces.mapInArrow(scan, schema)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    of_file, of_all = Window.partitionBy("file").orderBy("block"), Window.partitionBy("file")
    quotes = F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0))
    known = found.withColumn("within", quotes % 2 == 1).withColumn("array", F.first("array").over(of_file))
    change = F.when(F.col("within"), F.col("inside")).otherwise(F.col("outside"))
    rows = (
        known.withColumn("change", change)
        .withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))
        .withColumn("beyond", F.sum("size").over(of_all) - F.col("file_size"))
        .select(
            "key",
            F.when(~F.col("array"), NO_ARRAY).otherwise(F.col("within").cast("int")).alias("state"),
            "depth",
            # The reader leaves out a byte order mark of three bytes.
            F.when(
                F.col("beyond").isin(1, -2) & (F.max("block").over(of_all) == F.col("block")),
                F.col("pieces") - 1,
            ).otherwise(-1).alias("bare"),
        )
        .toPandas()
        .sort_values("key")
    )
    keys = rows["key"].to_numpy(dtype=np.int64)
    if (keys[1:] == keys[:-1]).any():
        raise ValueError("two parts of the files have one key; read them in other parts")
    return keys, *(rows[c].to_numpy(dtype=np.int64) for c in ("state", "depth", "bare"))


def _record(text: str, first: bool) -> tuple[str, bool]:
    """A record's text without what separates it from the one before, and whether that is right."""
    body = text.lstrip(("\ufeff" if first else "") + SPACE)
    mark = "[" if first else ","
    return (body[1:].lstrip(SPACE), True) if body.startswith(mark) else (body, False)


def _walk(batches: Iterator[pa.RecordBatch], states: tuple) -> Iterator[pa.RecordBatch]:
    """Complete records of each part, then its two ends: ``place`` 0 and 1."""
    keys_known, state_of, depth_of, bare_of = states
    current, file, block, state, depth, bare = None, None, 0, 0, 0, -1
    held: list[str] = []
    closed = False
    out: list[tuple] = []

    def end() -> None:
        if current is not None and state != NO_ARRAY:
            out.append((file, block, 1 if closed else 0, "".join(held), False))

    for batch in batches:
        out = []
        keys = batch.column(0).to_numpy()
        for start, stop in _runs(keys):
            if keys[start] != current:
                end()
                current, held, closed = keys[start], [], False
                file, block = (batch.column(i)[int(start)].as_py() for i in (1, 2))
                place = int(np.searchsorted(keys_known, current))
                if place == len(keys_known) or keys_known[place] != current:
                    raise ValueError(f"{file} is read in other parts than it was scanned in")
                state, depth, bare = (int(x[place]) for x in (state_of, depth_of, bare_of))
                if state == NO_ARRAY and block == 0:
                    text = batch.column(3)[int(start)].as_py()
                    if text.strip("\ufeff" + SPACE):
                        out.append((file, block, None, text, False))
            if state == NO_ARRAY:
                continue
            for value in batch.column(3).slice(start, stop - start).to_pylist():
                if bare == 0:
                    held.append(value)
                    break
                bare -= 1
                segments = _segments(value)
                depth += _deeper(segments[state::2])
                state ^= len(segments) % 2 == 0
                depth -= state == OUTSIDE
                held.append(value + "}")
                if depth == 1 and state == OUTSIDE:
                    text = "".join(held)
                    if closed:
                        out.append((file, block, None, *_record(text, first=False)))
                    else:
                        out.append((file, block, 0, text, True))
                    held, closed = [], True
        yield _parts(out)
    out = []
    end()
    yield _parts(out)


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_())
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in PARTS.split(", ")])


def _joined(ends: DataFrame) -> DataFrame:
    """The records that cross borders, and what is left of each file after its last record.

    ``begun`` says for an end at ``place`` 0 that a record is complete with it.
    """
    order = Window.partitionBy("file").orderBy("block", "place")
    # A record begins after the end that completed the one before, or with its file.
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    numbered = ends.withColumn("record", F.coalesce(F.sum(F.col("begun").cast("int")).over(before), F.lit(0)))
    dealt = numbered.repartition("file", "record").sortWithinPartitions("file", "record", "block", "place")

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, texts, complete = None, [], False

        def row() -> list[tuple]:
            if current is None:
                return []
            file, record = current
            text, first = "".join(texts), record == 0
            if complete:
                return [(file, *_record(text, first))]
            rest = text.strip(SPACE)
            if first and rest.lstrip("\ufeff" + SPACE).startswith("["):
                rest = rest.lstrip("\ufeff" + SPACE)[1:].lstrip(SPACE)
            return [] if rest == "]" else [(file, rest, False)]

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
            kinds = (pa.string(), pa.string(), pa.bool_())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=("file", "value", "begun"))

        for batch in batches:
            rows: list[tuple] = []
            for file, record, value, begun in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, record) != current:
                    rows += row()
                    current, texts, complete = (file, record), [], False
                texts.append(value)
                complete |= begun
            yield emit(rows)
        yield emit(row())

    return dealt.select("file", "record", "value", "begun").mapInArrow(
        put_together, "file string, value string, begun boolean"
    )
