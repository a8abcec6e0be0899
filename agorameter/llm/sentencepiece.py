"""Encoding and decoding with a piece table as a lattice in the row.

A text is normalised (a space in front, spaces as ▁) and cut into units that no piece crosses.
The substrings of a unit up to the longest piece are looked up in the piece table, which is a
constant of hashed buckets; a higher-order aggregate folds the edges found to ids, where a
character without a piece stands for its bytes. For a table of independent pieces the fold is
Viterbi's: the path with the largest sum of scores. A table of merges does not mean that path;
there the edges that merges meet are folded in the order of the merges, the best score first and
the leftmost of equals, which gives the ids of the library.

The ids of a unit depend on the unit alone. Units that are frequent in a bounded sample are
encoded once and kept in the workers, which receive them from each other and not from the driver.
With merges, the pieces that stand beside each other in a kept unit do so in any other unit too
(see :func:`known_path`), so a unit with a path of such neighbours has its ids from kept ones. All
others go through the same lattice in an array of their document, so any unit is encoded and the
sample decides nothing but the cost. The aggregate's
time grows with the square of a unit's length, so units longer than ``LONGEST`` are folded whole
in the task that cuts their document, in the same order of merges from a heap, or by Viterbi.

Nulls and edge cases: a null or empty text has no ids; rows that share an id share only the
lookup of their units; a unit is cut only where no piece crosses, however long it is; of equal paths the one with the longer last piece wins; a ▁ in a text
decodes as a space; an empty table gives no row; extra columns are not read.
"""

from __future__ import annotations

import heapq
import json
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from operator import add
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agorameter.llm.common import prepare

SPACE = "▁"
#: Characters of the longest unit that goes through the lattice of joins.
LONGEST = 256
#: Documents of the sample (in expectation), and units encoded for the workers. Those met at
#: least ``OFTEN`` times are kept, the others only show which pieces are neighbours. Without
#: merges all are kept.
SAMPLE = 20_000
KEPT = 300_000
OFTEN = 4
#: Places of the piece table in a row's expressions.
BUCKETS = 1 << 17
#: Units that a worker puts together from kept ones and keeps at a time.
WHOLE = 50_000
#: How much worse than the worst piece a character without one is.
PENALTY = 10.0
UNIT = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n+")


@dataclass(frozen=True)
class Pieces:
    """A piece table: ``(piece, id, score)`` of the ordinary pieces, and the id of byte 0."""

    rows: tuple[tuple[str, int, float], ...]
    first_byte: int
    longest: int
    unknown: float
    #: Whether the scores order merges, and are not those of independent pieces.
    merges: bool
    #: Neighbouring characters inside any piece: no edge crosses other neighbours.
    joints: frozenset[str]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), "piece string, id int, score double")

    def spelled(self) -> dict[int, bytes]:
        """The bytes that each id of a piece or byte stands for."""
        return {self.first_byte + b: bytes([b]) for b in range(256)} | {i: p.encode() for p, i, _ in self.rows}


def load_pieces(path: str, merges: bool) -> Pieces:
    """The ordinary pieces of a model file with byte fallback and ids of bytes in a row."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    rows, byte_ids = [], []
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            byte_ids.append(i)
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            rows.append((model.id_to_piece(i), i, float(model.get_score(i))))
    if byte_ids != list(range(byte_ids[0], byte_ids[0] + 256)):
        raise ValueError("the model needs a piece for each byte")
    if any(re.search(f"[^{SPACE}]{SPACE}|\n", piece) for piece, _, _ in rows):
        raise ValueError("a piece crosses words")
    worst = min((s for _, _, s in rows if s > -1e8), default=0.0)
    joints = frozenset(p[i : i + 2] for p, _, _ in rows for i in range(len(p) - 1))
    longest = max((len(p) for p, _, _ in rows), default=1)
    return Pieces(tuple(rows), byte_ids[0], longest, worst - PENALTY, merges, joints)


def units_of(text: str) -> list[str]:
    """The units of a text: with single spaces and line ends they are cut without the pattern."""
    if text[:1] == " " or "  " in text or "\n\n" in text or SPACE in text:
        return UNIT.findall(normalised(text))
    marked = text.replace(" ", " " + SPACE).replace("\n", " \n ")
    return list(filter(None, (SPACE + marked).split(" "))) if text else []


def normalised(text: str) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""


def cut_unit(unit: str, joints: frozenset[str]) -> list[str]:
    """The unit at all places that no piece crosses."""
    inside = list(map(joints.__contains__, map(add, unit, unit[1:])))
    parts, start = [], 0
    for _ in range(inside.count(False)):
        end = inside.index(False, start) + 1
        parts.append(unit[start:end])
        start = end
    return [*parts, unit[start:]]


def _merged_borders(word: str, table: dict[str, tuple[int, float]]) -> list[int]:
    """The borders after all merges, the best score first and the leftmost of equals."""
    n = len(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    waiting: list[tuple[float, int, int, int]] = []

    def offer(start: int) -> None:
        """The symbol at ``start`` with the next one, if a piece spells both."""
        middle = after[start]
        if middle < n:
            end = after[middle]
            if found := table.get(word[start:end]):
                heapq.heappush(waiting, (-found[1], start, middle, end))

    for i in range(n - 1):
        offer(i)
    while waiting:
        _, start, middle, end = heapq.heappop(waiting)
        # A symbol that was joined to the one before it starts nowhere (0 comes after nothing).
        if after[start] != middle or after[middle] != end:
            continue
        after[start], after[middle] = end, 0
        if end < n:
            before[end] = start
        offer(start)
        if before[start] >= 0:
            offer(before[start])
    borders = [0]
    while borders[-1] < n:
        borders.append(after[borders[-1]])
    return borders


def _best_borders(word: str, table: dict[str, tuple[int, float]], longest: int, unknown: float) -> list[int]:
    """The borders of the best path; of equal ones the longer last piece."""
    totals, starts = [0.0], [0]
    for end in range(1, len(word) + 1):
        best, at = float("-inf"), end - 1
        for start in range(max(0, end - longest), end):
            if found := table.get(word[start:end]):
                total = totals[start] + found[1]
            elif end - start == 1:
                total = totals[start] + unknown
            else:
                continue
            if total > best:
                best, at = total, start
        totals.append(best)
        starts.append(at)
    borders = [len(word)]
    while borders[-1]:
        borders.append(starts[borders[-1]])
    return borders[::-1]


def fold_long(word: str, pieces: Pieces, table: dict[str, tuple[int, float]]) -> list[int]:
    """The ids of a word of any length; ``table`` has id and score of each piece."""
    if pieces.merges:
        borders = _merged_borders(word, table)
    else:
        borders = _best_borders(word, table, pieces.longest, pieces.unknown)
    ids: list[int] = []
    for a, b in zip(borders, borders[1:], strict=False):
        if found := table.get(word[a:b]):
            ids.append(found[0])
        else:
            ids += [x + pieces.first_byte for x in word[a:b].encode()]
    return ids


def _byte_ids(character: Column, first_byte: int) -> Column:
    """The ids of the bytes of a character."""
    symbol = F.hex(F.encode(character, "utf-8"))
    return F.transform(
        F.sequence(F.lit(0), (F.length(symbol) / 2).cast("int") - 1),
        lambda k: F.conv(F.substring(symbol, k * 2 + 1, F.lit(2)), 16, 10).cast("int") + first_byte,
    )


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _constant(value: list, kind: str) -> Column:
    """A list as one constant, which every task has once."""
    return F.from_json(F.lit(json.dumps(value)), f"array<{kind}>")


def _buckets(pieces: Pieces) -> Column:
    """The piece table by the hash of the piece, so that a substring meets those that share its hash."""
    held: list[list | None] = [None] * BUCKETS
    for piece, i, score in pieces.rows:
        at = zlib.crc32(piece.encode()) % BUCKETS
        held[at] = [*(held[at] or ()), {"piece": piece, "id": i, "score": score}]
    return _constant(held, "array<struct<piece: string, id: int, score: double>>")


def _find(buckets: Column, text: Column) -> Column:
    """The piece that a text is, or null."""
    held = F.get(buckets, (F.crc32(text) % BUCKETS).cast("int"))
    return F.get(F.filter(held, lambda e: e["piece"] == text), F.lit(0))


def _merged(word: Column, buckets: Column, pieces: Pieces) -> Column:
    """The ids after all merges, folded over the edges that the merges meet.

    The state holds the borders of the symbols and the score of merging each with the next.
    """

    def span(start: Column, end: Column) -> Column:
        return F.substring(word, start + 1, end - start)

    def score(start: Column, end: Column) -> Column:
        return _find(buckets, span(start, end))["score"]

    def merge(state: Column, place: Column) -> Column:
        """Join the symbol at a place with the next one."""
        borders, scores = state["borders"], state["scores"]
        before = F.when(
            place > 0, F.array(score(F.get(borders, place - 1), F.get(borders, place + 2)))
        ).otherwise(F.array().cast("array<double>"))
        after = F.when(
            place + 3 < F.size(borders),
            F.array(score(F.get(borders, place), F.get(borders, place + 3))),
        ).otherwise(F.array().cast("array<double>"))
        return F.struct(
            F.concat(
                F.slice(borders, F.lit(1), place + 1),
                F.slice(borders, place + 3, F.size(borders)),
            ).alias("borders"),
            F.concat(
                F.slice(scores, F.lit(1), F.greatest(place - 1, F.lit(0))),
                before,
                after,
                F.slice(scores, place + 3, F.size(scores) + 1),
            ).alias("scores"),
        )

    def step(state: Column, _: Column) -> Column:
        def join(best: Column) -> Column:
            place = (F.array_position(state["scores"], best) - 1).cast("int")
            return F.when(best.isNull(), state).otherwise(_bind(place, lambda at: merge(state, at)))

        return _bind(F.array_max(state["scores"]), join)

    n = F.length(word)
    start = F.struct(
        F.sequence(F.lit(0), n).alias("borders"),
        F.when(
            n > 1, F.transform(F.sequence(F.lit(0), n - 2), lambda i: score(i, i + 2))
        ).otherwise(F.array().cast("array<double>")).alias("scores"),
    )
    borders = F.aggregate(F.sequence(F.lit(1), n), start, step)["borders"]

    def symbol_ids(border: Column) -> Column:
        def ids(i: Column) -> Column:
            symbol = span(F.get(border, i), F.get(border, i + 1))
            return _bind(
                _find(buckets, symbol)["id"],
                lambda found: F.when(found.isNull(), _byte_ids(symbol, pieces.first_byte)).otherwise(F.array(found)),
            )

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(border) - 2), ids))

    return _bind(borders, symbol_ids)


def _edges(word: Column, buckets: Column, pieces: Pieces) -> Column:
    """The edges ``(end, start, id, score)`` of a word by end and start, all single characters among them."""

    def to(end: Column) -> Column:
        def edge(start: Column) -> Column:
            found = _find(buckets, F.substring(word, start + 1, end - start))
            return _bind(
                found,
                lambda e: F.when(
                    e.isNotNull() | (end - start == 1),
                    F.struct(
                        end.alias("end"), start.alias("start"), e["id"].alias("id"),
                        F.coalesce(e["score"], F.lit(pieces.unknown)).alias("score"),
                    ),
                ),
            )

        starts = F.sequence(F.greatest(end - pieces.longest, F.lit(0)), end - 1)
        return F.filter(F.transform(starts, edge), lambda e: e.isNotNull())

    return F.flatten(F.transform(F.sequence(F.lit(1), F.length(word)), to))


def _best_path(word: Column, buckets: Column, pieces: Pieces) -> Column:
    """The ids of the best path through the edges of a word."""
    edges, first_byte = _edges(word, buckets, pieces), pieces.first_byte
    start = F.struct(
        F.lit(0.0).alias("total"), F.lit(0).alias("start"), F.lit(None).cast("int").alias("id")
    )

    def step(best: Column, edge: Column) -> Column:
        # Edges come by their end, so it is always the last place that is filled or improved.
        total = F.get(best, edge["start"])["total"] + edge["score"]
        new = F.array(F.struct(total.alias("total"), edge["start"].alias("start"), edge["id"].alias("id")))
        return (
            F.when(F.size(best) == edge["end"], F.concat(best, new))
            .when(
                total > F.element_at(best, -1)["total"],
                F.concat(F.slice(best, F.lit(1), F.size(best) - 1), new),
            )
            .otherwise(best)
        )

    kind = "struct<at: int, ids: array<int>>"

    def back(best: Column) -> Column:
        def walk(state: Column, i: Column) -> Column:
            place = F.get(best, i)
            as_bytes = _byte_ids(F.substring(word, place["start"] + 1, F.lit(1)), first_byte)
            ids = F.when(place["id"].isNull(), as_bytes).otherwise(F.array(place["id"]))
            return F.when(
                state["at"] == i,
                F.struct(place["start"].alias("at"), F.concat(ids, state["ids"]).alias("ids")),
            ).otherwise(state)

        n = F.size(best) - 1
        first = F.struct(n.alias("at"), F.array().cast("array<int>").alias("ids")).cast(kind)
        return F.aggregate(F.sequence(n, F.lit(1), F.lit(-1)), first, walk)["ids"]

    best = F.aggregate(edges, F.array(start), step)
    return _bind(best, back)


def folded(words: Column, pieces: Pieces) -> Column:
    """The ids of each word of an array; words have at least one character."""
    fold = _merged if pieces.merges else _best_path
    return _bind(_buckets(pieces), lambda buckets: F.transform(words, lambda w: fold(w, buckets, pieces)))


def encode_units(units: DataFrame, pieces: Pieces, *group: str) -> DataFrame:
    """``ids`` of each distinct row ``(*group, word)``; words have at least one character."""
    ids = folded(F.array("word"), pieces)
    return units.select(*group, "word").distinct().select(*group, "word", F.get(ids, F.lit(0)).alias("ids"))


class Kept:
    """The units that workers keep, from the compressed parts that :func:`frequent_units` made.

    A worker unpacks them once; the driver only hands the parts on.
    """

    def __init__(self, parts: list[bytes], pieces: Pieces):
        self.parts, self.pieces = parts, pieces

    @cached_property
    def unpacked(self) -> tuple[dict[str, bytes], dict[bytes, tuple[int, dict[str, bytes]]]]:
        """The ids of each unit, and by the id of a piece the pieces known to follow it.

        These come with the length of the longest; after no id come the pieces known to be left
        whole. Ids are little-endian 32-bit numbers.
        """
        ids: dict[str, bytes] = {}
        pairs = [np.zeros(0, "<i8")]
        for part in self.parts:
            found, beside = pickle.loads(zlib.decompress(part))
            ids |= found
            pairs.append(np.frombuffer(beside, "<i8"))
        spelled = {i: (piece, _pack([i])) for piece, i, _ in self.pieces.rows}
        follow: dict[bytes, dict[str, bytes]] = {}
        for pair in np.unique(np.concatenate(pairs)).tolist():
            (_, before), (piece, own) = spelled.get(pair >> 32, ("", b"")), spelled[pair & 0xFFFFFFFF]
            follow.setdefault(before, {})[piece] = own
        return ids, {i: (max(map(len, after)), after) for i, after in follow.items()}


def neighbours_of(units: list[list[int]], pieces: Pieces) -> bytes:
    """The pieces of merged units, each with the one before it and each with -1; bytes are left out.

    A pair is one 64-bit number, the id before in its upper half.
    """
    flat = np.array([i for ids in units for i in (-1, *ids)], np.int64)
    byte = (flat >= pieces.first_byte) & (flat < pieces.first_byte + 256)
    good = ~byte & (flat >= 0)
    before, after = flat[:-1], flat[1:]
    beside = good[1:] & good[:-1]
    alone = np.unique(flat[good]) | (np.int64(-1) << 32)
    return np.concatenate([alone, np.unique((before << 32 | after)[beside])]).astype("<i8").tobytes()


def known_path(word: str, kept: dict[str, bytes], follow: dict[bytes, tuple[int, dict[str, bytes]]]) -> bytes | None:
    """The ids of a merged word if all neighbours on a path through it are known ones, or None.

    Merges inside two neighbouring pieces come in the same order whatever stands around them, up
    to the first one that crosses their border. So pieces end up beside each other in a word just
    if they do so where the two stand alone, and a path of which that is true at each border has
    the ids of the word. Any start of the word has one such path at most, so each is tried once,
    from the longest kept start on.
    """
    n = len(word)
    seen: set[int] = set()
    for start in range(n - 1, -1, -1):
        ids = kept.get(word[:start]) if start else b""
        if ids is None or start in seen:
            continue
        todo = [(start, ids)]
        while todo:
            at, ids = todo.pop()
            seen.add(at)
            if after := follow.get(ids[-4:]):
                reach, known = after
                if n - at <= reach and (one := known.get(word[at:])):
                    return ids + one
                for end in range(at + 1, min(n, at + reach + 1)):
                    if (one := known.get(word[at:end])) and end not in seen:
                        todo.append((end, ids + one))
    return None


def frequent_units(docs: DataFrame, pieces: Pieces) -> Kept:
    """The most frequent units of a sample with their ids, encoded and packed in the tasks."""
    n = docs.count()
    share = min(1_000_000, -(-1_000_000 * SAMPLE // max(1, n)))
    sample = docs.where(F.pmod(F.xxhash64("key", F.lit(5)), F.lit(1_000_000)) < share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(1).to_pylist():
                seen.update(units_of(text or ""))
        total: Counter[str] = Counter()
        for unit, times in seen.items():
            for part in cut_unit(unit, pieces.joints):
                if len(part) <= LONGEST:
                    total[part] += times
        words = list(total)
        for i in range(0, len(words), 1 << 16):
            part = words[i : i + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"word": pa.array(part, pa.string()), "n": pa.array([total[w] for w in part], pa.int64())})

    top = (
        sample.mapInArrow(count, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(KEPT)
    )
    spread = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = encode_units(top.repartition(spread, "word"), pieces, "n")
    often = OFTEN if pieces.merges else 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = pieces.spelled()
        for batch in batches:
            times, words, units = (c.to_pylist() for c in batch.columns)
            # Ids that do not spell their unit are left to the lattice, which finds them out.
            rows = zip(times, words, units, strict=True)
            own = {w: _pack(ids) for n, w, ids in rows if n >= often and spell(ids, spelled) == w}
            beside = neighbours_of(units, pieces) if pieces.merges else b""
            yield pa.RecordBatch.from_pydict({"part": pa.array([zlib.compress(pickle.dumps((own, beside)), 1)], pa.binary())})

    return Kept([r.part for r in found.mapInArrow(pack, "part binary").collect()], pieces)


def _pack(ids) -> bytes:
    return np.asarray(ids, "<i4").tobytes()


def _fill(packed: list[bytes], first: np.ndarray, ends: np.ndarray, values: np.ndarray):
    """All ids of rows whose holes are filled, and where the ids of each row end, from 0.

    A hole is the negative number of one of the row's words, from -1 on; ``first`` is the place
    of a row's first word, ``ends`` has the ends of all words in ``values``, from their start.
    """
    flat = np.frombuffer(b"".join(packed), "<i4")
    sizes = np.array([len(x) // 4 for x in packed], np.int64)
    holes = np.flatnonzero(flat < 0)
    word = np.repeat(first, sizes)[holes] - 1 - flat[holes]
    begin, long = ends[word], ends[word + 1] - ends[word]
    times = np.ones(len(flat), np.int64)
    times[holes] = long
    stops = np.concatenate([np.zeros(1, np.int64), np.cumsum(times)])
    filled = np.repeat(flat, times)
    step = np.arange(long.sum()) - np.repeat(np.cumsum(long) - long, long)
    filled[np.repeat(stops[holes], long) + step] = values[np.repeat(begin, long) + step]
    return filled, stops[np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])]


def encode(
    docs: DataFrame, pieces: Pieces, key: str = "doc_id", text: str = "text", digest: bool = False
) -> DataFrame:
    """``key`` and ``ids`` of each row, or with ``digest`` their number, checksum and round trip.

    Nothing is shuffled: a text becomes the ids of its kept units with holes for its other
    parts, which are folded in an array beside them, and then the holes are filled.
    """
    session = prepare(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    shared = session.sparkContext.broadcast(frequent_units(rows, pieces))

    def cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value.pieces
        kept, follow = shared.value.unpacked
        spelled, table = pieces.spelled(), {p: (i, score) for p, i, score in pieces.rows}

        # Units put together from kept ones alone.
        whole: dict[str, bytes] = {}

        def remember(unit: str, packed: bytes) -> bytes:
            if len(whole) >= WHOLE:
                whole.clear()
            whole[unit] = packed
            return packed

        def ids_of(part: str, mine: dict[str, bytes], words: list[str]) -> bytes:
            """The ids of a part, or the hole for them."""
            if found := kept.get(part) or whole.get(part) or mine.get(part):
                return found
            if len(part) > LONGEST:
                mine[part] = _pack(fold_long(part, pieces, table))
            elif follow and (path := known_path(part, kept, follow)):
                return remember(part, path)
            else:
                words.append(part)
                mine[part] = (-len(words)).to_bytes(4, "little", signed=True)
            return mine[part]

        def look_up(unit: str, mine: dict[str, bytes], words: list[str]) -> bytes:
            """The ids of all parts of a unit, kept for its next place."""
            if found := kept.get(unit) or whole.get(unit) or mine.get(unit):
                return found
            parts = cut_unit(unit, pieces.joints)
            packed = b"".join([ids_of(p, mine, words) for p in parts])
            if len(parts) == 1:
                return packed
            if any(p in mine for p in parts):
                return mine.setdefault(unit, packed)
            return remember(unit, packed)

        def put_together(unit: str, mine: dict[str, bytes], words: list[str]) -> bytes:
            """The ids of a unit that is not kept: most are a word and marks, which no piece joins."""
            at = len(unit.rstrip(punctuation))
            if 0 < at < len(unit) and unit[at - 1 : at + 1] not in pieces.joints:
                return look_up(unit[:at], mine, words) + look_up(unit[at:], mine, words)
            return look_up(unit, mine, words)

        def sound(units: list[str]) -> bool:
            """Whether the ids of long parts spell them; those of kept ones and of paths do."""
            if max(map(len, units), default=0) <= LONGEST:
                return True
            long = (p for u in units if len(u) > LONGEST for p in cut_unit(u, pieces.joints) if len(p) > LONGEST)
            return all(spell(fold_long(p, pieces, table), spelled) == p for p in long)

        for batch in batches:
            out: list[tuple[bytes, list[str], bool]] = []
            for body in batch.column(1).to_pylist():
                units, mine, words = units_of(body or ""), {}, []
                found = list(map(kept.get, units))
                at = -1
                for _ in range(found.count(None)):
                    at = found.index(None, at + 1)
                    unit = units[at]
                    found[at] = whole.get(unit) or mine.get(unit) or put_together(unit, mine, words)
                # A text is its units, so its ids spell it where those of each unit spell the
                # unit; decode() gives a space for a space sign of the text.
                same = digest and SPACE not in (body or "") and sound(units)
                out.append((b"".join(found), words, same))
            packed, words, same = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(packed, pa.binary()),
                    pa.array(words, pa.list_(pa.string())),
                    pa.array(same, pa.bool_()),
                ],
                names=["key", "packed", "words", "same"],
            )

    cut_rows = rows.mapInArrow(cut_texts, f"key {kind}, packed binary, words array<string>, same boolean")
    met = cut_rows.select("*", folded(F.col("words"), pieces).alias("own"))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = shared.value.pieces.spelled()
        for batch in batches:
            packed = batch.column(1).to_pylist()
            own = batch.column(4)
            first = own.offsets.to_numpy().astype(np.int64)
            ends = own.values.offsets.to_numpy().astype(np.int64)
            values = own.values.values.to_numpy(zero_copy_only=False)
            ids, stops = _fill(packed, first[:-1], ends, values)
            if digest:
                same = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
                words, one = batch.column(2).flatten().to_pylist(), values.tolist()
                for k, word in enumerate(words, int(first[0])):
                    if spell(one[ends[k] : ends[k + 1]], spelled) != word:
                        same[np.searchsorted(first, k, "right") - 1] = False
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(stops, stops[1:], strict=False)]
                arrays = [pa.array(np.diff(stops), pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())]
                names = ["key", "n_ids", "ids_crc32", "round_trip"]
            else:
                made = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(ids, pa.int32()))
                arrays, names = [made], ["key", "ids"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    made = "n_ids long, ids_crc32 long, round_trip boolean" if digest else "ids array<int>"
    return met.mapInArrow(assemble, f"key {kind}, {made}").withColumnRenamed("key", key)


def spell(ids, spelled: dict[int, bytes]) -> str:
    """The normalised text of ids: pieces and bytes one after the other."""
    return b"".join([spelled[i] for i in ids]).decode("utf-8", "replace")


def decode(encoded: DataFrame, pieces: Pieces, key: str = "doc_id") -> DataFrame:
    """``key`` and ``text`` from ``key`` and ``ids``: each id looked up in its row, and put together."""
    table: list[str | None] = [None] * (1 + max((i for _, i, _ in pieces.rows), default=0))
    for piece, i, _ in pieces.rows:
        table[i] = piece.encode().hex().upper()

    def body(spelled: Column) -> Column:
        def bytes_of(i: Column) -> Column:
            return F.coalesce(F.get(spelled, i), F.lpad(F.hex(i - pieces.first_byte), 2, "0"))

        return F.array_join(F.transform("ids", bytes_of), "")

    hexes = F.coalesce(_bind(_constant(table, "string"), body), F.lit(""))
    plain = F.translate(F.decode(F.unhex(hexes), "utf-8"), SPACE, " ")
    return encoded.select(F.col(key), plain.alias("text")).select(
        F.col(key), F.substring("text", F.lit(2), F.length("text")).alias("text")
    )
