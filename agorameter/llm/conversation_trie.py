"""The trie of conversation prefixes, screened by a count-min sketch.

A conversation is its turns in order of their numbers. Here the first ``h`` turns are those of
the first conversation of its batch of five, and its own turns follow after its first ``h``.
A node is a distinct sequence of first turns; its members are the conversations that begin with
it, and it is named after the smallest of them and its depth.

1. The turns of a conversation are dealt out by its id, sorted by Spark, and streamed through a
   chain of digests: each prefix has the digest of the one before and of its last turn. A text
   is left where it is; only its digest and its size travel.
2. A count-min sketch counts the digests of all prefixes. Where one of its rows says one, the
   prefix is surely no other conversation's, nor is any longer one: this tail of single nodes is
   written by the task that screens it. Only possibly shared prefixes are shuffled, and grouped
   exactly by their digests of 128 bits.
3. Nodes with the same smallest member are one path that ends where this member does, so every
   conversation owns one path or none, and the path hangs from a node of another one. Sums over
   subtrees follow without a walk from level to level: an owner hands the sums of its own path
   to the deepest node that it shares with each path above it, and running sums along every
   path bring them to the top.
4. Members that end in a node are brought to strings in blocks of ids, which are then hashed in
   order as a stream.

Nulls and edge cases: a null role or text is an empty one; a null turn comes first, turns of
one number are ordered by role and digest, repeated rows are turns of their own; rows without
conversation are left out; an empty table gives no row; only the columns ``conv_id``, ``turn``,
``role`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agorameter.llm.common import cut, id_filter, join_groups, prepare

#: Conversations in a batch, and the greatest number of turns that the first one lends, plus 1.
BATCH = 5
LENT = 9
#: Counters in a row of the sketch: four for every turn between these bounds (24 MB in all).
LEAST_WIDTH, MOST_WIDTH = 1 << 16, 1 << 26
ROWS = 3
#: Conversation ids whose text is put together in one block.
BLOCK = 4096
EMPTY = hashlib.sha256(b"").hexdigest()

CHAIN = "conv long, depth long, a long, b long, size long, last boolean"


def _turns(conversations: DataFrame) -> DataFrame:
    """Turns of all rebuilt conversations in order of ``conv, part, place, turn, role, digest``.

    Part 0 holds the turns of the batch's first conversation, part 1 all own turns, of which
    the first ``lent`` are still to be skipped.
    """
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"),
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("size"),
    )
    lent = (F.crc32(F.col("conv").cast("string")) % LENT).alias("lent")
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    firsts = (
        rows.where(F.col("conv") % BATCH == 0)
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") < LENT)
        .select(F.col("conv").alias("first"), "place", "turn", "role", "digest", "size")
    )
    convs = rows.select("conv").distinct().select("conv", lent).where("lent > 0")
    convs = convs.withColumn("first", F.col("conv") - F.col("conv") % BATCH)
    lent_turns = convs.join(firsts, "first").where("place <= lent")
    columns = ("turn", "role", "digest", "size")
    own = rows.select("conv", F.lit(1).alias("part"), F.lit(0).alias("place"), *columns, lent)
    both = own.unionByName(
        lent_turns.select("conv", F.lit(0).alias("part"), "place", *columns, "lent")
    )
    return both.repartition("conv").sortWithinPartitions(
        "conv", "part", "place", F.col("turn").asc_nulls_first(), "role", "digest"
    ).select("conv", "part", "role", "digest", "size", "lent")


def _chains(turns: DataFrame) -> DataFrame:
    """One row per prefix of every conversation, in order: :data:`CHAIN`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, skipped, depth, digest, pending = None, 0, 0, b"", None
        for batch in batches:
            rows: list[tuple] = []
            for conv, part, role, text, size, lent in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if conv != current:
                    if pending:
                        rows.append((*pending, True))
                    current, skipped, depth, digest = conv, 0, 0, bytes(16)
                    pending = (conv, 0, 0, 0, 0)
                if part and skipped < lent:
                    skipped += 1
                    continue
                rows.append((*pending, False))
                depth += 1
                role = role.encode()
                link = digest + len(role).to_bytes(8, "little") + role + text
                digest = hashlib.blake2b(link, digest_size=16).digest()
                halves = np.frombuffer(digest, dtype=np.int64).tolist()
                pending = (conv, depth, *halves, size)
            yield _batch(rows)
        if pending:
            yield _batch([(*pending, True)])

    return turns.mapInArrow(run, CHAIN)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in CHAIN.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.bool_()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def repeated(chains: DataFrame, width: int) -> list[np.ndarray]:
    """Per row of a count-min sketch over all digests a bitmap of the counters beyond one."""
    parts = (F.col("a"), F.shiftright("a", 32), F.col("b"))  # the same as in _screened
    slots = (part.bitwiseAND(F.lit(width - 1)).alias("slot") for part in parts)
    counters = F.array(*(F.struct(F.lit(r).alias("r"), slot) for r, slot in enumerate(slots)))
    beyond = cut(chains.select(F.inline(counters)).groupBy("r", "slot").count().where("count > 1"))
    return [
        id_filter(beyond.where(F.col("r") == r), "slot", F.col("slot"), width) for r in range(ROWS)
    ]


def _screened(chains: DataFrame, bitmaps: list[np.ndarray], width: int) -> DataFrame:
    """The chains with ``tail``: from the first prefix on that an estimate of one proves single.

    ``first`` marks this first prefix.
    """
    shared = chains.sparkSession.sparkContext.broadcast(bitmaps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, inside = None, False
        for batch in batches:
            conv, depth, a, b = (batch.column(i).to_numpy() for i in range(4))
            single = np.zeros(len(conv), dtype=bool)
            for part, bitmap in zip((a, a >> 32, b), shared.value, strict=True):
                slot = part & (width - 1)
                single |= (bitmap[slot >> 6] >> (slot & 63)) & 1 == 0
            if not len(conv):
                continue
            # Rows of a conversation are neighbours: count proofs since its first row.
            starts = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
            sizes = np.diff(np.append(starts, len(conv)))
            proofs = np.cumsum(single)
            tail = proofs > np.repeat((proofs - single)[starts], sizes)
            carried = conv[0] == before and inside
            tail[: sizes[0]] |= carried
            first = tail.copy()
            first[1:] &= ~(tail[:-1] & (conv[1:] == conv[:-1]))
            first[0] &= not carried
            before, inside = conv[-1], bool(tail[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tail), pa.array(first)],
                names=[*batch.schema.names, "tail", "first"],
            )

    return chains.mapInArrow(run, CHAIN + ", tail boolean, first boolean")


def _ends(members: DataFrame) -> DataFrame:
    """``rep, depth, ends_sha256`` from ``rep, depth, conv`` of conversations that end there."""
    block = F.floor(F.col("conv") / BLOCK).alias("block")
    texts = members.groupBy("rep", "depth", block).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string")), ","
        ).alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            rows = []
            for rep, depth, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (rep, depth) != current:
                    if current:
                        rows.append((*current, state.hexdigest()))
                    current, state = (rep, depth), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _digests(rows)
        if current:
            yield _digests([(*current, state.hexdigest())])

    dealt = texts.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "block")
    schema = "rep long, depth long, ends_sha256 string"
    return dealt.select("rep", "depth", "ids").mapInArrow(run, schema)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    reps, depths, digests = zip(*rows, strict=True) if rows else ([], [], [])
    arrays = [pa.array(reps, pa.int64()), pa.array(depths, pa.int64()), pa.array(digests, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, names=("rep", "depth", "ends_sha256"))


def _tails(screened: DataFrame, owners: DataFrame) -> DataFrame:
    """Nodes of tails; only the top one of a tail has to ask for its parent."""
    rest = screened.where("tail AND NOT first").withColumn("parent_conv_id", F.col("conv"))
    tops = screened.where("first").join(owners.select("conv", "top", "above"), "conv")
    parent = F.when(F.col("top") < F.col("depth"), F.col("conv")).otherwise(F.col("above"))
    tops = tops.withColumn("parent_conv_id", parent).drop("top", "above")
    ends = F.when(F.col("last"), F.col("conv").cast("string")).otherwise("")
    return rest.unionByName(tops).select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.lit(1).cast("long").alias("n_convs"),
        F.when(F.col("last"), 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.sha2(ends.cast("binary"), 256).alias("ends_sha256"),
    )


def trie(conversations: DataFrame, width: int | None = None) -> DataFrame:
    """All nodes: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``. ``width`` is the number of counters in a row of the sketch, a power of two.
    """
    prepare(conversations.sparkSession)
    chains = cut(_chains(_turns(conversations)))
    if width is None:
        width = min(max(LEAST_WIDTH, 1 << (4 * chains.count()).bit_length()), MOST_WIDTH)
    screened = cut(_screened(chains, repeated(chains, width), width))

    # Exact groups of the possibly shared prefixes.
    shared = screened.where("NOT tail")
    nodes = cut(
        shared.groupBy("a", "b").agg(
            F.min("conv").alias("rep"),
            F.max("depth").alias("depth"),
            F.count("*").alias("n"),
            ((F.count("*") - 1) * F.max("size")).alias("saved"),
        )
    )
    met = cut(
        join_groups(shared.select("conv", "a", "b", "last"), nodes, ["a", "b"], "n").drop("a", "b")
    )

    # Paths: the nodes named after one conversation, from `top` to `deepest`.
    own = F.col("rep") == F.col("conv")
    tops = screened.where("first").select(
        "conv", "depth", F.col("conv").alias("rep"), F.lit(0).cast("long").alias("saved"), "first"
    )
    paths = cut(
        met.select("conv", "depth", "rep", "saved", F.lit(False).alias("first"))
        .unionByName(tops)
        .groupBy("conv")
        .agg(
            F.min(F.when(own, F.col("depth"))).alias("top"),
            F.max(F.when(~own, F.struct("depth", "rep"))).alias("at"),
            F.sum(F.when(own, F.col("saved"))).alias("saved"),
            F.max("depth").alias("deepest"),
            F.max("first").alias("tail"),
        )
        .where("top IS NOT NULL")
        .select(
            "conv",
            "top",
            F.col("at.rep").alias("above"),
            F.col("at.depth").alias("place"),
            "saved",
            "deepest",
            "tail",
        )
    )
    hung = (
        paths.where("above IS NOT NULL")
        .groupBy(F.col("above").alias("rep"), F.col("place").alias("depth"))
        .agg(F.count("*").alias("hung"))
    )
    ended = hung.select(F.col("rep").alias("conv"), F.col("depth").alias("deepest"), "hung")
    owners = cut(
        paths.join(ended, ["conv", "deepest"], "left")
        .withColumn("leaf", F.col("hung").isNull().cast("long"))
        .drop("hung")
    )
    handed = (
        met.where(~own)
        .groupBy("conv", "rep")
        .agg(F.max("depth").alias("depth"))
        .join(owners.select("conv", "saved", "leaf"), "conv")
        .groupBy("rep", "depth")
        .agg(F.sum("saved").alias("more_saved"), F.sum("leaf").alias("more_leaves"))
    )

    # Running sums from the end of each path to its top.
    along = Window.partitionBy("rep").orderBy(F.col("depth").desc())
    about = owners.select(
        F.col("conv").alias("rep"),
        "top",
        "above",
        "deepest",
        "leaf",
        (F.col("deepest") - F.col("tail").cast("long")).alias("end"),
    )
    key = ["rep", "depth"]
    none = F.lit(0).cast("long")
    leaf = F.when(F.col("depth") == F.col("end"), F.col("leaf")).otherwise(none)
    exact = (
        nodes.join(about, "rep")
        .join(hung, key, "left")
        .join(handed, key, "left")
        .join(_ends(met.where("last").select("rep", "depth", "conv")), key, "left")
        .select(
            F.col("rep").alias("conv_id"),
            "depth",
            F.when(F.col("depth") > F.col("top"), F.col("rep")).otherwise(F.col("above")).alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            (F.coalesce("hung", none) + (F.col("depth") < F.col("deepest")).cast("long")).alias("n_children"),
            F.sum(F.coalesce("more_leaves", none) + leaf).over(along).alias("n_leaves"),
            F.sum(F.col("saved") + F.coalesce("more_saved", none)).over(along).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
        )
    )
    return exact.unionByName(_tails(screened, owners))
