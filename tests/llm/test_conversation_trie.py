from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from agorameter.llm import queries, sql
from agorameter.llm.conversation_trie import trie

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.sha256((text or "").encode()).digest()
            turns[conv].append((turn is not None, turn or 0, role or "", digest, text or ""))
    plain = {c: [(t[2], t[4]) for t in sorted(x)] for c, x in turns.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c in plain:
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        whole = tuple(plain.get(first, [])[:h] + plain[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].add(c)
        ends[whole].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    sums = {}
    for path in sorted(members, key=len, reverse=True):
        size = len(path[-1][1].encode()) if path else 0
        leaves = sum(sums[k][0] for k in kids[path]) or 1
        saved = (len(members[path]) - 1) * size + sum(sums[k][1] for k in kids[path])
        sums[path] = leaves, saved
    return sorted(
        (
            (
                min(m),
                len(p),
                min(members[p[:-1]]) if p else None,
                len(m),
                len(kids[p]),
                *sums[p],
                hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
            )
            for p, m in members.items()
        ),
        key=repr,
    )


def got(df):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"
    return sorted(map(tuple, df.select(*names.split()).collect()), key=repr)


def test_whole_table(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{FOLDER}/conversations.parquet'")
    rows = connection.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    found = got(queries.op12_conversation_trie(spark, FOLDER))
    assert found == brute(rows)
    assert found == sorted(connection.execute(sql.CONVERSATIONS).fetchall(), key=repr)


@pytest.fixture(scope="module")
def rows():
    chance = random.Random(4)
    rows = []
    for conv in range(-23, 160):
        if conv % 11:
            for turn in range(chance.randint(1, 14)):
                rows.append((conv, turn, chance.choice(["user", "bot"]), chance.choice("abé")))
    for conv in range(200, 300):  # copies of one conversation, some of them cut off
        rows += [(conv, t, "user", "é" * (t % 3)) for t in range(12 + conv % 3)]
    rows += [(7, None, None, None), (7, None, "x", None), (7, 3, None, "t"), (7, 3, None, "t")]
    rows += [(None, 0, "user", "nobody's"), (10_000_000, 0, "user", "one"), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("width", [None, 64])
def test_edge_cases(spark, rows, width):
    """The narrow sketch proves little, the wide one nearly all: the result is the same."""
    rows = rows[:]
    random.Random(1).shuffle(rows)
    assert got(trie(spark.createDataFrame(rows, SCHEMA).repartition(3), width)) == brute(rows)


def test_one_conversation_and_none(spark):
    assert got(trie(spark.createDataFrame([], SCHEMA))) == []
    for rows in ([(5, 0, "a", "b")], [(1, 0, "a", "b")], [(1, i, "a", "b") for i in range(30)]):
        assert got(trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_other_columns(spark):
    names = SCHEMA + ", a long, depth int, rep string, first boolean, conv int, place int"
    rows = [(c, t, "user", f"{t}") for c in range(8) for t in range(10)]
    df = spark.createDataFrame([(*r, 1, 2, "r", True, 3, 4) for r in rows], names)
    assert got(trie(df)) == brute(rows)
