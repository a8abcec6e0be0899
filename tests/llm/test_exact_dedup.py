from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import duckdb
import pytest

from agorameter.llm import exact_dedup, queries, sql
from agorameter.llm.exact_dedup import Owner, Trie, drop_copies, groups, normalised

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"


def brute(docs):
    same = defaultdict(list)
    for place, (i, text) in enumerate(docs):
        same[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append((i is None, i or 0, place, i))
    rows = []
    for body, members in same.items():
        digest = hashlib.sha256(body.encode()).hexdigest()
        for rank, (_, _, _, i) in enumerate(sorted(members)):
            rows.append((i, min(members)[3], len(members), rank == 0, digest))
    return sorted(rows, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_whole_table(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    rows = got(queries.op13_exact_dedup(spark, FOLDER))
    assert rows == brute(connection.execute("SELECT doc_id, text FROM documents").fetchall())
    assert rows == sorted(connection.execute(sql.EXACT).fetchall(), key=repr)


@pytest.fixture(scope="module")
def docs():
    chance = random.Random(3)
    texts = ["", None, " ", "\t\n", "a", "a ", " a", "a\x0bb", "a  b", "a b", "a" * 90_000]
    texts += ["a" * 90_000, "a" * 89_999 + "b", "é\r\n", "é ", "x\x1cy", "x y"]
    texts += ["".join(chance.choice("ab \n") for _ in range(chance.randint(0, 9))) for _ in range(300)]
    texts += ["common prefix " + str(i % 7) * 2000 for i in range(60)]
    return list(enumerate(texts))


def test_edge_cases(spark, docs):
    docs = docs + docs[:40] + [(None, "only without id"), (None, "only without id"), (None, "a")]
    docs += [(900, "twice"), (900, "twice"), (901, "twice"), (900, "another text")]
    random.Random(5).shuffle(docs)
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    assert got(groups(df)) == brute(docs)


def test_spilled_subtrees(spark, docs):
    """Tries far too small for their texts: all owners come from later rounds or stubs."""
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    assert got(groups(df, budget=4000, bucket=1 << 40)) == brute(docs)
    assert got(groups(df, budget=900, bucket=1 << 40)) == brute(docs)


def test_empty_table_and_other_columns(spark):
    assert groups(spark.createDataFrame([], SCHEMA)).collect() == []
    names = "doc_id long, text string, n long, digest string, keep_id long, row int, __heavy int"
    df = spark.createDataFrame([(1, "x", 5, "d", 9, 8, 7), (2, "x", 6, "e", 9, 8, 7)], names)
    assert [r[:4] for r in got(groups(df))] == [(1, 1, 2, True), (2, 1, 2, False)]
    assert [tuple(r) for r in drop_copies(df).collect()] == [(1, "x", 5, "d", 9, 8, 7)]


def test_rows_that_stay(spark, docs):
    docs = docs + [(None, "no id"), (None, "no  id"), (7, "x\x0b"), (7, "x\x0b")]
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    left = got(drop_copies(df).select("doc_id"))
    assert left == sorted(((r[0],) for r in brute(docs) if r[3]), key=repr)


@pytest.mark.parametrize("stubs", [True, False])
def test_trie_against_a_dictionary(stubs):
    chance = random.Random(8)
    for _ in range(60):
        trie, plain, away, named = Trie(), defaultdict(list), defaultdict(list), {}
        for i in range(chance.randint(1, 200)):
            key = bytes(chance.choice(b"abc") for _ in range(chance.randint(0, 12)))
            plain[key].append(i)
            path = trie.insert(key, Owner(i, 1, 1, b""))
            if path is not None:
                assert key.startswith(path) and named[key[: len(path)]] == path
                away[key].append((i, 1))
            if trie.held > 3000:
                for path, whole, owner in trie.spill(1500, stubs):
                    assert whole.startswith(path)
                    # One string never leaves under two names.
                    assert not stubs or not any(path != p and (path.startswith(p) or p.startswith(path)) for p in named)
                    named[path] = path
                    away[whole].append((owner.least, owner.n))
        for whole, owner in trie.owners():
            away[whole].append((owner.least, owner.n))
        assert {k: (min(v), len(v)) for k, v in plain.items()} == {
            k: (min(i for i, _ in v), sum(n for _, n in v)) for k, v in away.items()
        }


def test_one_text_in_a_third_of_all_rows(spark):
    rows = spark.range(30_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', string(id)) AS text")
    found = groups(rows.repartition(8)).groupBy("group_size").count().collect()
    assert sorted(map(tuple, found)) == [(1, 20_000), (10_000, 10_000)]


def test_normalised():
    assert normalised(None) == b"" and normalised(b" \t a\n\n\n b\r") == b" a b "
    assert exact_dedup.content_hash(b"\xff" * 32) == -1
