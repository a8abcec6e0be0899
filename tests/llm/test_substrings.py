from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from agorameter.llm import queries, sql, substrings
from agorameter.llm.substrings import remove_repeats, winnowed, within_reach
from agorameter.llm.words import word_hashes

FOLDER = "/root/testdata/sf0.001"


def brute(docs, window):
    words = [(i, re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t in docs]
    first = {}
    for i, w in sorted(words, key=lambda x: (x[0] is not None, x[0] or 0)):
        for s in range(len(w) - window + 1):
            first.setdefault(tuple(w[s : s + window]), (i, s))
    rows = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] != (i, s):
                gone |= set(range(s, s + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        rows.append((i, len(w), len(gone), kept))
    return rows


def digested(rows):
    return sorted(
        ((i, n, r, hashlib.sha256(k.encode()).hexdigest()) for i, n, r, k in rows), key=repr
    )


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_whole_table(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    docs = connection.execute("SELECT doc_id, text FROM documents").fetchall()
    rows = got(queries.op8_substring_dedup(spark, FOLDER))
    assert rows == digested(brute(docs, 20))
    assert rows == sorted(connection.execute(sql.SUBSTRINGS).fetchall(), key=repr)


@pytest.fixture
def docs(spark):
    chance = random.Random(9)
    texts = [" ".join(chance.choice("abcd") for _ in range(chance.randint(0, 60))) for _ in range(80)]
    passage = " ".join(f"p{i}" for i in range(30))
    texts += [t + " \n" + passage + "\t" + t for t in texts[:20]] + texts[:10]
    texts += [passage, passage + " x", "x " + passage, None, "", "x" * 3000, "y " * 500]
    rows = [(i, t, "k", 0) for i, t in enumerate(texts)]
    rows += [(5, texts[5], "k", 0), (None, passage, "k", 1), (None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, starts int").repartition(7)


@pytest.mark.parametrize(("window", "start"), [(8, None), (8, 2), (7, 3), (5, 5), (20, 5), (1, 1)])
def test_levels(docs, window, start, monkeypatch):
    monkeypatch.setattr(substrings, "STRETCH", 200)
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    df = remove_repeats(docs, window=window, start=start, keep=["doc_id"], digest=True)
    assert got(df) == digested(brute(plain, window))


def test_texts_and_columns(docs):
    plain = brute([(r.doc_id, r.text) for r in docs.collect()], 20)
    df = remove_repeats(docs)
    assert df.columns == [*docs.columns, "n_words", "n_removed"]
    rows = {(r.doc_id, r.n_words): r for r in df.collect()}
    texts = {r.doc_id: r.text for r in docs.where("doc_id IS NOT NULL").collect()}
    for i, n, removed, kept in plain:
        if i is not None:
            assert rows[i, n].text == (kept if removed else texts[i])
    assert rows[None, 0].text is None


def test_empty_table(docs):
    assert remove_repeats(docs.limit(0)).collect() == []


def test_winnowing_keeps_every_window():
    words = word_hashes(" ".join(random.Random(1).choices("abcdefgh", k=300)).encode())
    starts, _ = winnowed(words, 4, 9)
    for i in range(300 - 9 + 1):
        assert ((starts >= i) & (starts <= i + 5)).any()
    assert within_reach(np.array([10]), 4, 8, 9, 300).tolist() == [5, 6, 7, 8, 9, 10, 11]
