from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from agorameter.llm import divergence, queries, sql
from agorameter.llm.divergence import audit, merge, shares, terms

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string"
FIND = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs):
    groups, langs, seen = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in docs:
        words = FIND.findall((text or "").translate(LOWER))
        groups[lang or "", source or ""].update(words)
        seen[lang or ""].update(set(words))
    kept = {lang: {t for t, n in c.items() if n >= 3} for lang, c in seen.items()}
    for (lang, _), counts in groups.items():
        langs[lang].update(counts)

    def given(counts, lang):
        n, v = sum(counts[t] for t in kept[lang]), len(kept[lang])
        return {t: 1 + 10**9 * (counts[t] + 1) // (n + v) for t in kept[lang]}

    shares_of = {key: given(counts, key[0]) for key, counts in groups.items()}
    rows = []
    for (lang, source), p in shares_of.items():
        pairs = [
            (-sum((p[t] - q[t]) ** 2 // q[t] for t in p), other.encode())
            for (of, other), q in shares_of.items()
            if of == lang and other != source
        ]
        everywhere = given(langs[lang], lang)
        over = [
            (-((p[t] - q) ** 2 // q), t.encode())
            for t, q in everywhere.items()
            if groups[lang, source][t] and p[t] > q
        ]
        for part, found, most in (("pair", pairs, None), ("term", over, 200)):
            for rank, (value, item) in enumerate(sorted(found)[:most], 1):
                rows.append((lang, source, part, item.decode(), -value, rank))
    return sorted(rows)


def got(df):
    return sorted(map(tuple, df.collect()))


def test_whole_table(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    docs = connection.execute("SELECT doc_id, text, lang, source FROM documents").fetchall()
    found = got(queries.op11_divergence(spark, FOLDER))
    assert found == brute(docs)
    assert found == sorted(connection.execute(sql.DIVERGENCE).fetchall())


@pytest.fixture(scope="module")
def docs():
    chance = random.Random(6)
    docs = []
    for i in range(400):
        words = [chance.choice(["Aé", "b", "İ", "x1y", "C-d", "ÄÖ", "ñ", "tail" + str(i // 5)]) for _ in range(30)]
        docs.append((i, " ".join(words), chance.choice(["a", "b", "", None]), f"s{chance.randint(0, 40)}"))
    docs += [(900, None, "a", "no text"), (901, "", "a", ""), (902, "!", "a", None), (903, "1 2", "none", "x")]
    docs += [(904, "rare", "none", "y"), (904, "rare", "none", "z"), (None, "one", "alone", "only")]
    docs += [(None, "three", "z", "hot")] * 3 + [(905, "three", "z", "é"), (906, "three", "z", "zz")]
    return docs


def test_edge_cases(spark, docs, monkeypatch):
    assert got(audit(spark.createDataFrame(docs, SCHEMA).repartition(3))) == brute(docs)
    monkeypatch.setattr(divergence, "BLOCK_BITS", 2)
    monkeypatch.setattr(divergence, "TILE", 3)
    monkeypatch.setattr(divergence, "HELD", 10)
    assert got(audit(spark.createDataFrame(docs, SCHEMA).repartition(3))) == brute(docs)


def test_empty_table_and_other_columns(spark, docs):
    assert got(audit(spark.createDataFrame([], SCHEMA))) == []
    names = SCHEMA + ", term string, n int, total int, place int, kept int, block int, terms int"
    df = spark.createDataFrame([(*r, "t", 1, 2, 3, 4, 5, 6) for r in docs[:100]], names)
    assert got(audit(df)) == brute(docs[:100])


def test_terms():
    assert terms("Aé_İx1ÄB c".encode()) == [t.encode() for t in ("aé", "İx", "Äb", "c")]


def test_shares_of_huge_counts():
    counts = np.array([0, 5, 10**12, 3 * 10**14], dtype=np.int64)
    whole = 4 * 10**14 + 7
    assert shares(counts, whole).tolist() == [1 + 10**9 * (int(c) + 1) // whole for c in counts]


def test_merge_against_all_terms():
    chance = np.random.default_rng(2)
    for _ in range(50):
        full = chance.integers(0, 4, (2, 60)) * (chance.random((2, 60)) < chance.random((2, 1)))
        sides = []
        for counts in full:
            ids = np.flatnonzero(counts)
            whole = int(counts.sum()) + 60
            sides.append((ids, shares(counts[ids], whole), shares(np.zeros(1, np.int64), whole)))
        p, q = (shares(c, int(c.sum()) + 60) for c in full)
        expected = [((p - q) ** 2 // q).sum(), ((p - q) ** 2 // p).sum()]
        assert merge(*sides, 60).tolist() == expected
