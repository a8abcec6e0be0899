from __future__ import annotations

import random
import re

import duckdb
import numpy as np
import pytest

from agorameter.llm import ngram_join, queries, sql
from agorameter.llm.graph import components
from agorameter.llm.ngram_join import jaccard_components, signatures

FOLDER = "/root/testdata/sf0.01"


def brute(docs, size, percent):
    sets = {}
    for i, t in docs:
        if i is None:
            continue
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall("[^\x20\x09-\x0d]+", lower)
        k = min(size, max(1, len(w)))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                    a, b = sorted((root(x), root(y)))
                    label[b] = a
    return sorted((i, len(sets[i]), root(i)) for i in ids)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_whole_table(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    expected = sorted(connection.execute(sql.JACCARD).fetchall(), key=repr)
    assert got(queries.op3_ngram_join(spark, FOLDER)) == expected
    assert sum(r[0] != r[2] for r in expected) > 20


@pytest.fixture
def docs(spark):
    """Families of copies with a few edits each, on both sides of the threshold."""
    chance = random.Random(11)
    texts = []
    for family in range(8):
        words = [f"w{chance.randint(0, 400)}" for _ in range(chance.choice([8, 20, 60, 200]))]
        for _ in range(14):
            copy = list(words)
            for _ in range(chance.randint(0, max(1, len(words) // 25))):
                copy[chance.randrange(len(copy))] = f"x{chance.randint(0, 10**6)}"
            texts.append(" ".join(copy))
    texts += ["A b", "a  B", "a b c", "", " \n", None, "z " * 5000, "Z " * 4000, "é É"]
    rows = [(i, t, 1, "k") for i, t in enumerate(texts)]
    rows += [(3, texts[3], 1, "k"), (None, texts[3], 1, "k"), (None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n int, key string").repartition(5)


@pytest.mark.parametrize(
    ("size", "percent", "limit"), [(3, 90, 0.0), (3, 90, 3.0), (5, 80, 0.0), (1, 95, 1e9)]
)
def test_against_all_pairs(docs, size, percent, limit, monkeypatch):
    """With all tokens frequent, some, and none."""
    monkeypatch.setattr(ngram_join, "rare_limit", lambda counts: limit)
    monkeypatch.setattr(ngram_join, "TILE", 5 if limit < 1 else 512)
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    rows = got(jaccard_components(docs, size=size, percent=percent))
    assert [r for r in rows if r[0] is None] == [r for r in rows if r[2] is None]
    assert sorted({r for r in rows if r[0] is not None}) == brute(plain, size, percent)
    assert len(rows) == docs.count()


def test_linked_sets_share_an_entry():
    """Random pairs at the threshold, for every split into rare and frequent tokens."""
    chance = np.random.default_rng(2)
    for percent in (80, 90, 95):
        for _ in range(400):
            n = int(chance.integers(1, 120))
            x = np.unique(chance.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
            y = x[chance.random(len(x)) > chance.random() * (100 - percent) / 100]
            extra = chance.integers(0, 2**63, int(chance.integers(0, 1 + n // 8))).astype(np.uint64)
            y = np.unique(np.concatenate((y, extra * np.uint64(2))))
            both = len(np.intersect1d(x, y))
            if not both or 100 * both < percent * (len(x) + len(y) - both) or np.array_equal(x, y):
                continue
            counts = chance.integers(0, 100, 1 << ngram_join.SLOT_BITS)
            limit = float(chance.integers(-1, 100))
            a, b = (signatures(s, counts, limit, percent) for s in (x, y))
            assert len(np.intersect1d(a, b)), (percent, len(x), len(y), limit)


def test_profiles_never_rule_out_a_link():
    chance = np.random.default_rng(3)
    for n in (1, 20, 500, 3_000):
        for kept in (0.5, 0.85, 0.95, 1.0):
            x = np.unique(chance.integers(0, 2**64, n, dtype=np.uint64))
            new = chance.integers(0, 2**64, n, dtype=np.uint64)[: int((1 - kept) * n)]
            y = np.unique(np.concatenate((x[chance.random(len(x)) < kept], new)))
            both = len(np.intersect1d(x, y))
            made = [ngram_join.profile(s) for s in (x, y)]
            a, b = ngram_join._profiles(made)
            passed = ngram_join.may_link(a, b, np.array(len(x)), np.array(len(y)), 90)
            passed = passed and ngram_join.large_may_link(*made, len(x), len(y), 90)
            if 100 * both >= 90 * (len(x) + len(y) - both):
                assert passed
            elif 20 <= n and kept <= 0.85:
                assert not passed


def test_components(spark):
    chance = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 900), (900, 7), (7, 7)]
    edges += [(1000 + chance.randrange(300), 1000 + chance.randrange(300)) for _ in range(200)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: label[x] for x in linked}


def test_empty_table(docs):
    assert jaccard_components(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        jaccard_components(docs, percent=70)
