from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from agorameter.llm import neighbours, queries
from agorameter.llm.common import table
from agorameter.llm.neighbours import search

FOLDER = "/root/testdata/sf0.01"


def brute(rows, wanted, k):
    """Nearest of each query, by cosine and then by id."""
    good = {
        i: np.array(v, dtype=float)
        for i, v in rows
        if i is not None
        and v is not None
        and all(x is not None and np.isfinite(x) for x in v)
        and any(x != 0 for x in v)
    }
    found = {}
    for q, x in good.items():
        if wanted(q):
            scored = []
            for i, y in good.items():
                if i != q and len(x) == len(y):
                    a, b = x / np.abs(x).max(), y / np.abs(y).max()
                    scored.append((-float(a @ b / np.sqrt((a @ a) * (b @ b))), i))
            found[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return found


def gathered(df, key="vec_id"):
    found = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        found[r.query_id].append((r[key], r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


def test_recall_on_the_whole_table(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "embeddings").select("vec_id", "embedding").collect()]
    expected = brute(rows, lambda i: i % 50 == 0, 5)
    found = gathered(queries.op5_neighbours(spark, FOLDER))
    assert set(found) == set(expected)
    hits = 0
    for q, best in expected.items():
        assert len(found[q]) == 5
        hits += len({i for i, _ in found[q]} & {i for i, _ in best})
    assert hits >= 0.9 * 5 * len(expected)
    exact = brute(rows, lambda i: i % 50 == 0, len(rows))
    for q, own in found.items():
        scores = dict(exact[q])
        assert all(abs(scores[i] - s) < 1e-12 for i, s in own)
        assert own == sorted(own, key=lambda x: (-x[1], x[0]))


@pytest.fixture
def rows():
    chance = np.random.default_rng(8)
    made = [(i, [float(x) for x in v]) for i, v in enumerate(chance.standard_normal((90, 8)))]
    made += [(100 + i, [1.0] * 8) for i in range(12)] + [(200, [2.0] * 8), (201, [1.0] * 7)]
    made += [(300, None), (301, []), (302, [0.0] * 8), (303, [float("nan")] * 8), (None, [1.0] * 8)]
    made += [(304, [None] + [1.0] * 7), (305, [1e200, -3e200] * 4), (306, [1e-300, -5e-300] * 4), made[3], made[100]]
    return made


def test_all_candidates(spark, rows, monkeypatch):
    """With a share of one the search is exact, whatever the shards and blocks."""
    monkeypatch.setattr(neighbours, "SHARD", 20)
    monkeypatch.setattr(neighbours, "BLOCK", 3)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.selectExpr("*", "1 AS score", "2 AS shard", "3 AS size", "'q' AS query")
    found = gathered(search(df, F.col("vec_id") % 10 == 0, share=1.0))
    expected = brute(rows, lambda i: i % 10 == 0, 5)
    assert set(found) == set(expected) - {q for q, best in expected.items() if not best}
    for q, own in found.items():
        assert [i for i, _ in own] == [i for i, _ in expected[q]]
        assert np.allclose([s for _, s in own], [s for _, s in expected[q]])


def test_windows_count_every_collision():
    chance = np.random.default_rng(4)
    x = chance.standard_normal((400, 16))
    index = neighbours.Index(x)
    wide = index.candidates(x[:5], 0, 1.0)
    assert all(len(c) == 400 for c in wide)
    for q, found in enumerate(index.candidates(x[:5], 10, 0.1)):
        assert q in found and 50 <= len(found) < 200


@pytest.mark.parametrize("wanted", [(0, 0.02), (10, 0.1), (96, 0.12), (0, 0.9)])
def test_windows_are_the_first_with_enough(wanted):
    """Those that grow step by step from the narrowest, and few of them are looked at."""
    chance = np.random.default_rng(5)
    x = chance.standard_normal((500, 16))
    x[:100] = x[0]
    x[400:] *= 30
    queries = np.concatenate([x[95:105], x[395:405], chance.standard_normal((5, 16))])
    index = neighbours.Index(x)
    enough = wanted[0] + int(np.ceil(wanted[1] * len(x)))
    apart = np.sort(np.abs((x @ index.planes)[None] - (queries @ index.planes)[:, None]), axis=2)
    needed = int(np.ceil(neighbours.COLLISIONS * neighbours.PROJECTIONS))
    looks = []
    grow = index._grow
    index._grow = lambda collided, *a: grow(lambda w: looks.append(w) or collided(w), *a)
    found = index.candidates(queries, *wanted)
    for q, places in enumerate(found):
        reached = apart[q, :, needed - 1]
        width = neighbours.FIRST * index.spread
        while (reached <= width).sum() < enough:
            width *= neighbours.GROWTH
        assert places.tolist() == np.flatnonzero(reached <= width).tolist()
    assert len(looks) < 12 * len(queries)


def test_empty_and_few(spark, rows):
    df = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    assert search(df.limit(0), F.lit(True)).collect() == []
    assert len(search(df, F.lit(True)).collect()) == 6
    assert search(df, F.lit(False)).collect() == []
