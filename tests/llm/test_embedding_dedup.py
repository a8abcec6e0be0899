from __future__ import annotations

import duckdb
import numpy as np
import pytest

from agorameter.llm import embedding_dedup, queries, sql
from agorameter.llm.embedding_dedup import (
    LEAST_HEAD,
    MEAN,
    MISS,
    NEXT,
    deduplicate,
    forest,
    neighbours,
    plan,
)

FOLDER = "/root/testdata/sf0.01"


def brute(rows, threshold=0.9):
    good = [
        (i, np.array(v, dtype=float))
        for i, v in rows
        if i is not None
        and v is not None
        and all(x is not None and np.isfinite(x) for x in v)
        and any(x != 0 for x in v)
    ]
    near = {i: set() for i, _ in good}
    for i, x in good:
        for j, y in good:
            if i != j and len(x) == len(y):
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold:
                    near[i].add(j)
    label = {i: i for i in near}
    for _ in near:
        changed = False
        for i in near:
            low = min([label[i], *(label[j] for j in near[i])])
            changed |= low != label[i]
            label[i] = low
        if not changed:
            break
    return {(i, len(near.get(i, ())), label.get(i, i), i is None or label.get(i, i) == i) for i, _ in rows}


def test_whole_table(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{FOLDER}/embeddings.parquet'")
    expected = sorted(connection.execute(sql.EMBEDDINGS).fetchall())
    assert sorted(map(tuple, queries.op6_embedding_dedup(spark, FOLDER).collect())) == expected


@pytest.fixture(scope="module")
def rows():
    """Groups of near and exact copies, two of them large, among random vectors."""
    chance = np.random.default_rng(5)
    made = []
    for group, noise in ((150, 0.02), (90, 0.0), (5, 0.03), (2, 0.04), (2, 0.05), (2, 0.01)):
        x = chance.standard_normal(32)
        made += [x + noise * np.linalg.norm(x) * chance.standard_normal(32) / 3 for _ in range(group)]
    made += list(chance.standard_normal((250, 32)))
    order = chance.permutation(len(made))
    rows = [(int(i), [float(v) for v in made[j]]) for i, j in enumerate(order)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 32), (1003, [1.0] * 31 + [float("nan")])]
    rows += [(1004, [1.0] * 31 + [None]), (1005, [1e300] * 32), (1006, [1e-300] * 32)]
    rows += [(1007, [1.0] * 31), (1008, [2.0] * 31), (1009, [float("inf")] * 32)]
    return rows + [rows[7], rows[7], (None, rows[7][1])]


def test_against_all_pairs(spark, rows, monkeypatch):
    """Blocks and tiles much smaller than the large groups."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", 128)
    monkeypatch.setattr(embedding_dedup, "TILE", 32)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "1 AS size", "2 AS code", "'x' AS key"
    )
    found = deduplicate(df.repartition(6)).collect()
    assert len(found) == len(rows)
    assert set(map(tuple, found)) == brute(rows)


def test_empty_table(spark, rows):
    df = spark.createDataFrame(rows[:1], "vec_id long, embedding array<float>")
    assert deduplicate(df.limit(0)).collect() == []
    assert [tuple(r) for r in deduplicate(df).collect()] == [(rows[0][0], 0, rows[0][0], True)]


def test_forest():
    assert forest([(1, 2), (2, 1), (1, 3), (2, 3), (5, 4)]) == [(1, 2), (1, 3), (5, 4)]


@pytest.mark.parametrize("n", [1, 500, 50_000, 10**6, 5 * 10**7, 10**10])
def test_the_miss_bound_holds_at_every_size(n):
    head, passes = plan(n, 0.9)
    assert head >= LEAST_HEAD and n / 2**head <= MEAN
    assert (1 - (1 - np.arccos(0.9) / np.pi) ** head) ** passes <= MISS


def test_windows_and_runs():
    """All pairs of a run, and the next ones beyond it, but not those of another pass."""
    chance = np.random.default_rng(3)
    x = embedding_dedup.unit(chance.standard_normal((200, 4)))
    runs = np.stack((np.full(200, 4), np.arange(200) // 120, np.arange(200) // 20))
    own = 150
    found = neighbours(x, runs, own, 0.5)
    expected = [
        (i, j)
        for i in range(own)
        for j in range(i + 1, 200)
        if runs[1, i] == runs[1, j] and x[i] @ x[j] >= 0.5
        and ((runs[2, i] == runs[2, j] and j < own) or j - i <= NEXT)
    ]

    def groups(pairs):
        label = list(range(200))
        for _ in range(200):
            for a, b in pairs:
                label[a] = label[b] = min(label[a], label[b])
        return label

    assert set(found) and groups(found) == groups(expected)


def test_pairs_in_a_dense_group(spark, monkeypatch):
    """Pairs at the threshold among 6,000 vectors that lie close to a common direction."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", 1024)
    chance = np.random.default_rng(8)
    n, pairs = 6000, 200
    common = chance.standard_normal(64)
    common /= np.linalg.norm(common)

    def across(x):
        x = x - (x @ common)[:, None] * common
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    ways = across(chance.standard_normal((n, 64)))
    turn = across(chance.standard_normal((pairs, 64)))
    turn -= (turn * ways[:pairs]).sum(axis=1, keepdims=True) * ways[:pairs]
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    # Others of the group have a cosine of some 0.7225, these of 0.905.
    inner = (0.905 - 0.7225) / 0.2775
    ways[-pairs:] = inner * ways[:pairs] + np.sqrt(1 - inner**2) * turn
    x = 0.85 * common + np.sqrt(0.2775) * ways
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    assert near.sum() >= 2 * pairs
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in deduplicate(df).collect()}
    assert sum(found.values()) >= 0.99 * near.sum()
