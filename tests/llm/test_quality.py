from __future__ import annotations

import binascii
import math

import numpy as np
import pytest

from agorameter.llm import quality, queries
from agorameter.llm.common import table

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in queries.op7_quality(spark, FOLDER).collect()}
    assert len(rows) == table(spark, FOLDER, "documents").count()
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    for r in rows.values():
        assert r.held_out == (binascii.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for i, r in rows.items() if r.held_out and i in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in held)
    assert right >= 0.93 * len(held), (right, len(held))
    ranks = sorted(held, key=lambda r: r.score)
    good = [i for i, r in enumerate(ranks, 1) if labels[r.doc_id] == 1]
    bad = len(held) - len(good)
    auc = (sum(good) - len(good) * (len(good) + 1) / 2) / (len(good) * bad)
    assert auc > 0.97


def test_scores_equal_the_density_formula(spark):
    chance = np.random.default_rng(3)
    d = len(quality.STATISTICS)
    x = chance.normal(size=(300, d)) * np.arange(1, d + 1)
    label = (chance.random(300) < 0.7).astype(int)
    x[label == 1] += 2
    rows = [(list(map(float, a)), int(b)) for a, b in zip(x, label, strict=True)]
    rows += [(rows[0][0], None), (rows[0][0], 7)]
    model = quality.fit(spark.createDataFrame(rows, "x array<double>, label int"), 0.1, 1.0)
    got = model.score(x[:20])
    center, scale = x.mean(0), x.std(0)
    odds = np.zeros(20)
    for c, sign in ((1, 1), (0, -1)):
        z = (x[label == c] - center) / scale
        s = np.cov(z.T, bias=True)
        s = 0.9 * s + 0.1 * np.trace(s) / d * np.eye(d)
        diff = (x[:20] - center) / scale - z.mean(0)
        distance = np.einsum("ij,jk,ik->i", diff, np.linalg.inv(s), diff)
        part = -0.5 * distance - 0.5 * np.linalg.slogdet(s)[1] + math.log((label == c).mean())
        odds += sign * part
    assert np.allclose(got, 1 / (1 + np.exp(-odds)), atol=1e-9)


@pytest.mark.parametrize("text", [None, "", "!!!!", "a", "\n\n", "x " * 100_000, "é\x00"])
def test_statistics_are_finite(text):
    assert np.isfinite(quality.statistics(text)).all()


def test_missing_classes(spark):
    docs = spark.createDataFrame(
        [(1, "a b", "x"), (1, "a b", "y"), (None, None, None)], "doc_id long, text string, x string"
    )
    vectors = quality.with_statistics(docs, "doc_id", "text")
    for label, score in ((1, 1.0), (0, 0.0), (None, 0.5)):
        labelled = vectors.selectExpr("*", f"CAST({'NULL' if label is None else label} AS int) AS label")
        rows = quality.predict(vectors, quality.fit(labelled)).collect()
        assert [r.score for r in rows] == [score] * 3
    assert quality.predict(vectors.limit(0), quality.fit(labelled)).collect() == []
