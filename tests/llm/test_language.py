from __future__ import annotations

import binascii

import numpy as np
import pytest

from agorameter.llm import language, queries
from agorameter.llm.common import table
from agorameter.llm.language import Settings, counts, temperature

FOLDER = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    rows = queries.op1_language_id(spark, FOLDER).collect()
    truth = {r.doc_id: r.lang for r in table(spark, FOLDER, "documents").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    for r in rows:
        assert r.held_out == (binascii.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def naive(text, settings):
    s = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    while "  " in s:
        s = s.replace("  ", " ")
    return sum(max(0, len(s) - n) for n in range(settings.longest)), s


@pytest.mark.parametrize("text", ["a", "Ab, cd!", "a" * 50 + " $$ é " * 20, "  x  ", "日本 語"])
def test_counts_do_not_depend_on_stretches(text):
    whole = counts(text, Settings())
    assert whole.sum() == naive(text, Settings())[0]
    for stretch in (1, 2, 3, 7):
        assert (counts(text, Settings(stretch=stretch)) == whole).all()
    assert (counts(naive(text, Settings())[1].strip(), Settings()) == whole).all()


def test_no_letters():
    assert counts("12 $$ -", Settings()) is None and counts("²½", Settings()) is None


@pytest.fixture
def docs(spark):
    rows = [(i, "the cat and the dog " * (1 + i % 3), "en") for i in range(40)]
    rows += [(100 + i, "der hund und die katze " * (1 + i % 3), "de") for i in range(40)]
    rows += [(1, "the cat", "en"), (None, None, None), (200, "", "en"), (201, "42 !", None)]
    rows += [(202, "und die katze" * 20000, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr(
        "*", "'x' AS score", "0 AS `order`", "'y' AS label"
    )


def test_edge_cases(docs):
    model = language.fit(docs)
    rows = {r.doc_id: r for r in language.predict(docs, model, keep=["doc_id"]).collect()}
    assert len(rows) == 84
    assert rows[202].lang_pred == "de" and rows[3].lang_pred == "en"
    for key in (None, 200, 201):
        assert (rows[key].lang_pred, rows[key].score) == ("und", 0.0)
    assert (model.weights == 0).mean() > 0.9  # sparse


def test_nothing_to_learn(docs):
    for empty in (docs.limit(0), docs.where("lang IS NULL")):
        model = language.fit(empty)
        assert {r.lang_pred for r in language.predict(docs, model).collect()} == {"und"}
    assert language.predict(docs.limit(0), language.fit(docs)).collect() == []


def test_temperature():
    chance = np.random.default_rng(1)
    labels = chance.integers(0, 2, 4000)
    logits = np.zeros((4000, 2))
    right = chance.random(4000) < 0.8
    logits[np.arange(4000), np.where(right, labels, 1 - labels)] = 10.0
    t = temperature(logits, labels)
    assert abs(1 / (1 + np.exp(-10 / t)) - 0.8) < 0.02


def brute_counts(text, settings):
    """Bucket counts from the n-grams of the whole normalised text, one by one."""
    total = [0] * settings.buckets
    body, shift = naive(text, settings)[1], 32 - (settings.buckets.bit_length() - 1)
    for size in range(1, settings.longest + 1):
        for start in range(len(body) - size + 1):
            hashed = 0
            for place, char in enumerate(body[start : start + size]):
                hashed = (hashed + ord(char) * language.PLACES[place]) % 2**32
            hashed = (hashed ^ hashed >> 15) * (0x2C1B3C6D + 2 * (size - 1)) % 2**32
            total[hashed >> shift] += 1
    return total


@pytest.mark.parametrize("text", ["The cat, 2 dogs", "ÀÉ  ñandú!", "日本 語 x", "a" * 99])
def test_counts_against_single_grams(text):
    assert counts(text, Settings(buckets=256)).tolist() == brute_counts(text, Settings(buckets=256))


def test_every_language_is_learned(spark):
    """300 languages, each of a letter of its own: none is left out."""
    names = [chr(0x4E00 + i) for i in range(300)]
    rows = [(i, name * 9 + " " + name, name) for i in range(6) for name in names]
    docs = spark.createDataFrame([(i, t, lang) for i, (_, t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    settings = Settings(weights=1 << 20)
    model = language.fit(docs, settings=settings)
    assert model.languages == sorted(names)
    assert model.weights.shape == (1 << 12, 300)
    found = language.predict(docs, model, keep=["lang"]).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.9 * len(found)
