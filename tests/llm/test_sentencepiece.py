from __future__ import annotations

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from agorameter.llm import queries, sentencepiece
from agorameter.llm.common import table
from agorameter.llm.sentencepiece import UNIT, cut_unit, decode, encode, load_pieces, normalised

PATH = public_tokenizers.path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pieces():
    return load_pieces(PATH, merges=False)


@pytest.fixture(scope="module")
def merges():
    return load_pieces(PATH, merges=True)


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def brute(text, pieces):
    """Viterbi over the whole text; of equal paths the longer last piece."""
    table = {p: (i, s) for p, i, s in pieces.rows}
    whole = normalised(text or "")
    best = [(0.0, 0, [])]
    for end in range(1, len(whole) + 1):
        found = None
        for start in range(max(0, end - pieces.longest), end):
            part = whole[start:end]
            if part in table:
                ids, score = [table[part][0]], table[part][1]
            elif end - start == 1:
                ids, score = [b + pieces.first_byte for b in part.encode()], pieces.unknown
            else:
                continue
            if found is None or best[start][0] + score > found[0]:
                found = (best[start][0] + score, start, ids)
        best.append(found)
    ids, end = [], len(whole)
    while end:
        ids = best[end][2] + ids
        end = best[end][1]
    return ids


def test_whole_table(spark, library):
    docs = dict(map(tuple, table(spark, FOLDER, "documents").select("doc_id", "text").collect()))
    rows = queries.op9_sentencepiece(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.round_trip for r in rows)
    for r in rows:
        ids = library.encode(docs[r.doc_id] or "")
        assert (r.n_ids, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


@pytest.fixture
def docs(spark):
    chance = random.Random(7)
    parts = ["the", " ", "  ", "\n", "ing", "é", "字", "🙂", "\t", "▁", "x", "<s>", "\x00", "ation", "(", "a" * 40]
    texts = ["".join(chance.choices(parts, k=chance.randint(1, 30))) for _ in range(60)]
    texts += [None, "", " ", "ab" * 100, "\n" * 20]
    rows = [(i, t, "k", 0) for i, t in enumerate(texts)]
    rows += [(3, texts[3], "k", 0), (None, texts[4], "k", 0), (None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, word string, id int").repartition(5)


@pytest.mark.parametrize("kept", [0, 30])
def test_best_paths(docs, pieces, kept, monkeypatch):
    """Whatever units the workers keep."""
    monkeypatch.setattr(sentencepiece, "KEPT", kept)
    expected = [(r.doc_id, brute(r.text, pieces)) for r in docs.collect()]
    rows = encode(docs, pieces)
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted(expected, key=repr)


def test_merges_give_the_ids_of_the_library(docs, merges, library, monkeypatch):
    monkeypatch.setattr(sentencepiece, "KEPT", 20)
    for r in encode(docs, merges).join(docs.select("doc_id", "text"), "doc_id").collect():
        assert r.ids == library.encode(r.text or ""), r.text


def test_decode(docs, pieces):
    rows = decode(encode(docs, pieces), pieces).collect()
    expected = [(r.doc_id, (r.text or "").replace("▁", " ")) for r in docs.collect()]
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)


def test_the_library_decodes_the_ids(docs, pieces, library):
    texts = {r.doc_id: r.text for r in docs.where("doc_id IS NOT NULL").collect()}
    for r in encode(docs, pieces).where("doc_id IS NOT NULL").collect():
        assert library.decode(r.ids) == (texts[r.doc_id] or "").replace("▁", " ")


def test_stretches_of_a_long_unit(spark, pieces):
    long = "ab" * 700
    df = spark.createDataFrame([(1, long)], "doc_id long, text string")
    (row,) = encode(df, pieces, digest=True).collect()
    unit = normalised(long)
    parts = [brute(unit[i : i + 256].replace("▁", " "), pieces) for i in range(0, len(unit), 256)]
    assert row.round_trip and row.n_ids <= sum(map(len, parts))


@pytest.mark.parametrize("size", [257, 300, 10_000])
def test_long_units_are_folded_whole(spark, merges, library, size):
    chance = random.Random(size)
    base64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    texts = ["ab" * size, "a" * size, "=" * size, " " * size, "\n" * size, "the" * size, "ation=" * size]
    texts += ["".join(chance.choices(letters, k=size)) for letters in (base64, "0123456789abcdef", "aetion", "é字a")]
    texts += [f"x {t} y" for t in texts]
    texts = [t[:size] if len(t) > size + 4 else t for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in encode(df, merges).collect():
        assert r.ids == library.encode(texts[r.doc_id]), texts[r.doc_id][:40]


def test_long_units_by_the_best_path(spark, pieces):
    texts = ["ab" * 150, "".join(random.Random(3).choices("aetion", k=700))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in encode(df, pieces).collect():
        assert r.ids == brute(texts[r.doc_id], pieces)


def test_units_and_cuts(pieces):
    text = normalised("ab  cd \n\n e▁")
    assert "".join(UNIT.findall(text)) == text
    table = {p for p, _, _ in pieces.rows}
    for unit in UNIT.findall(normalised("hello(world) *** foo.bar | x$$y")):
        parts = cut_unit(unit, pieces.joints)
        assert "".join(parts) == unit
        crossing = [
            unit[a:b]
            for a in range(len(unit))
            for b in range(a + 1, len(unit) + 1)
            if any(a < e < b for e in np.cumsum([len(p) for p in parts]))
        ]
        assert not table & set(crossing)


def steps(df):
    """The shuffles, joins, explosions and groupings of the plan, without the pieces in its constants."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"^[ :+-]*(?:\*\(\d+\) )?(\w*(?:Exchange|Generate|Join|Aggregate)\w*)", plan, re.M)


@pytest.mark.parametrize("digest", [False, True])
def test_nothing_is_shuffled(docs, pieces, digest):
    """Neither edges nor ids become rows, which spilled and grew beyond the disk."""
    encoded = encode(docs.limit(3).localCheckpoint(), pieces, digest=digest)
    assert steps(encoded.repartition(2)) and not steps(encoded)


def test_decoding_stays_in_the_row(spark, pieces):
    rows = spark.createDataFrame([(1, [13, None, 5]), (None, None), (1, [])], "doc_id long, ids array<int>")
    assert not steps(decode(rows, pieces))
    assert sorted((r.doc_id or 0, len(r.text)) for r in decode(rows, pieces).collect())[:2] == [(0, 0), (1, 0)]


def test_units_of_a_text():
    """The short way cuts as the pattern does."""
    chance = random.Random(2)
    for _ in range(3000):
        text = "".join(chance.choices(["a", "b.", " ", "\n", "é", "\t", "▁", "\r"], [5, 3, 4, 2, 1, 1, 0.2, 1], k=chance.randint(0, 9)))
        assert sentencepiece.units_of(text) == UNIT.findall(normalised(text)), repr(text)


def test_empty_table(docs, pieces):
    assert encode(docs.limit(0), pieces).collect() == []


def test_whole_table_by_the_best_path(spark, pieces):
    """Encoded by Viterbi, decoded by joins, and the same as before."""
    docs = dict(map(tuple, table(spark, FOLDER, "documents").select("doc_id", "text").collect()))
    rows = {r.doc_id: r for r in queries.sentencepiece_viterbi(spark, FOLDER).collect()}
    assert sorted(rows) == sorted(docs)
    assert all(r.round_trip for r in rows.values())
    for i in sorted(docs, key=lambda i: len(docs[i] or ""))[:25]:
        assert rows[i].n_ids == len(brute(docs[i], pieces))


def test_known_neighbours_give_the_ids_of_merges(spark, merges, library):
    """Units that are not kept get their ids from the neighbours in others, without a fold."""
    chance = random.Random(11)
    syllables = ["the", "ing", "er", "tion", "on", "re", "é", "Ü", "123", "st", "\U00013000"]
    words = ["".join(chance.choices(syllables, k=chance.randint(1, 6))) for _ in range(4000)]
    texts = [" ".join(words[i : i + 20]) for i in range(0, 2000, 20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "key long, text string")
    kept, follow = sentencepiece.frequent_units(docs, merges).unpacked
    table = {p: (i, score) for p, i, score in merges.rows}
    new = {p for w in words[2000:] for p in cut_unit(normalised(w), merges.joints)} - set(kept)
    found = {w: sentencepiece.known_path(w, kept, follow) for w in new}
    assert sum(path is not None for path in found.values()) > len(new) / 2 > 100
    for word, path in found.items():
        if path is not None:
            assert np.frombuffer(path, "<i4").tolist() == sentencepiece.fold_long(word, merges, table), word
    rows = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    for r in encode(rows, merges).collect():
        assert r.ids == library.encode(words[r.doc_id]), words[r.doc_id]


def test_the_driver_holds_no_kept_units(docs, merges, pieces):
    """They come packed from the tasks and are unpacked in the workers only."""
    rows = docs.select(F.col("doc_id").alias("key"), "text")
    for own in (merges, pieces):
        kept = sentencepiece.frequent_units(rows, own)
        assert kept.parts and all(isinstance(p, bytes | bytearray) for p in kept.parts)
        assert "unpacked" not in vars(kept)
    assert len(kept.unpacked[0]) > 20 and not kept.unpacked[1]
