from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from agorameter.llm import packing, queries
from agorameter.llm.common import table
from agorameter.llm.tokens import encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_tokenizer(plain):
    chance = random.Random(5)
    alphabet = [chr(c) for c in range(0x180)] + list("'' sdmtlrve  \n\té½²İSS—€“字🙂Σς́")
    texts = ["".join(chance.choices(alphabet, k=n)) for n in range(1, 400)]
    texts += ["", "It's we'll THEY'VE don't I'd 's''t", "<|endoftext|> a", "a" * 500, "İstanbul ẞ"]
    for text in texts:
        assert np.frombuffer(encoder(PATH).encode(text), "<u4").tolist() == plain(text), text


def check(rows, docs, plain, size):
    ids = {i: [*plain(t), 0] for i, t in docs}
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for i, own in pieces.items():
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids[i]) // size)))
        for r in own:
            part = ids[i][r.start : r.start + r.length]
            assert r.start == r.piece * size and len(part) == r.length
            assert r.length == min(size, len(ids[i]) - r.start)
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= size
    return len(places), -(-sum(map(len, ids.values())) // size)


def test_whole_table(spark, plain):
    docs = [tuple(r) for r in table(spark, FOLDER, "documents").select("doc_id", "text").collect()]
    made, least = check(queries.op4_pack(spark, FOLDER).collect(), docs, plain, 2048)
    assert made <= least + 1


def test_rounds(spark, plain, monkeypatch):
    """Small groups force several rounds."""
    monkeypatch.setattr(packing, "ITEMS", 16)
    chance = random.Random(2)
    docs = [(i, "word " * chance.randint(0, 90)) for i in range(300)] + [(300, None), (301, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = packing.pack(df, PATH, size=64).collect()
    made, least = check(rows, docs, plain, 64)
    assert made <= 1.1 * least


def test_edge_cases(spark):
    df = spark.createDataFrame(
        [(1, "a b", 3, "x"), (1, "a b", 3, "x"), (None, None, None, None)],
        "doc_id long, text string, bin int, key string",
    )
    rows = packing.pack(df, PATH, with_ids=True)
    assert sorted(r.length for r in rows.collect()) == [1, 3, 3]
    whole = packing.sequences(rows).collect()
    assert len(whole) == 1 and len(whole[0].ids) == 7
    assert packing.pack(df.limit(0), PATH).collect() == []


def test_best_fit():
    lengths = np.array([5, 5, 3, 7, 2, 8, 10])
    bins, places = packing.best_fit(lengths, 10)
    assert bins.max() == 3 and len(places) == 7
