"""The pipeline against plain versions of its stages, each on the input the stage had."""

from __future__ import annotations

import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from agorameter.llm.common import table
from tests.llm import test_ngram_join as joins
from tests.llm import test_packing as packing
from tests.llm import test_secrets as scans
from tests.llm import test_substrings as repeats

FOLDER = "/root/testdata/sf0.001"
MARK = "[SECRET]"


def redact(text):
    """Base secrets replaced; the tables hold none of the other kinds."""
    spans = [m.span() for m in scans.ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [m.span() for m in re.finditer("AKIA[A-Z0-9]{12,}", text)]
    spans += [m.span() for m in re.finditer("[0-9a-f]{32,}", text)]
    out, since = [], 0
    merged = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    for a, b in merged:
        out += [text[since:a], MARK]
        since = b
    return "".join([*out, text[since:]])


def plain(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The result of each stage, from the given documents and some of our own."""
    docs = table(spark, FOLDER, "documents")
    own = [
        (90_001, "12345 $$$ 678", "en", "x", 13),
        (90_002, None, None, None, None),
        (90_003, "", "en", "x", 0),
        (None, "the theory of the thing and that other one", "en", "x", 9),
        (90_004, "the and of that ndthe password=abcdefgh99 the thing", "en", "x", 9),
        (90_004, "the and of that ndthe password=abcdefgh99 the thing", "en", "x", 9),
    ]
    docs = docs.unionByName(spark.createDataFrame(own, docs.schema))
    folder = tmp_path_factory.mktemp("pipeline")
    docs.write.parquet(f"{folder}/0")
    found = [spark.read.parquet(f"{folder}/0")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
        stage(spark, found[-1], FOLDER).write.parquet(f"{folder}/{i}")
        found.append(spark.read.parquet(f"{folder}/{i}"))
    return found


def test_columns(steps):
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes


def test_language(steps):
    before, after = plain(steps[0]), plain(steps[1])
    gone = [x for x in before if x not in after]
    assert {i for i, _ in gone} == {90_001, 90_002, 90_003}


def test_near_duplicates(steps):
    before, after = plain(steps[1]), plain(steps[2])
    groups = joins.brute(before, 5, 80)
    stay = {i for i, _, component in groups if i == component}
    assert after == sorted({x for x in before if x[0] in stay or x[0] is None}, key=repr)


def test_rows_are_told_apart_by_id_and_text(spark):
    """Different texts of one id both stay, copies without id leave one, names may clash."""
    names = "doc_id long, text string, lang string, source string, n_chars long, first int, "
    names += "__id int, n_words int, n_removed int, key string, row int, own int, number int"
    texts = ["the first text of its own kind here", "another document with other words in it"]
    texts += ["nobody knows the number of this text", "unique words in one more document"]
    rows = [(5, texts[0]), (5, texts[1]), (None, texts[2]), (None, texts[2]), (None, texts[3])]
    rows += [(9, texts[2]), (9, texts[2]), (5, texts[0] + "\n"), (12, None), (None, None), (12, None)]
    given = [(i, t, "en", "s", 3, 1, 2, 3, 4, "k", 5, 6, 7) for i, t in rows]
    docs = spark.createDataFrame(given, names)
    found = corpus_pipeline.ngram_dedup(spark, docs, FOLDER)
    assert found.dtypes == docs.dtypes
    left = sorted(((r.doc_id, (r.text or "").strip()) for r in found.collect()), key=repr)
    assert left == sorted(
        [(5, texts[0]), (5, texts[1]), (9, texts[2]), (None, texts[3]), (12, ""), (None, "")], key=repr
    )
    assert all(r[4:] == (3, 1, 2, 3, 4, "k", 5, 6, 7) for r in found.collect())
    for stage in (corpus_pipeline.language_id, corpus_pipeline.substring_dedup, corpus_pipeline.secret_scan):
        assert stage(spark, docs, FOLDER).dtypes == docs.dtypes
    assert corpus_pipeline.substring_dedup(spark, docs, FOLDER).count() == len(rows)
    assert corpus_pipeline.secret_scan(spark, docs, FOLDER).count() == len(rows)
    assert corpus_pipeline.pack(spark, docs, FOLDER).count() == len(rows)


def test_substrings(steps):
    texts = dict(plain(steps[2]))
    expected = [
        (i, kept if removed else texts[i])
        for i, _, removed, kept in repeats.brute(plain(steps[2]), 20)
    ]
    assert plain(steps[3]) == sorted(expected, key=repr)
    assert all(r.n_chars == len(r.text) for r in steps[3].collect())


def test_secrets_are_marked(steps):
    before, after = plain(steps[3]), plain(steps[4])
    assert after == sorted(((i, redact(t)) for i, t in before), key=repr)
    assert before != after


def test_packed(steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))

    def ids(text):
        return tokenizer.encode(text or "", add_special_tokens=False).ids

    made, least = packing.check(steps[5].collect(), plain(steps[4]), ids, 2048)
    assert made <= least + 1


def test_run_and_empty_tables(spark, tmp_path):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.select("doc_id").distinct().count() > 150
    docs = table(spark, FOLDER, "documents").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
