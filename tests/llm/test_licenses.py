from __future__ import annotations

import itertools
import random
import re

import pytest

from agorameter.llm import queries
from agorameter.llm.common import table
from agorameter.llm.licenses import BASE, LICENSES, PASSAGES, RULES, Detection, detect, resolve, scan, summary

FOLDER = "/root/testdata/sf0.01"


def brute(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    places = [
        (i, label)
        for phrase, label in BASE.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [p for p, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), labels)


def check(rows, texts):
    got = sorted(
        ((r.doc_id, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in rows),
        key=repr,
    )
    assert got == sorted(((i, brute(t)) for i, t in texts), key=repr)
    for r in rows:
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert r.labels.split(",") == sorted(set(r.labels.split(",")))


def test_whole_table(spark):
    rows = queries.op10_license_scan(spark, FOLDER).collect()
    check(rows, [tuple(r) for r in table(spark, FOLDER, "documents").select("doc_id", "text").collect()])
    assert sum(r.n_base for r in rows) > 5


def test_edge_cases(spark):
    chance = random.Random(3)
    parts = ["mit", "License", "apache", "GENERAL", "public", "license", "é", "7", "\x00", "字"]
    texts = [" ".join(chance.choices(parts, k=60)) for _ in range(30)]
    texts += ["".join(chance.choice(parts) + chance.choice(" -_.\n\x7f") for _ in range(80)) for _ in range(30)]
    texts += [None, "", "mit license mit license", "mitlicense", "x " * 300_000 + "MIT-License"]
    rows = [(i, t, "a", 0) for i, t in enumerate(texts)] + [(0, texts[0], "a", 0), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string, key int")
    check(summary(scan(df)).collect(), [r[:2] for r in rows])
    assert scan(df.limit(0)).collect() == []


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("SPDX-License-Identifier: Apache-2.0", ["apache"]),
        ("Released under the GNU General Public License, v3", ["gpl"]),
        ("under the GNU Lesser General Public License", ["lgpl"]),
        ("GNU Affero General Public License", ["agpl"]),
        ("Licensed under the terms of the Mozilla Public License", ["mpl"]),
        ("the 3-clause BSD License", ["bsd"]),
        ("This is in the public domain.", ["public-domain"]),
        ("All rights reserved", ["proprietary"]),
        ("permission is hereby granted,\nfree of charge, to any person obtaining a copy", ["mit"]),
        ("admit licenses", []),
        ("a vim editor, available", []),
    ],
)
def test_labels(text, labels):
    assert [d.label for d in detect(text)] == labels


def test_resolution():
    inner, outer = Detection(5, 8, 5, "a", 0.5), Detection(0, 9, 5, "b", 0.5)
    assert resolve([inner, outer]) == [outer]
    assert resolve([inner._replace(priority=1), outer]) == [inner._replace(priority=1)]
    apart = Detection(9, 12, 7, "c", 0.5)
    assert resolve([apart, inner, outer]) == [outer, apart]
    assert resolve([Detection(7, 12, 5, "c", 0.5), inner]) == [Detection(7, 12, 5, "c", 0.5)]


def test_every_match_holds_its_keyword():
    assert len(RULES) > 250
    for rule in RULES:
        for gate in (rule.keyword,):
            assert gate == gate.lower()


def spelled(parsed):
    """Texts that a wording stands for: optional parts left out and once, all branches."""
    ways = []
    for kind, what in parsed:
        name = str(kind)
        if name == "LITERAL":
            ways.append([chr(what)])
        elif name == "IN":
            first, value = what[0]
            ways.append([" " if str(first) == "CATEGORY" else chr(value[0] if str(first) == "RANGE" else value)])
        elif name == "MAX_REPEAT":
            least, most, inner = what
            ways.append(sorted({w * k for w in spelled(inner) for k in {least, min(int(most), least + 1)}}))
        elif name == "SUBPATTERN":
            ways.append(spelled(what[3]))
        else:
            assert name == "BRANCH"
            ways.append([w for branch in what[1] for w in spelled(branch)])
    return ["".join(w) for w in itertools.product(*ways)]


@pytest.mark.parametrize("blank", [" ", "\n", "  \t"])
def test_variants_of_names_and_passages_pass_their_gates(blank):
    for label, _, name in LICENSES:
        for variant in spelled(re._parser.parse(name)):
            text = f"under the {variant} license".replace(" ", blank)
            own = [r for r in RULES if r.label == label and r.keyword in text]
            assert any(r.pattern.search(text) for r in own), text
            assert detect(text), text
    for label, _, _, _, wording in PASSAGES:
        for variant in spelled(re._parser.parse(wording)):
            assert label in [d.label for d in detect(variant.replace(" ", blank))], variant


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("Microsoft Reciprocal License", "mspl"),
        ("GNU Lesser General\nPublic License", "lgpl"),
        ("Mozilla\nPublic License", "mpl"),
        ("Open Data Commons Database License", "odbl"),
        ("Permission is\nhereby granted, free of charge, to any person obtaining a copy", "mit"),
    ],
)
def test_wrapped_names(text, label):
    assert [d.label for d in detect(text)] == [label]
