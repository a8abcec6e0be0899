"""License scan by ordered signature rules.

Rules are regular expressions made from a table of licenses and a table of phrasings, and some
written out. A rule runs only on texts that hold its keyword. Overlapping detections are
resolved in order: one that lies within another of the same or a higher priority goes, and of
two that partly overlap the one of the lower priority goes, or else the later one.

The base phrases are found by words: runs of letters, digits and non-ASCII characters.

Nulls and edge cases: a null text counts as empty; a text without a detection has no labels
and score 0; rows that repeat an id are scanned one by one; an empty table gives no row; extra
columns are not read; texts of any length are scanned whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorameter.llm.common import prepare

#: Phrases of the base scan and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Label, word that every match holds, and how the license is named; a blank stands for any white space.
LICENSES = (
    ("agpl", "affero", r"(?:gnu )?affero general public"),
    ("agpl", "agpl", r"(?:gnu )?agpl[ -]?(?:v|version )?[0-9.]*"),
    ("apache", "apache", r"apache(?: software)?(?:,? (?:v|version )?[12](?:\.[01])?)?"),
    ("apsl", "apple", r"apple public(?: source)?"),
    ("artistic", "artistic", r"(?:perl )?artistic(?: [12](?:\.0)?)?"),
    ("blueoak", "oak", r"blue oak(?: model)?"),
    ("bsd", "bsd", r"(?:(?:the )?(?:new|simplified|modified|revised|[0-4][ -]clause) )?bsd(?:[ -][0-4][ -]clause)?"),
    ("bsl", "boost", r"boost software"),
    ("busl", "business", r"business source"),
    ("cc0", "cc0", r"(?:creative commons )?cc0(?: 1\.0)?(?: universal)?"),
    ("cc", "commons", r"creative commons(?: attribution)?(?:[ -](?:sharealike|noncommercial|noderivs))*"),
    ("cc", "cc-by", r"cc-by(?:-(?:sa|nc|nd))*(?:[- ][1-4]\.0)?"),
    ("cddl", "development", r"common development and distribution"),
    ("cddl", "cddl", r"cddl(?:[ -]1\.[01])?"),
    ("cecill", "cecill", r"cecill(?:-[abc])?"),
    ("cpl", "common", r"common public"),
    ("ecl", "educational", r"educational community"),
    ("epl", "eclipse", r"eclipse(?: public)?"),
    ("eupl", "european", r"european union public"),
    ("eupl", "eupl", r"eupl"),
    ("fdl", "documentation", r"(?:gnu )?free documentation"),
    ("ftl", "freetype", r"freetype(?: project)?"),
    ("gpl", "gpl", r"(?:gnu )?gpl[ -]?(?:v|version )?[23]?(?:\.0)?"),
    ("gpl", "general", r"(?:gnu )?general public"),
    ("hpnd", "historical", r"historical permission notice"),
    ("ijg", "jpeg", r"independent jpeg group"),
    ("ipl", "ibm", r"ibm public"),
    ("isc", "isc", r"isc"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl[ -]?(?:v|version )?[23]?(?:\.[01])?"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public"),
    ("lgpl", "library", r"(?:gnu )?library general public"),
    ("lppl", "latex", r"latex project public"),
    ("mit", "mit", r"(?:mit(?:[/ ]x11)?|mit \(expat\))"),
    ("mit", "expat", r"expat"),
    ("mit", "x11", r"x11"),
    ("mpl", "mozilla", r"mozilla(?: public)?"),
    ("mpl", "mpl", r"mpl[ -]?(?:v|version )?[12](?:\.[01])?"),
    ("mspl", "microsoft", r"microsoft (?:public|reciprocal)"),
    ("ncsa", "ncsa", r"(?:university of illinois/)?ncsa(?: open source)?"),
    ("odbl", "database", r"open (?:data commons )?(?:open )?database"),
    ("ofl", "font", r"(?:sil )?open font"),
    ("openssl", "openssl", r"openssl"),
    ("osl", "software", r"open software"),
    ("php", "php", r"php"),
    ("postgresql", "postgresql", r"postgresql"),
    ("psf", "python", r"python software foundation"),
    ("qpl", "public", r"q public"),
    ("ruby", "ruby", r"ruby"),
    ("sspl", "server", r"server side public"),
    ("unicode", "unicode", r"unicode(?: terms| data files)?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("upl", "permissive", r"universal permissive"),
    ("vim", "vim", r"vim"),
    ("w3c", "w3c", r"w3c(?: software)?"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("zlib", "zlib", r"zlib(?:/libpng)?"),
    ("zpl", "zope", r"zope public"),
)
#: Priority, confidence and wording; ``{}`` is the name of a license.
PHRASINGS = (
    (1, 0.95, r"spdx-license-identifier:\s*\(?{}(?:[-+.\w]*)"),
    (2, 0.9, r"(?:licen[sc]ed|released|distributed|published|available|provided|covered|redistributed)\s+(?:under|by)\s+(?:(?:the\s+)?(?:terms|conditions)\s+(?:and\s+conditions\s+)?of\s+)?(?:the\s+|an?\s+)?{}(?:\s+public)?(?:\s+licen[sc]e)?"),
    (3, 0.85, r"(?:see|read|under|subject\s+to|governed\s+by|according\s+to|terms\s+of)\s+(?:the\s+|an?\s+)?{}(?:\s+public)?\s+licen[sc]e"),
    (4, 0.8, r"licen[sc]e\s*[:=]\s*[\"']?{}\b"),
    (5, 0.7, r"\b{}(?:\s+public)?\s+licen[sc]e"),
)
#: Label, word, priority, confidence and wording of passages of license texts and notices; blanks as above.
PASSAGES = (
    ("mit", "hereby", 1, 0.95, r"permission is hereby granted,\s+free of charge,\s+to any person\s+obtaining a copy"),
    ("isc", "permission", 1, 0.9, r"permission to use, copy, modify,?\s+and(?:/or)?\s+distribute this\s+software"),
    ("bsd", "redistribution", 1, 0.95, r"redistribution and use in source and binary\s+forms"),
    ("gpl", "redistribute", 1, 0.85, r"this (?:program|library) is free software[;:,]\s+you can redistribute it"),
    ("mpl", "subject", 1, 0.95, r"this source code form is subject to the terms"),
    ("unlicense", "unencumbered", 1, 0.95, r"free and unencumbered software released into the\s+public domain"),
    ("zlib", "altered", 1, 0.9, r"altered source versions must be plainly marked"),
    ("public-domain", "domain", 3, 0.8, r"(?:released|dedicated|placed|is)\s+(?:in|to|into)\s+the\s+public domain"),
    ("proprietary", "reserved", 6, 0.5, r"all rights reserved"),
    ("proprietary", "proprietary", 4, 0.7, r"proprietary and confidential|confidential and proprietary"),
    ("copyright", "copyright", 7, 0.3, r"copyright\s+(?:\(c\)|©|[12][0-9]{3})"),
)


class Rule(NamedTuple):
    label: str
    keyword: str
    priority: int
    confidence: float
    pattern: re.Pattern


def _spaced(wording: str) -> str:
    """The wording with white space of any kind and length for each blank."""
    wording = re.sub(r"\[[^]]* [^]]*\]", lambda m: f"(?: |{m[0].replace(' ', '')})", wording)
    return wording.replace(" ", r"\s+")


def _rules() -> tuple[Rule, ...]:
    made = [
        Rule(label, keyword, priority, confidence, re.compile(wording.replace("{}", _spaced(name))))
        for priority, confidence, wording in PHRASINGS
        for label, keyword, name in LICENSES
    ]
    made += [Rule(*passage[:4], re.compile(_spaced(passage[4]))) for passage in PASSAGES]
    return tuple(sorted(made, key=lambda r: r.priority))


RULES = _rules()
#: Every phrasing holds one of these, so a text without them runs no rule.
GATES = ("licen", "released", "distributed", "published", "available", "provided", "covered", "spdx")
PASSAGE_GATES = tuple(sorted({p[1] for p in PASSAGES}))
KEYWORDS = tuple(sorted({rule.keyword for rule in RULES}))


class Detection(NamedTuple):
    start: int
    end: int
    priority: int
    label: str
    confidence: float


def _lower(text: str) -> str:
    """A-Z to a-z; positions stay."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def detect(text: str) -> list[Detection]:
    """The detections that are left, by start."""
    body = _lower(text)
    if not any(g in body for g in GATES) and not any(g in body for g in PASSAGE_GATES):
        return []
    present = {keyword for keyword in KEYWORDS if keyword in body}
    found = [
        Detection(m.start(), m.end(), rule.priority, rule.label, rule.confidence)
        for rule in RULES
        if rule.keyword in present
        for m in rule.pattern.finditer(body)
    ]
    return resolve(found)


def resolve(found: list[Detection]) -> list[Detection]:
    """Detections without those that another one suppresses; the kept ones don't overlap."""
    kept: list[Detection] = []  # sorted; none overlaps the next
    # Longer ones first within a priority: what lies inside them is suppressed.
    for d in sorted(found, key=lambda d: (d.priority, d.start - d.end, d.start, d.label)):
        i = bisect_left(kept, (d.start,))
        clear = i == 0 or kept[i - 1].end <= d.start
        if clear and (i == len(kept) or d.end <= kept[i].start):
            kept.insert(i, d)
    return kept


#: Lower case of A-Z; everything below 128 that is no letter or digit to a space.
WORDS = bytes(
    (b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def base_phrases(text: str) -> tuple[int, list[tuple[int, str]]]:
    """The number of words, and the first word and label of each place of a phrase."""
    words = text.encode("utf-8", "surrogatepass").translate(WORDS).split(b" ")
    words = [w for w in words if w]
    line = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in BASE.items():
        wanted = f" {phrase} ".encode()
        at, place, counted = line.find(wanted), 0, 0
        while at >= 0:
            place += line.count(b" ", counted, at)
            counted = at
            found.append((place, label))
            at = line.find(wanted, at + 1)
    return len(words), sorted(found)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its words, base phrases, and the ``detections`` of the rules."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    shape = (
        "array<struct<start: bigint, end: bigint, priority: int, label: string, confidence: double>>"
    )
    detection = pa.struct(
        [
            ("start", pa.int64()),
            ("end", pa.int64()),
            ("priority", pa.int32()),
            ("label", pa.string()),
            ("confidence", pa.float64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, places, labels, detections = [], [], [], []
            for body in batch.column(1).to_pylist():
                n, found = base_phrases(body or "")
                words.append(n)
                places.append([p for p, _ in found])
                labels.append(sorted({label for _, label in found}))
                detections.append([d._asdict() for d in detect(body or "")])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(words, pa.int64()),
                    pa.array(places, pa.list_(pa.int64())),
                    pa.array(labels, pa.list_(pa.string())),
                    pa.array(detections, pa.list_(detection)),
                ],
                names=("key", "n_words", "places", "base", "detections"),
            )

    schema = f"key {kind}, n_words long, places array<long>, base array<string>, detections {shape}"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def summary(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts, labels and a score: the chance that some detection is right."""
    both = F.array_union("base", F.transform("detections", lambda d: d["label"]))
    wrong = F.aggregate("detections", F.lit(1.0), lambda p, d: p * (1 - d["confidence"]))
    base = F.when(F.size("places") > 0, 0.1).otherwise(1.0)
    return scanned.select(
        key,
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(both)), ",").alias("labels"),
        (1 - wrong * base).alias("score"),
    )
