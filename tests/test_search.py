from __future__ import annotations

import datetime as dt
import random

import pyarrow as pa
import pytest

from agorameter.operators import history, search
from tests.conftest import plan_of


def brute_hits(text, keywords):
    low, found = search.lowered(text or ""), []
    chosen = {}
    for k in sorted(set(keywords)):
        chosen.setdefault(search.lowered(k), k)
    for word, name in chosen.items():
        start = low.find(word) if word else -1
        while start >= 0:
            found.append((name, start, start + len(word)))
            start = low.find(word, start + 1)
    return sorted(found)


def test_hits_against_single_searches(spark):
    """Two thousand keywords that overlap and hold each other, in any case."""
    chance = random.Random(2)

    def some(n):
        return "".join(chance.choice("abÄé c") for _ in range(n))

    keywords = [some(chance.randint(1, 6)) for _ in range(2500)] + ["A", "a", "ab", "AB", "abab", "İx"]
    texts = [some(chance.randint(0, 80)) for _ in range(120)] + ["İxİX", "", None, "ababab", "A" * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    found = {}
    for row in search.keyword_hits(df, "text", keywords, ["id"]).collect():
        found.setdefault(row.id, []).append((row.keyword, row.start, row.end))
    for i, text in enumerate(texts):
        assert sorted(found.get(i, [])) == brute_hits(text, keywords)


def test_keywords_are_bounded(spark, monkeypatch):
    df = spark.createDataFrame([("x",)], "text string")
    with pytest.raises(ValueError):
        search.keyword_hits(df, "text", ["", ""])
    monkeypatch.setattr(search, "MOST_KEYWORDS", 1)
    with pytest.raises(ValueError, match="too many"):
        search.keyword_hits(df, "text", ["a", "b"])


def test_hits_are_handed_on_in_pieces(spark, monkeypatch):
    """A worker holds the hits of a few texts, not those of a whole batch."""
    df, taken = spark.createDataFrame([("x", 1)], "text string, id int"), []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: taken.append(run) or self)
    monkeypatch.setattr(search, "HELD_HITS", 50)
    search.keyword_hits(df, "text", ["ab"], ["id"])
    batch = pa.RecordBatch.from_pydict({"__text": ["ab " * 10, None] * 50, "id": list(range(100))})
    pieces = list(taken[0](iter([batch])))
    assert max(x.num_rows for x in pieces) < 60
    found = pa.Table.from_batches(pieces)
    assert found["id"].to_pylist() == [i for i in range(0, 100, 2) for _ in range(10)]
    assert found["start"].to_pylist() == [0, 3, 6, 9, 12, 15, 18, 21, 24, 27] * 50


def test_tiles_against_all_ranges(spark):
    chance, start = random.Random(4), dt.datetime(2024, 9, 1)

    def moment():
        exact = chance.random() < 0.4
        return start + dt.timedelta(days=chance.randint(-3, 60), seconds=0 if exact else chance.randint(0, 86_399))

    searches = [(f"c{chance.randint(0, 5)}", *sorted((moment(), moment()))) for _ in range(25)]
    searches += [("c1", start, start), ("c2", start, None), (None, start, start + dt.timedelta(days=9))]
    items = [(f"c{chance.randint(0, 6)}", i, moment()) for i in range(400)] + [(None, 900, start), ("c1", 901, None)]
    one = spark.createDataFrame(searches, "channel string, start timestamp, end timestamp")
    two = spark.createDataFrame(items, "channel string, id int, published timestamp")
    placed = search.assign_tiles(two, one)
    expected = []
    for channel, lo, hi in searches:
        n = 0
        while hi and channel and lo + dt.timedelta(days=10 * n) < hi:
            a = lo + dt.timedelta(days=10 * n)
            b = min(a + dt.timedelta(days=10), hi)
            expected += [(i, n, a, b) for c, i, t in items if c == channel and t and a <= t < b]
            n += 1
    rows = [(r.id, r.tile_no, r.tile_start, r.tile_end) for r in placed.collect()]
    assert sorted(rows) == sorted(expected)
    plan = plan_of(placed)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_links_of_many_channels(spark):
    day = dt.datetime(2024, 9, 1)
    items = [
        ("video", "a", "v1", "Election now", day), ("video", "b", "v1", "ELECTION", day),
        ("video", "a", "v2", "weather", day), ("channel", "a", "v3", "election", day),
        ("video", "a", "v4", "vote", day + dt.timedelta(days=15)), ("video", "b", "v5", "vote", day - dt.timedelta(days=1)),
        ("video", "a", "v1", "Election now", day),
    ]
    df = spark.createDataFrame(items, "type string, channel_id string, video_id string, title string, published timestamp")
    ranges = [("a", day, day + dt.timedelta(days=20)), ("b", day, day + dt.timedelta(days=5))]
    searches = spark.createDataFrame(ranges, "channel_id string, start timestamp, end timestamp")
    found = search.channel_links(df, searches, ["election", "vote"]).collect()
    assert sorted((r.channel_id, r.url[-2:], r.tile_no) for r in found) == [
        ("a", "v1", 0), ("a", "v4", 1), ("b", "v1", 0),
    ]


def test_new_links_are_exact_and_few_known_ones_move(spark):
    links = spark.range(0, 3000, 3).selectExpr("concat('u', id) AS url")
    links = links.unionByName(links.limit(50)).unionByName(spark.createDataFrame([(None,)], "url string"))
    known = spark.range(1500, 200_000).selectExpr("concat('u', id) AS url")
    found = history.new_links(links, known, bits=1 << 16)
    assert sorted(r.url for r in found.collect()) == sorted(f"u{i}" for i in range(0, 1500, 3))
    words = history.bloom(links.where("url IS NOT NULL"), "url", 1 << 16)
    moved = history.possibly_in(known, "url", words, 1 << 16).count()
    share = history.false_share(1000, 1 << 16)
    assert 500 <= moved <= 500 + 198_500 * share * 3 + 10
    # A full filter lets all through, and the result is the same.
    again = history.new_links(links, known, bits=64)
    assert sorted(r.url for r in again.collect()) == sorted(r.url for r in found.collect())
