from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from agorameter.operators import collect
from agorameter.plans import links
from tests.conftest import plan_of


def tiles(spark, *ranges):
    df = spark.createDataFrame(list(ranges), "lo timestamp, hi timestamp")
    return collect.date_tiles(df, "lo", "hi").orderBy("lo", "tile_no").collect()


def test_short_last_tile(spark):
    rows = tiles(spark, (datetime(2024, 9, 1), datetime(2025, 1, 20)))
    assert len(rows) == 15
    assert rows[-1].tile_end - rows[-1].tile_start == timedelta(days=1)


def test_exact_multiple_has_no_empty_tile(spark):
    rows = tiles(spark, (datetime(2024, 9, 1), datetime(2024, 9, 21)))
    assert [(r.tile_no, r.tile_start.day, r.tile_end.day) for r in rows] == [(0, 1, 11), (1, 11, 21)]


def test_empty_ranges_have_no_tile(spark):
    day = datetime(2024, 9, 1)
    assert tiles(spark, (day, day), (day, day - timedelta(days=3)), (None, day)) == []


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.integers(1, 400), min_size=1, max_size=8, unique=True))
def test_tiles_cover_the_range(spark, lengths):
    start = datetime(2024, 2, 27, 13)
    rows = tiles(spark, *[(start, start + timedelta(hours=h)) for h in lengths])
    by_end = {}
    for row in rows:
        by_end.setdefault(row.hi, []).append((row.tile_start, row.tile_end))
    for hours in lengths:
        end = start + timedelta(hours=hours)
        found = sorted(by_end[end])
        assert found[0][0] == start and found[-1][1] == end
        assert all(a[1] == b[0] for a, b in zip(found, found[1:]))
        assert all(a[1] - a[0] == timedelta(days=10) for a in found[:-1])


def test_tile_number_agrees_with_the_tiles(spark):
    start = datetime(2024, 9, 1)
    times = [start + timedelta(hours=7 * i) for i in range(120)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp")
    rows = df.select("t", collect.tile_number(F.col("t"), F.lit(start)).alias("n")).collect()
    assert [r.n for r in rows] == [(r.t - start) // timedelta(days=10) for r in rows]


def test_keyword_search(texts):
    values = [
        "Kamala HARRIS", "trumpet", "elections!", "none", None, "", "re-election", "c++ code", "ÉTAT",
    ]
    df = texts(values)
    assert {r.text for r in collect.keyword_search(df, "text").collect()} == set(values[:3])
    assert {r.text for r in collect.keyword_search(df, "text", " C++ |état|").collect()} == {
        "c++ code", "ÉTAT",
    }
    with pytest.raises(ValueError):
        collect.keyword_search(df, "text", " | ")


def test_published_between_is_half_open(spark):
    df = spark.createDataFrame([(i,) for i in range(6)], "t int")
    parts = [collect.published_between(df, "t", a, a + 2) for a in (0, 2, 4)]
    assert sorted(r.t for p in parts for r in p.collect()) == list(range(6))


def test_of_type(spark):
    df = spark.createDataFrame(
        [("video", "a"), ("playlist", "a"), ("video", "b")], "type string, channel_id string"
    )
    assert collect.of_type(df).count() == 2
    assert collect.of_type(df, channel="b").count() == 1


def test_first_seen(spark):
    urls = ["a", "b", "a", "c", "b", "a"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "n long, url string")
    found = collect.first_seen(df.repartition(3), "url", "n")
    assert {(r.url, r.n) for r in found.collect()} == {("a", 0), ("b", 1), ("c", 3)}


def comment_rows():
    rng = random.Random(3)
    # One video holds a third of all comments.
    ids = ["hot" if i % 3 == 0 else f"v{i % 50}" for i in range(3000)]
    return [(v, f"c{i:04}", rng.randrange(40)) for i, v in enumerate(ids)]


def best(rows, k):
    groups = {}
    for video, comment, votes in rows:
        groups.setdefault(video, []).append((-votes, comment))
    return {
        (video, comment, i + 1)
        for video, comments in groups.items()
        for i, (_, comment) in enumerate(sorted(comments)[:k])
    }


@pytest.mark.parametrize("k", [1, 5, 30])
def test_most_popular(spark, k):
    rows = comment_rows()
    df = spark.createDataFrame(rows, "video string, id string, votes int").repartition(6)
    top = collect.most_popular(df, k, "video", "votes", "id")
    assert plan_of(top).count("WindowGroupLimit") == 4, "groups are cut before each shuffle"
    assert {(r.video, r.id, r.popularity) for r in top.collect()} == best(rows, k)


def test_orders(spark):
    rows = comment_rows()
    df = spark.createDataFrame(rows, "video string, id string, votes int").repartition(6)
    popular = [tuple(r) for r in collect.popular_first(df, "video", "votes", "id").collect()]
    assert popular == sorted(rows, key=lambda r: (r[0], -r[2], r[1]))
    newest = [tuple(r) for r in collect.newest_first(df, "votes", "id").collect()]
    assert newest == sorted(rows, key=lambda r: (-r[2], r[1]))
    assert "rangepartitioning(video" in plan_of(collect.popular_first(df, "video", "votes", "id"))


def test_video_links(spark):
    items = spark.sql(
        """SELECT * FROM VALUES
             ('video', 'abc', 'a', 'Harris speaks', timestamp '2024-09-02 00:00:00'),
             ('video', 'abc', 'b', 'the ELECTIONS', timestamp '2024-09-05 00:00:00'),
             ('video', 'abc', 'c', 'trump', timestamp '2024-09-12 00:00:00'),
             ('video', 'abc', 'a', 'Harris speaks', timestamp '2024-09-13 00:00:00'),
             ('video', 'abc', 'd', 'weather', timestamp '2024-09-02 00:00:00'),
             ('video', 'fox', 'e', 'trump', timestamp '2024-09-02 00:00:00'),
             ('playlist', 'abc', 'f', 'trump', timestamp '2024-09-02 00:00:00'),
             ('video', 'abc', 'g', 'trump', timestamp '2024-09-21 00:00:00')
           AS t(type, channel_id, video_id, title, published)"""
    )
    rows = links.video_links(items, "2024-09-01", "2024-09-21", channel="abc").collect()
    assert [(r.tile_no, r.url[-1]) for r in rows] == [(0, "b"), (0, "a"), (1, "c")]
