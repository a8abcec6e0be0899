from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from agorameter.plans import enrich, reports
from agorameter.schemas import DATASETS, POST_COMMENTS, POSTS, VIDEO_COMMENTS, VIDEOS
from tests.conftest import plan_of

SCORES = (
    "sentiment_label string, negative float, neutral float, positive float, emotion_label string"
)


def scored_posts(spark, n=400):
    """A third of the posts belong to one candidate."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        weights = [rng.random() for _ in range(3)]
        means = [w / sum(weights) for w in weights]
        label = ("negative", "neutral", "positive")[means.index(max(means))]
        candidate = "hot" if i % 3 == 0 else f"c{i % 7}"
        day = rng.randrange(1, 9)
        rows.append(
            (f"p{i}", f"2024-09-{day:02}T10:00:00", candidate, rng.choice([None, i % 5]), label,
             *means, rng.choice(["joy", "fear", "null"]))
        )
    others = ", ".join(f"{r} int" for r in ("love", "care", "haha", "wow", "angry", "sad"))
    df = spark.createDataFrame(
        [(*r[:4], 1, 0, 0, 0, 0, None, *r[4:]) for r in rows],
        f"uuid string, timestamp string, candidate string, like int, {others}, {SCORES}",
    )
    return rows, df


def test_records_over_time(spark, texts):
    df = texts(["2024-09-01T10:00:00", "2024-09-01T23:59:59", "2024-09-02T00:00:00", "?", None])
    rows = reports.records_over_time(df, "text").collect()
    found = {None if r.bucket is None else r.bucket.day: r.records for r in rows}
    assert found == {1: 2, 2: 1, None: 2}
    hours = reports.records_over_time(df, "text", "hour").collect()
    assert len(hours) == 4


def test_sentiment_trend(spark):
    rows, df = scored_posts(spark)
    groups = defaultdict(list)
    for row in rows:
        groups[int(row[1][8:10]), row[2]].append(row)
    found = reports.sentiment_trend(df.repartition(5), ["candidate"]).collect()
    assert len(found) == len(groups)
    for line in found:
        members = groups[line.bucket.day, line.candidate]
        assert line.records == len(members)
        assert line.mean_negative == pytest.approx(sum(m[5] for m in members) / len(members), abs=1e-6)
        counts = Counter(m[4] for m in members)
        assert line.positive_records == counts["positive"]
        assert line.neutral_records == counts["neutral"]


def test_shares(spark):
    rows, df = scored_posts(spark)
    totals, counts = Counter(r[2] for r in rows), Counter((r[2], r[8]) for r in rows)
    found = reports.emotion_share(df, "candidate").collect()
    assert {(r.candidate, r.emotion_label): r.records for r in found} == counts
    for line in found:
        assert line.share == pytest.approx(line.records / totals[line.candidate])


def test_post_engagement(spark):
    rows, df = scored_posts(spark)
    for line in reports.post_engagement(df).collect():
        members = [r for r in rows if r[4] == line.sentiment_label]
        likes = sum(m[3] or 0 for m in members)
        assert (line.records, line.sum_like, line.sum_love) == (len(members), likes, len(members))
        assert line.reactions == likes + len(members)
        assert line.mean_reactions == pytest.approx(line.reactions / len(members))


def test_video_and_comment_engagement(spark):
    df = spark.createDataFrame(
        [("positive", 10, 1, 2, 5), ("positive", 20, 3, 4, 7)],
        "sentiment_label string, views int, video_likes int, comments int, comment_votes int",
    )
    videos = reports.video_engagement(df).first()
    assert (videos.sum_views, videos.mean_views, videos.sum_comments) == (30, 15.0, 6)
    comments = reports.comment_engagement(df).first()
    assert (comments.records, comments.sum_votes, comments.mean_votes) == (2, 12, 6.0)


def test_bias_breakdown(spark):
    rows, df = scored_posts(spark)
    df = df.selectExpr("*", "candidate AS channel", "substring(candidate, 1, 1) AS channel_bias")
    found = {(r.level, r.channel_bias, r.channel): r for r in reports.bias_breakdown(df).collect()}
    assert found[3, None, None].records == len(rows)
    assert found[1, "h", None].records == found[0, "h", "hot"].records
    cs = [r for r in rows if r[2] != "hot"]
    assert found[1, "c", None].records == len(cs)
    assert found[1, "c", None].mean_positive == pytest.approx(sum(r[7] for r in cs) / len(cs), abs=1e-6)
    plan = plan_of(reports.bias_breakdown(df))
    expand = plan.index("Expand")
    assert "HashAggregate" in plan[expand:], "groups are aggregated before they are multiplied"


def test_latest_snapshot(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 == 0 else f"u{i % 40}", f"2024-09-{rng.randrange(1, 29):02}", i)
            for i in range(900)]
    df = spark.createDataFrame(rows, "uuid string, retrieving_time string, n int").repartition(5)
    latest = reports.latest_snapshot(df)
    assert plan_of(latest).count("WindowGroupLimit") == 2
    wanted = {}
    for uuid, time, n in rows:
        if uuid not in wanted or (time, -n) > (wanted[uuid][0], -wanted[uuid][1]):
            wanted[uuid] = (time, n)
    assert {r.uuid: (r.retrieving_time, r.n) for r in latest.collect()} == wanted


def test_comment_mood_and_orphans(spark):
    parents = spark.createDataFrame([("p1",), ("p2",)], "uuid string")
    comments = spark.createDataFrame(
        [("p1", 0.2, 0.2, 0.6), ("p1", 0.4, 0.2, 0.4), ("lost", 1.0, 0.0, 0.0)],
        "post_id string, negative float, neutral float, positive float",
    )
    mood = {r.uuid: r for r in reports.comment_mood(parents, comments).collect()}
    assert (mood["p1"].comment_records, mood["p2"].comment_records) == (2, 0)
    assert mood["p1"].comment_negative == pytest.approx(0.3)
    assert mood["p2"].comment_negative is None
    orphans = reports.orphan_comments(parents, comments).collect()
    assert [(r.post_id, r.comment_records) for r in orphans] == [("lost", 1)]


def test_cross_media(spark, messages):
    values = {
        "fb_posts": '{"uuid":"p","timestamp":"2024-09-01T00:00:00","candidate":"a","content":"good","like":2,"sad":1}',
        "fb_comments": '{"uuid":"c","post_id":"p","candidate":"a","content":"bad","love":4}',
        "yt_videos": '{"id_video":"v","channel":"ABC","fullText":"x","video_likes":9,"video_timestamp":"2024-09-02T00:00:00"}',
        "yt_comments": '{"id_video":"v","channel":"ABC","comment_cid":"k","comment_text":"y","comment_votes":3}',
    }
    parts = [enrich.enrich(messages([v]), DATASETS[name]) for name, v in values.items()]
    rows = {r.dataset: r for r in reports.cross_media(*parts).collect()}
    assert [rows[n].engagement for n in values] == [3, 4, 9, 3]
    assert [rows[n].record_id for n in values] == ["p", "c", "v", "k"]
    assert [rows[n].parent_id for n in values] == [None, "p", None, "v"]
    assert rows["yt_videos"].emotion_label is None
    assert rows["yt_videos"].event_time.day == 2
    assert {r.platform for r in rows.values()} == {"facebook", "youtube"}


@pytest.mark.parametrize("dataset", [POSTS, POST_COMMENTS, VIDEOS, VIDEO_COMMENTS])
def test_enriched_layout_and_plan(messages, dataset):
    df = enrich.enrich(messages(['{"uuid":"a"}', "{bad", None]), dataset)
    assert tuple(df.columns) == dataset.output_columns
    assert [df.schema[c].dataType.simpleString() for c in ("negative", "sentiment_label")] == [
        "float", "string",
    ]
    plan = plan_of(df)
    assert "Exchange" not in plan and "EvalPython" not in plan
    for row in df.collect():
        assert (row.sentiment_label, row.neutral) == ("neutral", 1.0)
        assert not dataset.emotion or row.emotion_label == "null"


def test_output_widths():
    assert [len(d.output_columns) for d in (POSTS, POST_COMMENTS, VIDEOS, VIDEO_COMMENTS)] == [
        17, 19, 14, 19,
    ]


def test_long_counts_and_errors(messages):
    df = enrich.enrich_videos(messages(['{"views": 3000000000}']), long_counts=True, errors=True)
    row = df.first()
    assert row.views == 3_000_000_000 and row.score_error is False


def test_trend_reads_only_its_columns(spark, tmp_path):
    _, df = scored_posts(spark, 20)
    path = str(tmp_path / "posts")
    df.write.parquet(path)
    plan = plan_of(reports.records_over_time(spark.read.parquet(path)))
    assert "ReadSchema: struct<timestamp:string>" in plan


def test_latest_snapshot_keeps_records_without_key(spark):
    rows = [(None, "1"), (None, "1"), ("a", "1"), ("a", "2")]
    df = spark.createDataFrame(rows, "uuid string, retrieving_time string")
    found = sorted(map(tuple, reports.latest_snapshot(df).collect()), key=str)
    assert found == [("a", "2"), (None, "1"), (None, "1")]
