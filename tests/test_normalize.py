from __future__ import annotations

from datetime import datetime

from agorameter.operators import normalize as n
from agorameter.schemas import FLAT_VIDEO, FLAT_VIDEO_COMMENT, RAW_VIDEO
from tests.conftest import plan_of


def raw(spark):
    comment = ("c1", "2024-09-02T00:00:00", "@a", "Nice", 3)
    other = ("c2", "2024-09-02T01:00:00", "@b", "", 0)
    base = ("ABC", "DEMOCRAT", "NY", "u", "v1", "t", "2024-09-01T00:00:00", 5, 90, "text", "youtube")

    def row(video_id, text, comments):
        return (*base[:4], video_id, *base[5:9], text, base[10], comments)

    return spark.createDataFrame(
        [
            row("v1", "text", [comment, other]),
            row("v2", "text", []),
            row("v3", None, None),
            row(None, "text", [comment]),
        ],
        RAW_VIDEO,
    )


def test_flatten_comments(spark):
    flat = n.flatten_comments(raw(spark).filter("id_video IS NOT NULL"))
    assert flat.columns == FLAT_VIDEO_COMMENT.names
    assert flat.schema.simpleString() == FLAT_VIDEO_COMMENT.simpleString()
    rows = flat.orderBy("comment_cid").collect()
    assert [(r.id_video, r.comment_cid, r.comment_text, r.comment_votes) for r in rows] == [
        ("v1", "c1", "Nice", 3),
        ("v1", "c2", "", 0),
    ]
    assert (rows[0].video_timestamp, rows[0].video_likes, rows[0].social) == (
        "2024-09-01T00:00:00", 5, "youtube",
    )


def test_flatten_videos(spark):
    flat = n.flatten_videos(raw(spark))
    assert flat.schema.simpleString() == FLAT_VIDEO.simpleString()
    found = {r.id_video: r.comments for r in flat.collect()}
    assert found == {"v1": 2, "v2": 0, "v3": None, None: 1}


def test_failed_videos_are_the_complement(spark):
    df = raw(spark)
    usable, failed = n.usable_videos(df), n.failed_videos(df)
    assert {r.id_video for r in usable.collect()} == {"v1", "v2"}
    assert {r.id_video for r in failed.collect()} == {"v3", None}


def test_tags(spark):
    df = n.tag(spark.range(1), "facebook", "Posts")
    assert tuple(df.first()) == (0, "facebook", "Posts")
    assert n.tag(spark.range(1), "youtube").columns == ["id", "social"]


def test_every_datetime_becomes_text(spark):
    df = spark.sql(
        """SELECT timestamp '2024-01-01 00:00:00.000001' a, timestamp_ntz '2024-01-01 05:00:00' b,
                  date '2024-01-01' c, 7 d, CAST(NULL AS timestamp) e"""
    )
    row = n.iso_datetimes(df).first()
    assert (row.a, row.b, row.d, row.e) == (
        datetime(2024, 1, 1, 0, 0, 0, 1).isoformat(), datetime(2024, 1, 1, 5).isoformat(), 7, None,
    )
    assert n.iso_datetimes(spark.range(1)).columns == ["id"]


def test_channel_metadata(spark):
    videos = spark.createDataFrame([("ABC", 1), ("ABC", 2), ("XYZ", 3)], "channel string, n int")
    channels = spark.createDataFrame(
        [("ABC", "DEMOCRAT", "NY"), ("ABC", "DEMOCRAT", "NY"), ("FOX", "REPUBLICAN", "NY")],
        "channel string, channel_bias string, state string",
    )
    rows = n.with_channel_metadata(videos, channels).orderBy("n").collect()
    assert [(r.n, r.channel_bias, r.state) for r in rows] == [
        (1, "DEMOCRAT", "NY"), (2, "DEMOCRAT", "NY"), (3, None, None),
    ]
    constants = n.with_channel(spark.range(1), "Harbour9", "QX", "SIDE_B").first()
    assert tuple(constants) == (0, "Harbour9", "SIDE_B", "QX")


def test_only_small_channel_tables_are_broadcast(spark, tmp_path):
    path = str(tmp_path / "channels")
    spark.range(10).selectExpr(
        "CAST(id AS string) channel", "'x' channel_bias", "'y' state"
    ).write.parquet(path)
    videos = spark.range(10).selectExpr("CAST(id AS string) channel")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    joined = n.with_channel_metadata(videos, spark.read.parquet(path))
    assert "BroadcastHashJoin" in plan_of(joined)
    spark.conf.set(threshold, "100")
    try:
        joined = n.with_channel_metadata(videos, spark.read.parquet(path))
        assert "BroadcastHashJoin" not in plan_of(joined)
        assert joined.filter("state = 'y'").count() == 10
    finally:
        spark.conf.unset(threshold)


def test_conflicting_channel_metadata_gives_one_real_row(spark):
    channels = spark.createDataFrame(
        [("ABC", "DEMOCRAT", "NY"), ("ABC", "LEAN", "CA")],
        "channel string, channel_bias string, state string",
    )
    videos = spark.createDataFrame([("ABC",)], "channel string")
    (row,) = n.with_channel_metadata(videos, channels).collect()
    assert (row.channel_bias, row.state) == ("DEMOCRAT", "NY")
