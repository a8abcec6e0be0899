from __future__ import annotations

import json

from pyspark.sql import functions as F

from agorameter.operators import messages as m
from agorameter.schemas import POSTS, VIDEO_COMMENTS, VIDEOS, with_long_counts


def parsed(messages, values, schema=VIDEOS.message):
    df = messages(values)
    return m.parse_messages(df.orderBy("id").coalesce(1), schema).collect()


def test_fields_outside_the_schema_are_ignored(messages):
    row = parsed(messages, ['{"id_video": "a", "social": "youtube", "Views": 1}'])[0]
    assert row.id_video == "a" and row.views is None and "social" not in row.asDict()


def test_malformed_messages_become_rows_of_nulls(messages):
    rows = parsed(messages, ['{"views":5', "[1]", None, ""])
    assert len(rows) == 4
    assert all(v is None for r in rows for v in r)


def test_wrong_types_cost_only_their_field(messages):
    values = [
        '{"views": "59", "title": "t"}',
        '{"views": 59.0, "title": "t"}',
        '{"views": 3000000000, "title": "t"}',
        '{"views": 59, "title": 7}',
        '{"views": 59, "title": {"a": 1}}',
    ]
    rows = parsed(messages, values)
    assert [r.views for r in rows] == [None, None, None, 59, 59]
    assert [r.title for r in rows] == ["t", "t", "t", "7", '{"a":1}']
    wide = parsed(messages, values[2:3], with_long_counts(VIDEOS.message))
    assert wide[0].views == 3_000_000_000


def test_malformed_messages_keep_their_text(messages):
    df = messages(['{"views": 5}', '{"views":5', "[1]", None])
    rows = m.malformed_messages(df, VIDEOS.message).orderBy("id").collect()
    assert [(r.id, r._corrupt_record) for r in rows] == [(1, '{"views":5'), (2, "[1]")]


def test_round_trip(spark):
    df = spark.createDataFrame(
        [("k", 1, None), ("l", None, "é\n\"q\"")], "uuid string, like int, content string"
    )
    sent = m.to_messages(df.withColumn("topic", F.lit("t")), "topic", F.col("uuid"))
    assert sent.dtypes == [("key", "binary"), ("value", "binary"), ("topic", "string")]
    first = sent.orderBy("key").first()
    assert json.loads(bytes(first.value)) == {"uuid": "k", "like": 1}
    back = m.parse_messages(sent, POSTS.message).select("uuid", "like", "content")
    assert {tuple(r) for r in back.collect()} == {("k", 1, None), ("l", None, "é\n\"q\"")}


def test_select_renamed(spark):
    df = spark.createDataFrame([("a", "2024")], "comment_cid string, video_timestamp string")
    renamed = m.select_renamed(df, ("timestamp", "comment_id"), dict(VIDEO_COMMENTS.renames))
    assert renamed.columns == ["timestamp", "comment_id"]
