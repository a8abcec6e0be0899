from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from agorameter.operators import route
from agorameter.plans.ingest import deliverable, ingest, undeliverable
from agorameter.schemas import DATASETS
from tests.conftest import plan_of

CASES = [
    ({"social": "facebook", "section": "Posts"}, "fb_posts"),
    ({"social": "facebook", "section": "Comments_with_candidate_column"}, "fb_comments"),
    ({"social": "youtube"}, "yt_comments"),
    ({"social": "youtube", "fullText": None}, "yt_comments"),
    ({"social": "youtube", "fullText": "words"}, "yt_videos"),
    ({"social": "youtube", "fullText": ""}, "yt_videos"),
    ({"social": "youtube", "section": "Posts"}, "yt_comments"),
    ({"section": "Posts"}, "untagged"),
    ({"social": None}, "untagged"),
    ({"social": ""}, "unknown platform"),
    ({"social": "x", "fullText": "words"}, "unknown platform"),
    ({"social": "Facebook", "section": "Posts"}, "unknown platform"),
    ({"social": "facebook"}, "no branch"),
    ({"social": "facebook", "section": "Stories"}, "no branch"),
]


def outcomes(df):
    return {r.id: r.topic or r.reject_reason for r in df.collect()}


def test_messages(messages):
    values = [json.dumps(c) for c, _ in CASES] + ["{broken", None]
    df = route.route_messages(messages(values))
    assert outcomes(df) == dict(enumerate([o for _, o in CASES] + ["untagged", "untagged"]))


def test_records(spark):
    rows = [(i, c.get("social"), c.get("section"), c.get("fullText")) for i, (c, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id int, social string, section string, fullText string")
    assert outcomes(route.with_route(df)) == dict(enumerate(o for _, o in CASES))


def test_records_without_tag_columns(spark):
    df = spark.createDataFrame([(0, "youtube"), (1, "facebook")], "id int, social string")
    assert outcomes(route.with_route(df)) == {0: "yt_comments", 1: "no branch"}


def test_messages_are_untouched_and_parsed_once(messages):
    value = '{"social":"youtube", "extra": [1, 2]}'
    routed = route.routed(route.route_messages(messages([value])))
    assert routed.columns == ["id", "value", "topic"]
    assert bytes(routed.first().value).decode() == value
    assert plan_of(routed).count("from_json") == 1


def test_topic_names(messages):
    df = route.route_messages(messages(['{"social":"youtube"}']), names={"yt_comments": "other"})
    assert df.first().topic == "other"


tags = st.fixed_dictionaries(
    {},
    optional={
        "social": st.sampled_from(["facebook", "youtube", "x", "", None]),
        "section": st.sampled_from(["Posts", "Comments_with_candidate_column", "Y", None]),
        "fullText": st.sampled_from(["", "words", None]),
    },
)


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(tags, min_size=1, max_size=40))
def test_routing_is_a_partition(spark, messages, values):
    df = route.route_messages(messages([json.dumps(v) for v in values]))
    kept = [r.id for r in route.routed(df).collect()]
    dropped = [r.id for r in route.rejected(df).collect()]
    assert sorted(kept + dropped) == list(range(len(values)))
    assert all(r.topic in DATASETS for r in route.routed(df).collect())
    assert all(r.reject_reason for r in route.rejected(df).collect())


def test_ingest(spark):
    posts = spark.sql("SELECT 'p' uuid, timestamp '2024-09-01 00:00:00' timestamp, 'hi' content")
    comments = spark.sql("SELECT 'c' uuid, 'p' post_id, 'oh' content")
    videos = spark.sql("SELECT 'v' id_video, 'youtube' social, 'words' fullText")
    video_comments = spark.sql(
        "SELECT 'v' id_video, social, 'w' comment_text FROM VALUES ('youtube'), (NULL) AS t(social)"
    )
    sent = ingest(posts, comments, videos, video_comments)
    found = {r.topic: json.loads(bytes(r.value)) for r in deliverable(sent).collect()}
    assert found == {
        "fb_posts": {
            "uuid": "p", "timestamp": "2024-09-01T00:00:00", "content": "hi",
            "social": "facebook", "section": "Posts",
        },
        "fb_comments": {
            "uuid": "c", "post_id": "p", "content": "oh",
            "social": "facebook", "section": "Comments_with_candidate_column",
        },
        "yt_videos": {"id_video": "v", "social": "youtube", "fullText": "words"},
        "yt_comments": {"id_video": "v", "social": "youtube", "comment_text": "w"},
    }
    assert [json.loads(bytes(r.value)) for r in undeliverable(sent).collect()] == [
        {"id_video": "v", "comment_text": "w", "reject_reason": "untagged"}
    ]
