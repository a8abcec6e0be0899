"""Collected records to routed messages."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorameter.operators.messages import to_messages
from agorameter.operators.normalize import iso_datetimes, tag
from agorameter.operators.route import with_route
from agorameter.schemas import COMMENTS_SECTION, FACEBOOK, POSTS_SECTION


def messages_of(records: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Tagged records as ``(key, value, topic)``; records that fit no topic have none.

    The route is taken from the typed columns, so the messages need not be parsed again. A
    message without a topic holds its ``reject_reason``.
    """
    return to_messages(with_route(iso_datetimes(records), names))


def ingest(
    posts: DataFrame,
    post_comments: DataFrame,
    videos: DataFrame,
    video_comments: DataFrame,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """The two tables and the two kinds of flat video records as messages.

    Tables get their tags here, video records bring theirs.
    """
    inputs = [
        tag(posts, FACEBOOK, POSTS_SECTION),
        tag(post_comments, FACEBOOK, COMMENTS_SECTION),
        videos,
        video_comments,
    ]
    return reduce(DataFrame.unionByName, [messages_of(df, names) for df in inputs])


def with_reject_topic(messages: DataFrame, topic: str) -> DataFrame:
    """Messages without a topic sent to one of their own, so that one pass writes all."""
    return messages.withColumn("topic", F.coalesce("topic", F.lit(topic)))


def deliverable(messages: DataFrame) -> DataFrame:
    """Messages that have a topic."""
    return messages.filter(F.col("topic").isNotNull())


def undeliverable(messages: DataFrame) -> DataFrame:
    """Messages without a topic, to be kept aside."""
    return messages.filter(F.col("topic").isNull()).drop("topic")
