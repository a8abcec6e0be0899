"""Content-based routing of tagged records to their dataset's topic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorameter.functions.text import expand_once
from agorameter.operators.messages import decode
from agorameter.schemas import (
    COMMENTS_SECTION,
    DATASETS,
    FACEBOOK,
    POST_COMMENTS,
    POSTS,
    POSTS_SECTION,
    VIDEO_COMMENTS,
    VIDEOS,
    YOUTUBE,
    layout,
)

#: The fields routing looks at.
TAGS = layout("social string, section string, fullText string")


def topic_of(
    social: Column, section: Column, full_text: Column, names: Mapping[str, str] | None = None
) -> Column:
    """Topic of a record, NULL when it fits none. A text that is present but empty counts.

    ``names`` maps dataset names to topic names where they differ.
    """
    topic = {name: F.lit((names or {}).get(name, name)) for name in DATASETS}
    facebook, youtube = social == FACEBOOK, social == YOUTUBE
    return (
        F.when(facebook & (section == POSTS_SECTION), topic[POSTS.name])
        .when(facebook & (section == COMMENTS_SECTION), topic[POST_COMMENTS.name])
        .when(youtube & full_text.isNull(), topic[VIDEO_COMMENTS.name])
        .when(youtube, topic[VIDEOS.name])
    )


def reject_reason(social: Column, topic: Column) -> Column:
    """Why a record has no topic; NULL for a routed one."""
    return (
        F.when(social.isNull(), "untagged")
        .when(~social.isin(FACEBOOK, YOUTUBE), "unknown platform")
        .when(topic.isNull(), "no branch")
    )


def with_route(df: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Add ``topic`` and ``reject_reason`` to records with typed tag columns, in one pass.

    Records without a ``section`` or ``fullText`` column count as having none.
    """
    tags = [F.col(c) if c in df.columns else F.lit(None).cast("string") for c in TAGS.names]
    social = tags[0]
    return df.withColumn("topic", topic_of(*tags, names=names)).withColumn(
        "reject_reason", reject_reason(social, F.col("topic"))
    )


def route_messages(
    df: DataFrame, value: str = "value", names: Mapping[str, str] | None = None
) -> DataFrame:
    """Add ``topic`` and ``reject_reason`` to JSON messages; the message itself is untouched."""
    plain = df.drop("topic")
    tagged = plain.select("*", expand_once(F.from_json(decode(value), TAGS)))
    return with_route(tagged, names).drop(*TAGS.names)


def routed(df: DataFrame) -> DataFrame:
    """Records with a topic."""
    return df.filter(F.col("topic").isNotNull()).drop("reject_reason")


def rejected(df: DataFrame) -> DataFrame:
    """Records without a topic, with the reason."""
    return df.filter(F.col("topic").isNull()).drop("topic")
