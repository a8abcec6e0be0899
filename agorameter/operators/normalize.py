"""Collected records to the flat records that are sent as messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agorameter.functions.time import iso_string
from agorameter.schemas import FLAT_VIDEO

#: Fields a flat video and a flat comment take over from the collected video.
_VIDEO_FIELDS = {
    "channel": "channel",
    "channel_bias": "channel_bias",
    "state": "state",
    "url_video": "url_video",
    "id_video": "id_video",
    "title": "title",
    "timestamp": "video_timestamp",
    "likes": "video_likes",
    "views": "views",
}
_COMMENT_FIELDS = {
    "cid": "comment_cid",
    "published_at": "comment_published_at",
    "author": "comment_author",
    "text": "comment_text",
    "votes": "comment_votes",
}


def tag(df: DataFrame, social: str, section: str | None = None) -> DataFrame:
    """Add the platform tag and, for tables, the section tag."""
    tags = {"social": F.lit(social)}
    if section is not None:
        tags["section"] = F.lit(section)
    return df.withColumns(tags)


def iso_datetimes(df: DataFrame) -> DataFrame:
    """Every timestamp column as ISO string; other columns stay as they are."""
    times = {
        f.name: iso_string(F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    }
    return df.withColumns(times) if times else df


def flatten_comments(videos: DataFrame) -> DataFrame:
    """One row per comment with its video's fields; a video without comments gives none."""
    exploded = videos.select(*_VIDEO_FIELDS, "social", F.explode("comments").alias("comment"))
    return exploded.select(
        *[F.col(old).alias(new) for old, new in _VIDEO_FIELDS.items()],
        "social",
        *[F.col(f"comment.{old}").alias(new) for old, new in _COMMENT_FIELDS.items()],
    )


def flatten_videos(videos: DataFrame) -> DataFrame:
    """One row per video, with the number of comments in place of the comments."""
    columns = {new: F.col(old) for old, new in _VIDEO_FIELDS.items()}
    columns |= {
        "fullText": F.col("fullText"),
        "comments": F.size("comments"),
        "social": F.col("social"),
    }
    return videos.select(*[columns[c].alias(c) for c in FLAT_VIDEO.names])


def is_usable() -> Column:
    """Whether a collected video was extracted: it has an id and a transcript."""
    return F.col("id_video").isNotNull() & F.col("fullText").isNotNull()


def usable_videos(videos: DataFrame) -> DataFrame:
    """Collected videos without those whose extraction failed."""
    return videos.filter(is_usable())


def failed_videos(videos: DataFrame) -> DataFrame:
    """The complement of ``usable_videos``."""
    return videos.filter(~is_usable())


def with_channel(df: DataFrame, channel: str, state: str, bias: str) -> DataFrame:
    """Attach the constants of one channel."""
    return df.withColumns(
        {"channel": F.lit(channel), "channel_bias": F.lit(bias), "state": F.lit(state)}
    )


def with_channel_metadata(df: DataFrame, channels: DataFrame) -> DataFrame:
    """Attach ``channel_bias`` and ``state`` by channel; unknown channels get NULL.

    ``channels`` is reduced to one row per channel: of several the smallest pair, so that bias
    and state are of one given row. Spark broadcasts it while its size is
    below ``spark.sql.autoBroadcastJoinThreshold``, so that a channel with most of the rows
    stays spread; beyond that it joins by shuffle and splits skewed partitions.
    """
    row = F.min(F.struct("channel_bias", "state")).alias("row")
    dimension = channels.groupBy("channel").agg(row).select("channel", "row.*")
    return df.join(dimension, "channel", "left")
