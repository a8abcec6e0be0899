"""Reports over the enriched tables.

These are the queries behind charts of trends, emotional tones and engagement. All of
them aggregate partially before they shuffle, so a hot key costs one row per input
partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorameter.functions.time import event_time
from agorameter.schemas import (
    FACEBOOK,
    POST_COMMENTS,
    POSTS,
    REACTIONS,
    SENTIMENTS,
    VIDEO_COMMENTS,
    VIDEOS,
    YOUTUBE,
)


def bucket(time: Column | str, unit: str = "day") -> Column:
    """Start of the time bucket of an ISO time string, as timestamp."""
    return F.date_trunc(unit, event_time(time))


def records_over_time(df: DataFrame, time: str = "timestamp", unit: str = "day") -> DataFrame:
    """Number of records per time bucket."""
    return df.groupBy(bucket(time, unit).alias("bucket")).agg(F.count("*").alias("records"))


def _label_counts() -> list[Column]:
    return [
        F.count_if(F.col("sentiment_label") == label).alias(f"{label}_records")
        for label in SENTIMENTS
    ]


def sentiment_trend(
    df: DataFrame, dimensions: Sequence[str], time: str = "timestamp", unit: str = "day"
) -> DataFrame:
    """Mean probabilities and label counts per time bucket and dimension values."""
    return df.groupBy(bucket(time, unit).alias("bucket"), *dimensions).agg(
        F.count("*").alias("records"),
        *[F.avg(F.col(label).cast("double")).alias(f"mean_{label}") for label in SENTIMENTS],
        *_label_counts(),
    )


def label_shares(df: DataFrame, dimensions: Sequence[str], label: str) -> DataFrame:
    """Records per label and dimension values, with the share in the dimension's total."""
    counts = df.groupBy(*dimensions, label).agg(F.count("*").alias("records"))
    # The window runs over the counts, which are as many as there are groups.
    total = F.sum("records").over(Window.partitionBy(*dimensions))
    return counts.withColumn("share", F.col("records") / total)


def emotion_share(df: DataFrame, dimension: str) -> DataFrame:
    return label_shares(df, [dimension], "emotion_label")


def _reaction_sum() -> Column:
    return reduce(add, [F.coalesce(F.col(r).cast("long"), F.lit(0)) for r in REACTIONS])


def post_engagement(df: DataFrame, dimensions: Sequence[str] = ("sentiment_label",)) -> DataFrame:
    """Reactions by sentiment label: total per kind, overall sum and mean per record."""
    reactions = _reaction_sum()
    return df.groupBy(*dimensions).agg(
        F.count("*").alias("records"),
        *[F.sum(F.col(r).cast("long")).alias(f"sum_{r}") for r in REACTIONS],
        F.sum(reactions).alias("reactions"),
        F.avg(reactions).alias("mean_reactions"),
    )


def video_engagement(df: DataFrame, dimensions: Sequence[str] = ("sentiment_label",)) -> DataFrame:
    """Views, likes and comments of videos by sentiment label."""
    return df.groupBy(*dimensions).agg(
        F.count("*").alias("records"),
        *[
            f(F.col(c).cast("long")).alias(f"{name}_{c}")
            for c in ("views", "video_likes", "comments")
            for name, f in (("sum", F.sum), ("mean", F.avg))
        ],
    )


def comment_engagement(
    df: DataFrame, dimensions: Sequence[str] = ("sentiment_label",)
) -> DataFrame:
    """Votes of video comments by sentiment label."""
    votes = F.col("comment_votes").cast("long")
    return df.groupBy(*dimensions).agg(
        F.count("*").alias("records"),
        F.sum(votes).alias("sum_votes"),
        F.avg(votes).alias("mean_votes"),
    )


def _common(
    df: DataFrame,
    platform: str,
    dataset: str,
    record: str,
    parent: str | None,
    subject: str,
    engagement: Column,
    time: str = "timestamp",
) -> DataFrame:
    null = F.lit(None).cast("string")
    return df.select(
        F.lit(platform).alias("platform"),
        F.lit(dataset).alias("dataset"),
        F.col(record).alias("record_id"),
        (F.col(parent) if parent else null).alias("parent_id"),
        event_time(time).alias("event_time"),
        F.col(subject).alias("subject"),
        engagement.alias("engagement"),
        "sentiment_label",
        *SENTIMENTS,
        (F.col("emotion_label") if "emotion_label" in df.columns else null).alias("emotion_label"),
    )


def cross_media(
    posts: DataFrame, post_comments: DataFrame, videos: DataFrame, video_comments: DataFrame
) -> DataFrame:
    """The four enriched tables in one common layout.

    ``subject`` is the candidate or the channel; ``engagement`` the sum of reactions, the
    likes of a video, or the votes of a comment. A table without emotions gives NULL there.
    """
    reactions = _reaction_sum()
    parts = [
        _common(posts, FACEBOOK, POSTS.name, "uuid", None, "candidate", reactions),
        _common(
            post_comments, FACEBOOK, POST_COMMENTS.name, "uuid", "post_id", "candidate", reactions
        ),
        _common(
            videos, YOUTUBE, VIDEOS.name, "id_video", None, "channel",
            F.col("video_likes").cast("long"),
        ),
        _common(
            video_comments, YOUTUBE, VIDEO_COMMENTS.name, "comment_id", "id_video", "channel",
            F.col("comment_votes").cast("long"), time="comment_published_at",
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def bias_breakdown(
    df: DataFrame, dimensions: Sequence[str] = ("channel_bias", "channel")
) -> DataFrame:
    """Records and mean probabilities by channel leaning and channel, with subtotals.

    ``level`` is 0 for a channel, 1 for a leaning's subtotal, 3 for the grand total; other
    dimensions, such as leaning, state and channel, are counted likewise. The finest groups
    are aggregated first, so the roll-up multiplies groups, not records.
    """
    finest = df.groupBy(*dimensions).agg(
        F.count("*").alias("n"),
        *[F.sum(F.col(x).cast("double")).alias(x) for x in SENTIMENTS],
        *_label_counts(),
    )
    records = F.sum("n")
    return finest.rollup(*dimensions).agg(
        F.grouping_id().cast("int").alias("level"),
        records.alias("records"),
        *[(F.sum(x) / records).alias(f"mean_{x}") for x in SENTIMENTS],
        *[F.sum(f"{x}_records").alias(f"{x}_records") for x in SENTIMENTS],
    )


def latest_snapshot(
    df: DataFrame,
    key: str = "uuid",
    version: str = "retrieving_time",
    within: Sequence[str] = (),
) -> DataFrame:
    """The latest version of each record. Equal versions are settled by the other columns.

    ``within`` names columns that the key decides; a table that is dealt out by them is not
    shuffled again. Records without a key, such as those of malformed messages, are all kept. Spark keeps one
    row per key in every input partition before it shuffles.
    """
    return with_place(df, key, version, within).filter("_place = 1").drop("_place")


def with_place(
    df: DataFrame, key: str, version: str, within: Sequence[str] = (), last: Sequence[str] = ()
) -> DataFrame:
    """Each row with its place among the versions of its key, 1 for the latest.

    ``last`` names the columns that settle equal versions after all others.
    """
    known = (key, version, *within, *last)
    ties = [F.asc(f"`{c}`") for c in df.columns if c not in known] + [F.asc(c) for c in last]
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    order = Window.partitionBy(*within, key, "_alone").orderBy(F.desc(version), *ties)
    placed = df.withColumn("_alone", alone).withColumn("_place", F.row_number().over(order))
    return placed.drop("_alone")


def mood_by_parent(comments: DataFrame, parent: str) -> DataFrame:
    """Number and mean sentiment of the comments of each post or video."""
    return comments.groupBy(parent).agg(
        F.count("*").alias("comment_records"),
        *[F.avg(F.col(x).cast("double")).alias(f"comment_{x}") for x in SENTIMENTS],
    )


def comment_mood(
    parents: DataFrame, comments: DataFrame, key: str = "uuid", parent: str = "post_id"
) -> DataFrame:
    """Each post or video with the number and mood of its comments.

    Comments are reduced to one row per parent before the join. ``parents`` should have
    one row per key (``latest_snapshot``).
    """
    mood = mood_by_parent(comments, parent).withColumnRenamed(parent, key)
    return parents.join(mood, key, "left").fillna(0, ["comment_records"])


def orphan_comments(
    parents: DataFrame, comments: DataFrame, key: str = "uuid", parent: str = "post_id"
) -> DataFrame:
    """Mood of comments whose post or video is not in ``parents``, by parent."""
    known = parents.select(F.col(key).alias(parent))
    return mood_by_parent(comments, parent).join(known, parent, "left_anti")
