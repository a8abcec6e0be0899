"""Comments and their posts or videos, joined while both arrive.

Both streams have a watermark, and a comment belongs to a parent only within a range around the
parent's time. So a parent is kept no longer than its last comment can come, a comment no
longer than its parent can, and what met nothing is written when that is sure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorameter.functions.time import event_time
from agorameter.schemas import SENTIMENTS

#: How late a record may come, and how far a comment's time may lie from that of its parent.
DELAY = "1 day"
BEFORE, AFTER = "1 day", "30 days"


def _timed(df: DataFrame, time: str, name: str, delay: str) -> DataFrame:
    return df.withColumn(name, event_time(time)).withWatermark(name, delay)


def _near(before: str, after: str) -> Column:
    return F.expr(
        f"comment_time >= parent_time - INTERVAL {before} AND comment_time <= parent_time + INTERVAL {after}"
    )


def _sides(parents, comments, key, parent, parent_column, comment_column, delay):
    one = _timed(parents, parent_column, "parent_time", delay)
    names = [F.col(f"`{c}`").alias(f"comment_{c}") for c in (parent, *SENTIMENTS)]
    two = _timed(comments, comment_column, "comment_time", delay).select("comment_time", *names)
    return one, two, F.col(key) == F.col(f"comment_{parent}")


def streaming_comment_mood(
    parents: DataFrame,
    comments: DataFrame,
    key: str = "uuid",
    parent: str = "post_id",
    keep: tuple[str, ...] = ("sentiment_label",),
    parent_time: str = "timestamp",
    comment_time: str = "timestamp",
    delay: str = DELAY,
    before: str = BEFORE,
    after: str = AFTER,
) -> DataFrame:
    """Each post or video once, with the number and mood of its comments, for append output.

    ``parents`` has one record per key and time. A parent is written when no comment of it can
    come any more, also one without comments. State holds parents and comments of that time.
    """
    one, two, same = _sides(parents, comments, key, parent, parent_time, comment_time, delay)
    joined = one.select(key, *keep, "parent_time").join(two, same & _near(before, after), "leftOuter")
    return (
        joined.groupBy(key, *keep, "parent_time")
        .agg(
            F.count(f"comment_{parent}").alias("comment_records"),
            *[F.avg(F.col(f"comment_{x}").cast("double")).alias(f"comment_{x}") for x in SENTIMENTS],
        )
        .drop("parent_time")
    )


def streaming_orphans(
    parents: DataFrame,
    comments: DataFrame,
    key: str = "uuid",
    parent: str = "post_id",
    parent_time: str = "timestamp",
    comment_time: str = "timestamp",
    delay: str = DELAY,
    before: str = BEFORE,
    after: str = AFTER,
) -> DataFrame:
    """Each comment without post or video, with its sentiment, once none can come any more."""
    one, two, same = _sides(parents, comments, key, parent, parent_time, comment_time, delay)
    known = one.select(F.col(key).alias("known"), "parent_time")
    same = F.col("known") == F.col(f"comment_{parent}")
    met = two.join(known, same & _near(before, after), "leftOuter")
    found = met.where("known IS NULL")
    return found.select(
        F.col(f"comment_{parent}").alias(parent),
        F.col("comment_time").alias("event_time"),
        *[F.col(f"comment_{x}").alias(x) for x in SENTIMENTS],
    )
