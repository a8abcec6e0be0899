"""Reports over the enriched tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorameter.functions import time
from agorameter.operators import messages
from agorameter.plans import reports
from agorameter.schemas import POSTS, POST_COMMENTS, SENTIMENTS, VIDEOS, VIDEO_COMMENTS
from agorameter.testbed import inputs, sql
from agorameter.testbed.enrich_queries import post_comments, posts, video_comments, videos
from agorameter.testbed.registry import register, rounded


def day_sql(column: str) -> str:
    return f"CAST({column} AS TIMESTAMP)"


def _timeline_sql(source: str, column: str = "timestamp") -> str:
    return f"""SELECT strftime({day_sql(column)}, '%Y-%m-%d') AS bucket, count(*) AS records
               FROM ({source}) GROUP BY 1"""


def as_day(df: DataFrame) -> DataFrame:
    return df.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd"))


def _parsed(spark, folder, messages_of, dataset) -> DataFrame:
    """Records before scoring, which the report does not read."""
    records = messages.parse_messages(messages_of(spark, folder), dataset.message)
    return messages.select_renamed(records, dataset.columns, dict(dataset.renames))


@register(_timeline_sql(sql.POSTS))
def posts_over_time(spark, folder):
    return as_day(reports.records_over_time(_parsed(spark, folder, inputs.post_messages, POSTS)))


@register(_timeline_sql(sql.POST_COMMENTS))
def post_comments_over_time(spark, folder):
    rows = _parsed(spark, folder, inputs.comment_messages, POST_COMMENTS)
    return as_day(reports.records_over_time(rows))


@register(_timeline_sql(sql.VIDEOS))
def videos_over_time(spark, folder):
    return as_day(reports.records_over_time(_parsed(spark, folder, inputs.video_messages, VIDEOS)))


@register(_timeline_sql(sql.VIDEO_COMMENTS))
def video_comments_over_time(spark, folder):
    rows = _parsed(spark, folder, inputs.video_comment_messages, VIDEO_COMMENTS)
    return as_day(reports.records_over_time(rows))


MEANS_SQL = ", ".join(f"round(avg({x}), 6) AS mean_{x}" for x in SENTIMENTS)
LABEL_COUNTS_SQL = ", ".join(
    f"count(*) FILTER (sentiment_label = '{x}') AS {x}_records" for x in SENTIMENTS
)
MEAN_COLUMNS = [f"mean_{x}" for x in SENTIMENTS]


@register(
    f"""SELECT strftime({day_sql("timestamp")}, '%Y-%m-%d') AS bucket, candidate,
               count(*) AS records, {MEANS_SQL}, {LABEL_COUNTS_SQL}
        FROM ({sql.ENRICHED_POSTS}) GROUP BY 1, 2"""
)
def sentiment_trend(spark, folder):
    trend = reports.sentiment_trend(posts(spark, folder, ["sentiment"]), ["candidate"])
    return rounded(as_day(trend), *MEAN_COLUMNS)


@register(
    f"""SELECT candidate, emotion_label, count(*) AS records,
               round(count(*) / sum(count(*)) OVER (PARTITION BY candidate), 6) AS share
        FROM ({sql.ENRICHED_POSTS}) GROUP BY 1, 2"""
)
def emotion_share(spark, folder):
    return rounded(reports.emotion_share(posts(spark, folder, ["emotion"]), "candidate"), "share")


@register(
    f"""SELECT channel, emotion_label, count(*) AS records,
               round(count(*) / sum(count(*)) OVER (PARTITION BY channel), 6) AS share
        FROM ({sql.ENRICHED_VIDEO_COMMENTS}) GROUP BY 1, 2"""
)
def emotion_share_by_channel(spark, folder):
    rows = video_comments(spark, folder, ["emotion"])
    return rounded(reports.emotion_share(rows, "channel"), "share")


_REACTIONS = ", ".join(f'CAST(sum("{r}") AS BIGINT) AS sum_{r}' for r in inputs.COUNTERS)
_REACTION_SUM = " + ".join(f'"{r}"' for r in inputs.COUNTERS)


@register(
    f"""SELECT sentiment_label, count(*) AS records, {_REACTIONS},
               CAST(sum({_REACTION_SUM}) AS BIGINT) AS reactions,
               round(avg({_REACTION_SUM}), 6) AS mean_reactions
        FROM ({sql.ENRICHED_POSTS}) GROUP BY 1"""
)
def post_engagement(spark, folder):
    return rounded(reports.post_engagement(posts(spark, folder, ["sentiment"])), "mean_reactions")


@register(
    f"""SELECT sentiment_label, count(*) AS records, {_REACTIONS},
               CAST(sum({_REACTION_SUM}) AS BIGINT) AS reactions,
               round(avg({_REACTION_SUM}), 6) AS mean_reactions
        FROM ({sql.ENRICHED_POST_COMMENTS}) GROUP BY 1"""
)
def post_comment_engagement(spark, folder):
    rows = post_comments(spark, folder, ["sentiment"])
    return rounded(reports.post_engagement(rows), "mean_reactions")


_VIDEO_COUNTERS = ", ".join(
    f"CAST(sum({c}) AS BIGINT) AS sum_{c}, round(avg({c}), 6) AS mean_{c}"
    for c in ("views", "video_likes", "comments")
)


@register(
    f"""SELECT sentiment_label, count(*) AS records, {_VIDEO_COUNTERS}
        FROM ({sql.ENRICHED_VIDEOS}) GROUP BY 1"""
)
def video_engagement(spark, folder):
    means = ("mean_views", "mean_video_likes", "mean_comments")
    return rounded(reports.video_engagement(videos(spark, folder)), *means)


@register(
    f"""SELECT sentiment_label, count(*) AS records,
               CAST(sum(comment_votes) AS BIGINT) AS sum_votes,
               round(avg(comment_votes), 6) AS mean_votes
        FROM ({sql.ENRICHED_VIDEO_COMMENTS}) GROUP BY 1"""
)
def comment_engagement(spark, folder):
    rows = video_comments(spark, folder, ["sentiment"])
    return rounded(reports.comment_engagement(rows), "mean_votes")


def _common_sql(
    source, platform, dataset, record, parent, subject, engagement, emotion, time_column
) -> str:
    return f"""SELECT '{platform}' AS platform, '{dataset}' AS dataset, {record} AS record_id,
        {parent} AS parent_id,
        strftime(CAST({time_column} AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S') AS event_time,
        {subject} AS subject, CAST({engagement} AS BIGINT) AS engagement, sentiment_label,
        negative, neutral, positive, {emotion} AS emotion_label FROM ({source})"""


_NO = "CAST(NULL AS VARCHAR)"


_CROSS_MEDIA = " UNION ALL ".join(
    [
        _common_sql(sql.ENRICHED_POSTS, "facebook", "fb_posts", "uuid", _NO, "candidate",
                    _REACTION_SUM, "emotion_label", "timestamp"),
        _common_sql(sql.ENRICHED_POST_COMMENTS, "facebook", "fb_comments", "uuid", "post_id",
                    "candidate", _REACTION_SUM, "emotion_label", "timestamp"),
        _common_sql(sql.ENRICHED_VIDEOS, "youtube", "yt_videos", "id_video", _NO, "channel",
                    "video_likes", _NO, "timestamp"),
        _common_sql(sql.ENRICHED_VIDEO_COMMENTS, "youtube", "yt_comments", "comment_id",
                    "id_video", "channel", "comment_votes", "emotion_label",
                    "comment_published_at"),
    ]
)


def _all_media(spark, folder, kinds=None) -> DataFrame:
    return reports.cross_media(
        posts(spark, folder, kinds),
        post_comments(spark, folder, kinds),
        videos(spark, folder),
        video_comments(spark, folder, kinds),
    )


@register(sql.rounded(_CROSS_MEDIA))
def cross_media(spark, folder):
    table = _all_media(spark, folder)
    return rounded(table.withColumn("event_time", time.iso_string("event_time")))


@register(
    f"""SELECT strftime(date_trunc('month', {day_sql("event_time")}), '%Y-%m-%d') AS bucket,
               platform, dataset, count(*) AS records, {MEANS_SQL}, {LABEL_COUNTS_SQL}
        FROM ({_CROSS_MEDIA}) GROUP BY 1, 2, 3"""
)
def platform_trend(spark, folder):
    """Monthly sentiment of all media side by side."""
    dimensions = ["platform", "dataset"]
    rows = _all_media(spark, folder, ["sentiment"])
    trend = reports.sentiment_trend(rows, dimensions, "event_time", "month")
    return rounded(as_day(trend), *MEAN_COLUMNS)


@register(
    f"""SELECT strftime(date_trunc('day', {day_sql("event_time")}), '%Y-%m-%d') AS bucket,
               platform, subject, sentiment_label, count(*) AS records,
               round(count(*) / sum(count(*)) OVER (
                   PARTITION BY date_trunc('day', {day_sql("event_time")}), platform, subject), 6
               ) AS share
        FROM ({_CROSS_MEDIA})
        GROUP BY date_trunc('day', {day_sql("event_time")}), platform, subject, sentiment_label"""
)
def subject_shares(spark, folder):
    """Shares of the sentiment labels by day, platform and subject."""
    rows = _all_media(spark, folder, ["sentiment"])
    daily = rows.withColumn("bucket", reports.bucket("event_time"))
    shares = reports.label_shares(daily, ["bucket", "platform", "subject"], "sentiment_label")
    return rounded(as_day(shares), "share")


@register(
    f"""SELECT platform, sentiment_label, count(*) AS records,
               round(count(*) / sum(count(*)) OVER (PARTITION BY platform), 6) AS share
        FROM ({_CROSS_MEDIA}) GROUP BY 1, 2"""
)
def sentiment_share(spark, folder):
    rows = _all_media(spark, folder, ["sentiment"])
    shares = reports.label_shares(rows, ["platform"], "sentiment_label")
    return rounded(shares, "share")


@register(
    f"""SELECT channel_bias, channel,
               CAST(grouping(channel_bias) * 2 + grouping(channel) AS INTEGER) AS level,
               count(*) AS records, {MEANS_SQL}, {LABEL_COUNTS_SQL}
        FROM ({sql.ENRICHED_VIDEOS}) GROUP BY ROLLUP (channel_bias, channel)"""
)
def bias_rollup(spark, folder):
    breakdown = reports.bias_breakdown(videos(spark, folder))
    counts = {f"{x}_records": F.col(f"{x}_records").cast("bigint") for x in SENTIMENTS}
    return rounded(breakdown.withColumns(counts), *MEAN_COLUMNS)


@register(
    f"""SELECT channel_bias, state, channel,
               CAST(grouping(channel_bias) * 4 + grouping(state) * 2 + grouping(channel)
                    AS INTEGER) AS level,
               count(*) AS records, {MEANS_SQL}, {LABEL_COUNTS_SQL}
        FROM ({sql.ENRICHED_VIDEOS}) GROUP BY ROLLUP (channel_bias, state, channel)"""
)
def state_rollup(spark, folder):
    breakdown = reports.bias_breakdown(videos(spark, folder), ("channel_bias", "state", "channel"))
    counts = {f"{x}_records": F.col(f"{x}_records").cast("bigint") for x in SENTIMENTS}
    return rounded(breakdown.withColumns(counts), *MEAN_COLUMNS)


@register(
    """SELECT uuid, user_id, value FROM (
         SELECT 'user-' || user_id AS uuid, user_id, value,
                row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS place
         FROM events) WHERE place = 1"""
)
def latest_snapshot(spark, folder):
    """Events as snapshots of their user; the last one stays."""
    snapshots = inputs.table(spark, folder, "events").select(
        F.concat(F.lit("user-"), "user_id").alias("uuid"),
        F.col("ts").alias("retrieving_time"),
        "event_id",
        "user_id",
        "value",
    )
    return reports.latest_snapshot(snapshots).select("uuid", "user_id", "value")


_COMMENT_MOOD = f"""
SELECT post_id, count(*) AS comment_records,
       {", ".join(f"round(avg({x}), 6) AS comment_{x}" for x in SENTIMENTS)}
FROM ({sql.ENRICHED_POST_COMMENTS}) GROUP BY post_id"""
COMMENT_MEANS = [f"comment_{x}" for x in SENTIMENTS]


COMMENT_MOOD_SQL = f"""SELECT uuid, p.sentiment_label, coalesce(comment_records, 0) AS comment_records,
               {", ".join(COMMENT_MEANS)}
        FROM ({sql.ENRICHED_POSTS}) p LEFT JOIN ({_COMMENT_MOOD}) c ON p.uuid = c.post_id"""
ORPHANS_SQL = f"""SELECT c.* FROM ({_COMMENT_MOOD}) c
        WHERE NOT EXISTS (SELECT 1 FROM documents WHERE 'doc-' || doc_id = c.post_id)"""


@register(COMMENT_MOOD_SQL)
def comment_mood(spark, folder):
    parents = posts(spark, folder, ["sentiment"]).select("uuid", "sentiment_label")
    mood = reports.comment_mood(parents, post_comments(spark, folder, ["sentiment"]))
    return rounded(mood, *COMMENT_MEANS)


@register(
    f"""SELECT v.id_video, v.sentiment_label, coalesce(comment_records, 0) AS comment_records,
               {", ".join(COMMENT_MEANS)}
        FROM ({sql.ENRICHED_VIDEOS}) v LEFT JOIN (
            SELECT id_video, count(*) AS comment_records,
                   {", ".join(f"round(avg({x}), 6) AS comment_{x}" for x in SENTIMENTS)}
            FROM ({sql.ENRICHED_VIDEO_COMMENTS}) GROUP BY id_video) c ON c.id_video = v.id_video"""
)
def video_comment_mood(spark, folder):
    parents = videos(spark, folder).select("id_video", "sentiment_label")
    comments = video_comments(spark, folder, ["sentiment"])
    mood = reports.comment_mood(parents, comments, "id_video", "id_video")
    return rounded(mood, *COMMENT_MEANS)


@register(ORPHANS_SQL)
def orphan_comments(spark, folder):
    parents = _parsed(spark, folder, inputs.post_messages, POSTS)
    orphans = reports.orphan_comments(parents, post_comments(spark, folder, ["sentiment"]))
    return rounded(orphans, *COMMENT_MEANS)
