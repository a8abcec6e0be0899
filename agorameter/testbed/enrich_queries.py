"""Enrichment of each dataset, from messages to output columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorameter.plans import enrich
from agorameter.schemas import SENTIMENTS
from agorameter.testbed import inputs, sql
from agorameter.testbed.registry import register, rounded, shipped
from agorameter.testbed.wordlists import letter_scorer, scorer


def posts(spark, folder, kinds=None) -> DataFrame:
    return enrich.enrich_posts(inputs.post_messages(spark, folder), scorer(), kinds=kinds)


def post_comments(spark, folder, kinds=None) -> DataFrame:
    return enrich.enrich_post_comments(inputs.comment_messages(spark, folder), scorer(), kinds=kinds)


def videos(spark, folder, kinds=None) -> DataFrame:
    return enrich.enrich_videos(inputs.video_messages(spark, folder), scorer(), kinds=kinds)


def video_comments(spark, folder, kinds=None) -> DataFrame:
    messages = inputs.video_comment_messages(spark, folder)
    return enrich.enrich_video_comments(messages, scorer(), kinds=kinds)


@register(sql.rounded(sql.ENRICHED_POSTS))
def enrich_posts(spark, folder):
    return rounded(posts(spark, folder))


@register(sql.rounded(sql.ENRICHED_POST_COMMENTS))
def enrich_fb_comments(spark, folder):
    return rounded(post_comments(spark, folder))


@register(sql.rounded(sql.ENRICHED_VIDEOS))
def enrich_videos(spark, folder):
    return rounded(videos(spark, folder))


@register(sql.rounded(sql.ENRICHED_VIDEO_COMMENTS))
def enrich_yt_comments(spark, folder):
    return rounded(video_comments(spark, folder))


@register(sql.rounded(sql.enriched(sql.POST_COMMENTS, "uuid", "content", lexicon=False)))
def enrich_fb_comments_by_model(spark, folder):
    shipped(spark)
    scored = enrich.enrich_post_comments(inputs.comment_messages(spark, folder), letter_scorer())
    return rounded(scored)


_POST_MOOD = f"""
SELECT sentiment_label, count(*) AS records, round(avg(negative), 6) AS mean_negative,
       round(avg(neutral), 6) AS mean_neutral, round(avg(positive), 6) AS mean_positive
FROM ({sql.ENRICHED_POSTS}) GROUP BY sentiment_label"""


@register(_POST_MOOD)
def post_mood(spark, folder):
    """Messages to scores to one line per label."""
    summary = (
        posts(spark, folder, ["sentiment"])
        .groupBy("sentiment_label")
        .agg(
            F.count("*").alias("records"),
            *[F.avg(F.col(x).cast("double")).alias(f"mean_{x}") for x in SENTIMENTS],
        )
    )
    return rounded(summary, *[f"mean_{x}" for x in SENTIMENTS])
