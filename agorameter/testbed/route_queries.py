"""Queries on routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from agorameter.operators import route
from agorameter.testbed import inputs, sql
from agorameter.testbed.registry import register


@register(f"SELECT event_id, topic FROM ({sql.EVENT_ROUTES}) WHERE topic IS NOT NULL")
def route_messages(spark, folder):
    routed = route.routed(route.route_messages(inputs.event_messages(spark, folder)))
    return routed.select("event_id", "topic")


@register(
    f"""SELECT event_id, CASE WHEN social IS NULL THEN 'untagged'
                              WHEN social = 'elsewhere' THEN 'unknown platform'
                              ELSE 'no branch' END AS reject_reason
        FROM ({sql.EVENT_ROUTES}) WHERE topic IS NULL"""
)
def route_rejects(spark, folder):
    rejected = route.rejected(route.route_messages(inputs.event_messages(spark, folder)))
    return rejected.select("event_id", "reject_reason")


@register(
    f"""SELECT topic, count(*) AS records, CAST(sum(event_id) AS BIGINT) AS ids
        FROM ({sql.EVENT_ROUTES}) GROUP BY topic"""
)
def route_records(spark, folder):
    """Typed records, counted per topic; the rejected ones have no topic."""
    return (
        route.with_route(inputs.tagged_events(spark, folder))
        .groupBy("topic")
        .agg(F.count("*").alias("records"), F.sum("event_id").alias("ids"))
    )
