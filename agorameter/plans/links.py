"""Search results to the list of videos to collect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorameter.functions.text import watch_url
from agorameter.operators.collect import (
    keyword_search,
    of_type,
    published_between,
    tile_number,
)
from agorameter.schemas import KEYWORDS, TILE_DAYS


def video_links(
    items: DataFrame,
    start: str,
    end: str,
    query: str = KEYWORDS,
    channel: str | None = None,
    days: int = TILE_DAYS,
) -> DataFrame:
    """Addresses of a channel's videos on a topic: ``tile_no``, ``published``, ``url``.

    ``items`` has ``type``, ``channel_id``, ``video_id``, ``title`` and the time
    ``published``. Every address comes once; the order is by search tile, newest first
    within a tile.
    """
    lo, hi = (F.lit(t).cast(items.schema["published"].dataType) for t in (start, end))
    found = keyword_search(
        of_type(published_between(items, "published", lo, hi), "video", channel), "title", query
    )
    once = found.groupBy(watch_url(F.col("video_id")).alias("url")).agg(
        F.min("published").alias("published")
    )
    tiles = once.select(
        tile_number(F.col("published"), lo, days).alias("tile_no"), "published", "url"
    )
    return tiles.orderBy("tile_no", F.desc("published"), "url")
