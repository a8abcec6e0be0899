"""Queries on what to collect."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agorameter.functions import text, time
from agorameter.operators import collect, history, normalize, search
from agorameter.plans import links
from agorameter.testbed import inputs, sql
from agorameter.testbed.registry import register

_TILES = """
SELECT o_orderpriority, CAST(n AS INTEGER) AS tile_no,
       strftime(lo + to_days(CAST(n * 10 AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') AS tile_start,
       strftime(least(lo + to_days(CAST(n * 10 + 10 AS INTEGER)), hi), '%Y-%m-%dT%H:%M:%SZ')
         AS tile_end
FROM (SELECT o_orderpriority, lo, hi,
             unnest(range(CAST(ceil(date_diff('day', lo, hi) / 10.0) AS BIGINT))) AS n
      FROM (SELECT o_orderpriority, min(o_orderdate) AS lo, max(o_orderdate) AS hi
            FROM orders GROUP BY 1))"""


@register(_TILES)
def date_tiles(spark, folder):
    """The tiles of each priority's date range."""
    ranges = (
        inputs.table(spark, folder, "orders")
        .groupBy("o_orderpriority")
        .agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    )
    return collect.date_tiles(ranges, "lo", "hi").select(
        "o_orderpriority",
        "tile_no",
        time.utc_string("tile_start").alias("tile_start"),
        time.utc_string("tile_end").alias("tile_end"),
    )


@register(
    """SELECT CAST(floor(date_diff('day', TIMESTAMP '1992-01-01', o_orderdate) / 10.0) AS INTEGER)
                AS tile_no, count(*) AS orders FROM orders GROUP BY 1"""
)
def tile_counts(spark, folder):
    """Orders per tile."""
    start = F.lit("1992-01-01").cast("timestamp_ntz")
    tile = collect.tile_number(F.col("o_orderdate"), start)
    return (
        inputs.table(spark, folder, "orders")
        .groupBy(tile.alias("tile_no"))
        .agg(F.count("*").alias("orders"))
    )


@register(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
       WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'"""
)
def published_between(spark, folder):
    rows = collect.published_between(
        inputs.table(spark, folder, "orders"),
        "o_orderdate",
        F.lit("1996-01-01").cast("timestamp_ntz"),
        F.lit("1997-01-01").cast("timestamp_ntz"),
    )
    return rows.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@register(
    """SELECT doc_id FROM documents
       WHERE contains(lower(text), 'election') OR contains(lower(text), 'wheron')
          OR contains(lower(text), 'c++') OR contains(lower(text), 'êtion')"""
)
def keyword_search(spark, folder):
    found = collect.keyword_search(
        inputs.table(spark, folder, "documents"), "text", "Election|WHERON | c++|ÊTION"
    )
    return found.select("doc_id")


@register("SELECT event_id, ts::VARCHAR IS NOT NULL AS dated FROM events WHERE event_type = 'view'")
def of_type(spark, folder):
    items = inputs.table(spark, folder, "events").withColumnRenamed("event_type", "type")
    return collect.of_type(items, "view").select("event_id", F.col("ts").isNotNull().alias("dated"))


@register(
    """SELECT regexp_replace(url, '[?#].*$', '') AS url, min(page_id) AS page_id
       FROM pages GROUP BY 1"""
)
def dedup_urls(spark, folder):
    """Page addresses without query and anchor, each once."""
    plain = F.regexp_replace("url", r"[?#].*$", "")
    rows = inputs.table(spark, folder, "pages").select(plain.alias("url"), "page_id")
    return collect.first_seen(rows, "url", "page_id")


@register("SELECT sha256(text) AS digest, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def dedup_texts(spark, folder):
    """Exact copies of a text reduced to the first; only digests are shuffled."""
    rows = inputs.table(spark, folder, "documents").select(
        F.sha2("text", 256).alias("digest"), "doc_id"
    )
    return collect.first_seen(rows, "digest", "doc_id")


@register("SELECT 'https://www.youtube.com/watch?v=' || page_id AS url, page_id FROM pages")
def watch_urls(spark, folder):
    video = F.col("page_id").cast("string")
    url = text.watch_url(video).alias("url")
    return inputs.table(spark, folder, "pages").select(url, "page_id")


@register(
    f"""SELECT CAST(floor(date_diff('second', TIMESTAMP '2024-09-11', published) / 864000.0)
                 AS INTEGER) AS tile_no, strftime(published, '%Y-%m-%dT%H:%M:%SZ') AS published, url
        FROM (SELECT {sql.POST_TIME} AS published,
                     'https://www.youtube.com/watch?v=' || doc_id AS url FROM documents
              WHERE lang = 'en' AND source = 'src3'
                AND (contains(lower(text), 'wheron') OR contains(lower(text), 'the')))
        WHERE published >= TIMESTAMP '2024-09-11' AND published < TIMESTAMP '2025-01-20'"""
)
def video_links(spark, folder):
    """documents as search results: English ones are videos, their source is the channel."""
    items = inputs.table(spark, folder, "documents").select(
        F.when(F.col("lang") == "en", "video").otherwise("playlist").alias("type"),
        F.col("source").alias("channel_id"),
        F.col("doc_id").cast("string").alias("video_id"),
        F.col("text").alias("title"),
        inputs.post_time().alias("published"),
    )
    found = links.video_links(items, "2024-09-11", "2025-01-20", "wheron|The", "src3")
    return found.withColumn("published", time.utc_string("published"))


@register("SELECT event_id, event_type, value FROM events ORDER BY ts DESC, event_id")
def newest_first(spark, folder):
    ordered = collect.newest_first(inputs.table(spark, folder, "events"), "ts", "event_id")
    return ordered.select("event_id", "event_type", "value")


@register(
    f"""SELECT id_video, comment_id, comment_votes FROM ({sql.VIDEO_COMMENTS})
        ORDER BY id_video, comment_votes DESC, comment_id"""
)
def popular_first(spark, folder):
    flat = normalize.flatten_comments(inputs.raw_videos(spark, folder))
    ordered = collect.popular_first(flat, "id_video", "comment_votes", "comment_cid")
    return ordered.select("id_video", F.col("comment_cid").alias("comment_id"), "comment_votes")


@register(
    f"""SELECT id_video, comment_id, comment_votes, CAST(place AS INTEGER) AS popularity
        FROM (SELECT *, row_number() OVER (PARTITION BY id_video
                                           ORDER BY comment_votes DESC, comment_id) AS place
              FROM ({sql.VIDEO_COMMENTS})) WHERE place <= 3"""
)
def top_comments(spark, folder):
    flat = normalize.flatten_comments(inputs.raw_videos(spark, folder))
    narrow = flat.select("id_video", F.col("comment_cid").alias("comment_id"), "comment_votes")
    return collect.most_popular(narrow, 3, "id_video", "comment_votes", "comment_id")


@register(
    f"""SELECT id_video, comment_id, comment_votes, popularity FROM (
          SELECT id_video, comment_id, comment_votes, CAST(row_number() OVER (
              PARTITION BY id_video ORDER BY comment_votes DESC, comment_id) AS INTEGER) AS popularity
          FROM ({sql.VIDEO_COMMENTS})) WHERE popularity <= 2000"""
)
def top_comments_deep(spark, folder):
    """More rows per group than Spark bounds before its shuffle by itself."""
    flat = normalize.flatten_comments(inputs.raw_videos(spark, folder))
    narrow = flat.select("id_video", F.col("comment_cid").alias("comment_id"), "comment_votes")
    return collect.most_popular(narrow, 2000, "id_video", "comment_votes", "comment_id")


#: Words of the benchmark's passages stand in for keywords: the first so many in their order.
KEYWORDS = 2000


def _keywords(spark, folder) -> list[str]:
    words = F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("keyword")
    found = inputs.table(spark, folder, "benchmark").select(words).where("length(keyword) >= 4")
    return [r.keyword for r in found.distinct().orderBy("keyword").limit(KEYWORDS).collect()]


@register(
    f"""WITH words AS (
         SELECT DISTINCT keyword FROM (
           SELECT unnest(string_split_regex(lower(text), '[^a-z]+')) AS keyword FROM benchmark)
         WHERE length(keyword) >= 4 ORDER BY keyword LIMIT {KEYWORDS})
       SELECT keyword, count(*) AS documents,
              CAST(sum(strpos(lower(text), keyword) - 1) AS BIGINT) AS first_places
       FROM documents JOIN words ON contains(lower(text), keyword) GROUP BY keyword"""
)
def keyword_hits(spark, folder):
    """Up to 2000 keywords at once: the documents that hold each, and where it stands first."""
    docs = inputs.documents(spark, folder)
    hits = search.keyword_hits(docs, "text", _keywords(spark, folder), ["doc_id"])
    firsts = hits.groupBy("doc_id", "keyword").agg(F.min("start").alias("first"))
    return firsts.groupBy("keyword").agg(
        F.count("*").alias("documents"), F.sum("first").alias("first_places")
    )


_SEARCHES = """
SELECT n_name AS channel, TIMESTAMP '2024-09-01' + to_days(CAST(n_nationkey % 9 AS INTEGER)) AS lo,
       TIMESTAMP '2024-10-05' + to_days(CAST(n_nationkey * 4 AS INTEGER)) AS hi FROM nation
UNION ALL SELECT n_name, TIMESTAMP '2024-12-01 06:30:00', TIMESTAMP '2024-12-20' FROM nation WHERE n_nationkey % 2 = 0"""


def _searches(spark, folder):
    nation = inputs.table(spark, folder, "nation")
    key = F.col("n_nationkey").cast("int")

    def at(day: str) -> Column:
        return F.lit(day).cast("timestamp")

    first = nation.select(
        F.col("n_name").alias("channel"),
        F.make_interval(days=key % 9).alias("_after"),
        F.make_interval(days=key * 4).alias("_until"),
    ).select(
        "channel",
        (at("2024-09-01") + F.col("_after")).alias("start"),
        (at("2024-10-05") + F.col("_until")).alias("end"),
    )
    again = nation.where(key % 2 == 0).select(
        F.col("n_name").alias("channel"),
        at("2024-12-01 06:30:00").alias("start"),
        at("2024-12-20").alias("end"),
    )
    return first.unionByName(again)


@register(
    f"""SELECT v.channel, id_video, CAST(n AS INTEGER) AS tile_no,
               strftime(lo + to_days(CAST(n * 10 AS INTEGER)), '{sql.ISO}') AS tile_start,
               strftime(least(lo + to_days(CAST(n * 10 + 10 AS INTEGER)), hi), '{sql.ISO}') AS tile_end
        FROM ({sql.VIDEOS}) v JOIN ({_SEARCHES}) s ON s.channel = v.channel, unnest(range(20)) AS t(n)
        WHERE CAST(v.timestamp AS TIMESTAMP) >= lo + to_days(CAST(n * 10 AS INTEGER))
          AND CAST(v.timestamp AS TIMESTAMP) < least(lo + to_days(CAST(n * 10 + 10 AS INTEGER)), hi)"""
)
def tile_assignments(spark, folder):
    """Videos in the search tiles of their channels, each channel with ranges of its own."""
    videos = inputs.raw_videos(spark, folder).select(
        "channel", "id_video", time.event_time("timestamp").alias("published")
    )
    placed = search.assign_tiles(videos, _searches(spark, folder))
    return placed.select(
        "channel",
        "id_video",
        "tile_no",
        time.iso_string("tile_start").alias("tile_start"),
        time.iso_string("tile_end").alias("tile_end"),
    )


@register(
    """SELECT DISTINCT regexp_replace(url, '[?#].*$', '') AS url FROM pages
       WHERE regexp_replace(url, '[?#].*$', '') NOT IN (
           SELECT regexp_replace(url, '[?#].*$', '') FROM pages WHERE page_id % 3 <> 0)
       UNION SELECT 'https://www.youtube.com/watch?v=' || doc_id FROM documents WHERE doc_id % 3 = 0"""
)
def new_links(spark, folder):
    """Addresses of pages and videos that were not collected before."""
    pages = inputs.table(spark, folder, "pages").select(
        F.regexp_replace("url", r"[?#].*$", "").alias("url"), "page_id"
    )
    docs = inputs.table(spark, folder, "documents").select(
        text.watch_url(F.col("doc_id").cast("string")).alias("url"), F.col("doc_id").alias("page_id")
    )
    links = pages.unionByName(docs)
    known = links.where(F.col("page_id") % 3 != 0)
    return history.new_links(links.select("url"), known.select("url"))
