"""Messages to enriched records.

Each function is a chain of projections without any shuffle, so it runs unchanged on a
batch or on a stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorameter.functions.lexicon import default_scorer
from agorameter.functions.scoring import Scorer, score_text
from agorameter.functions.text import chunk_text, expand_once
from agorameter.operators.messages import parse_messages, select_renamed
from agorameter.schemas import (
    CHUNK_SIZE,
    POST_COMMENTS,
    POSTS,
    VIDEO_COMMENTS,
    VIDEOS,
    Dataset,
    with_long_counts,
)


def score_records(
    records: DataFrame,
    dataset: Dataset,
    scorer: Scorer | None = None,
    chunk_size: int = CHUNK_SIZE,
    errors: bool = False,
    kinds: Sequence[str] | None = None,
) -> DataFrame:
    """Parsed records with the dataset's output columns; ``errors`` adds ``score_error``.

    The scored text stays only where it is an output column. ``kinds`` limits the scores to
    ``sentiment`` or ``emotion``, for a report that reads only these.
    """
    own = ("sentiment", "emotion") if dataset.emotion else ("sentiment",)
    kinds = own if kinds is None else tuple(kinds)
    if set(kinds) - set(own):
        raise ValueError(f"{dataset.name} has scores of {own}")
    scores = score_text(dataset.text, scorer or default_scorer(), kinds, chunk_size, errors)
    text = () if dataset.text in dataset.columns else (dataset.text,)
    selected = select_renamed(records, dataset.columns + text, dict(dataset.renames))
    return selected.select(*dataset.columns, expand_once(scores))


def enrich(
    messages: DataFrame,
    dataset: Dataset,
    scorer: Scorer | None = None,
    chunk_size: int = CHUNK_SIZE,
    errors: bool = False,
    long_counts: bool = False,
    kinds: Sequence[str] | None = None,
) -> DataFrame:
    """Messages with a ``value`` column to the dataset's enriched records.

    ``long_counts`` reads counters as 64-bit integers instead of losing large ones.
    """
    schema = with_long_counts(dataset.message) if long_counts else dataset.message
    records = parse_messages(messages, schema)
    return score_records(records, dataset, scorer, chunk_size, errors, kinds)


def enrich_posts(messages: DataFrame, scorer: Scorer | None = None, **options) -> DataFrame:
    return enrich(messages, POSTS, scorer, **options)


def enrich_post_comments(messages: DataFrame, scorer: Scorer | None = None, **options) -> DataFrame:
    return enrich(messages, POST_COMMENTS, scorer, **options)


def enrich_videos(messages: DataFrame, scorer: Scorer | None = None, **options) -> DataFrame:
    """Sentiment of the transcript, which is left out of the result."""
    return enrich(messages, VIDEOS, scorer, **options)


def enrich_video_comments(
    messages: DataFrame, scorer: Scorer | None = None, **options
) -> DataFrame:
    return enrich(messages, VIDEO_COMMENTS, scorer, **options)


def chunk_table(df: DataFrame, key: str, text: str, size: int = CHUNK_SIZE) -> DataFrame:
    """One row per chunk: key, ``chunk_no`` from 0, ``chunk``."""
    return df.select(key, F.posexplode(chunk_text(text, size)).alias("chunk_no", "chunk"))
