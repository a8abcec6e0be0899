"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agorameter.schemas import CHUNK_SIZE, WATCH_URL


def chunk_text(text: str, size: int = CHUNK_SIZE) -> Column:
    """Consecutive slices of ``size`` code points; the last may be short.

    ``text`` is a column name or an SQL expression. Empty text has no chunk, NULL text
    gives NULL.
    """
    return F.expr(chunk_sql(text, size))


def chunk_sql(text: str, size: int = CHUNK_SIZE) -> str:
    """``chunk_text`` as SQL text.

    One greedy match per slice reads the text once, where repeated ``substring`` would
    rescan it for every slice.
    """
    if size < 1:
        raise ValueError("size must be positive")
    return f"regexp_extract_all({text}, '(?s).{{1,{int(size)}}}', 0)"


def transcript(segments: Column | str) -> Column:
    """Lower-cased segment texts joined by one space, from an array of structs."""
    return F.array_join(F.transform(segments, lambda s: F.lower(s["text"])), " ")


def parse_votes(votes: Column | str) -> Column:
    """Vote counter as 64-bit integer; missing, empty or unreadable values count as 0."""
    return F.coalesce(_column(votes).cast("string").try_cast("long"), F.lit(0))


def watch_url(video_id: Column | str) -> Column:
    """Public address of a video."""
    return F.concat(F.lit(WATCH_URL), video_id)


def strip_whitespace(text: Column | str) -> Column:
    """Remove blanks, tabs and line ends on both sides."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def expand_once(struct: Column) -> Column:
    """The fields of a struct as columns, for ``select``.

    A later filter on the fields stays above this step. Behind ``struct.*`` the optimizer
    would move it below and compute the struct a second time, or once per condition.
    """
    return F.inline(F.array(struct))


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
