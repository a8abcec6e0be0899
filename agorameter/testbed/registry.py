"""The registry of queries and what they share."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorameter.schemas import SENTIMENTS
from agorameter.session import shipped

Query = Callable[[SparkSession, str], DataFrame]


__all__ = ["Entry", "REGISTRY", "register", "rounded", "shipped"]


class Entry(NamedTuple):
    query: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def register(twin: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def add(query: Query) -> Query:
        REGISTRY[query.__name__] = Entry(query, twin)
        return query

    return add


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six decimals, so that both engines print the same value."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in columns or SENTIMENTS})
