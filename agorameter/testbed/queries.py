"""All registered queries; importing this module fills the registry."""

from __future__ import annotations

from agorameter.testbed import (  # noqa: F401
    collect_queries,
    enrich_queries,
    file_queries,
    message_queries,
    record_queries,
    report_queries,
    route_queries,
    score_queries,
    stream_queries,
)
from agorameter.testbed.registry import REGISTRY

__all__ = ["REGISTRY"]
