"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from agorameter.testbed.queries import REGISTRY
from tests.conftest import plan_of
from tools.compare import compare, connect

#: The queries of the training-data operators have tests of their own.
QUERIES = {name: entry.query for name, entry in REGISTRY.items()}
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    assert compare(spark, connection, FOLDER, name) is None


def test_every_query_has_a_twin():
    assert all(entry.sql for entry in REGISTRY.values())


def test_entry(spark):
    rows = entry(spark).collect()
    assert sum(r.records for r in rows) == 200


BATCH = [
    name
    for name in QUERIES
    if not name.startswith(("stream_", "incremental_")) and not name.endswith("_files")
]


@pytest.mark.parametrize("name", BATCH)
def test_plan(spark, name):
    """No pairs of all rows, no row-at-a-time Python, no single-partition collection of rows."""
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "collect_list" not in plan
    assert "SinglePartition" not in plan and "RoundRobin" not in plan


@pytest.mark.parametrize("name", [n for n in BATCH if n.startswith(("enrich_", "sentiment_d"))])
def test_enrichment_has_no_shuffle(spark, name):
    """Apart from the small channel table, whose rows are reduced to one per channel."""
    plan = plan_of(QUERIES[name](spark, FOLDER))
    shuffles = [i for i, line in enumerate(plan.splitlines()) if "+- Exchange" in line]
    for i in shuffles:
        below = plan.splitlines()[i + 1]
        assert "key=[channel#" in below and "partial_min(struct(" in below, below


def test_reports_score_what_they_read(spark):
    def words(name):
        return plan_of(QUERIES[name](spark, FOLDER))

    assert "anticipation" not in words("sentiment_share").replace("emotion_label", "")
    assert "negative" not in words("emotion_share")
    for name in ("orphan_comments", "comment_mood"):
        assert words(name).count("from_json") <= 2, "once for each kind of message"
