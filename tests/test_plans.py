"""Plan-shape guards: one scan per query, top-k limited before the rank shuffle."""

import re

import pytest

from windtally.plans.catalog import QUERIES

from conftest import SF_SMALL

BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


@pytest.mark.parametrize("name", BATCH)
def test_single_scan_and_pruned(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1, plan
    schema = re.search(r"ReadSchema: struct<([^>\n]*)", plan).group(1)
    assert "props" not in schema  # never read the unused JSON payload column of events


@pytest.mark.parametrize("name", [n for n in BATCH if n.startswith(("rank_", "stream_rank"))])
def test_rank_limit_before_shuffle(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    partial = [i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Partial" in l]
    assert partial, plan
    # the partial limit sits below (after, in tree text) the rank exchange on window_start
    ex = [i for i, l in enumerate(lines) if "Exchange hashpartitioning(window_start" in l]
    assert ex and min(ex) < min(partial), plan
