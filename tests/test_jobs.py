"""How many Spark jobs a query may start, whatever the data size. Adaptive execution counts each shuffle as a job."""

from __future__ import annotations

import pytest

from starloom.registry import QUERIES

MOST = {"star_silver": 36, "star_top5": 34, "silver_batch": 30, "claims_fact": 29, "fact_keys": 25, "dim_member": 23, "dim_region": 14}


@pytest.mark.parametrize("name", list(MOST))
def test_few_jobs(spark, name):
    started = lambda: spark._jsc.sc().dagScheduler().numTotalJobs()
    before = started()
    QUERIES[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    assert started() - before <= MOST[name]


def test_keys_are_numbered_without_a_window_over_all_rows(spark):
    for name in ("dim_region", "dim_member", "surrogate_keys", "first_seen_keys"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert "Window" not in plan
