"""Physical-plan checks: no cartesian products anywhere, scans pruned and filtered."""

import pytest

from vendorlens.plans import tables as tb
from vendorlens.plans.registry import all_queries

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_cartesian_product(spark, sf_dir, name):
    plan = _plan(all_queries()[name].run(spark, sf_dir))
    assert not any(b in plan for b in BAD), plan[:2000]


def test_t1_scans_are_pruned_and_filtered(spark, sf_dir):
    plan = _plan(tb.vss(spark, sf_dir))
    assert "PushedFilters: [IsNotNull(l_linestatus)" in plan or "EqualTo(l_linestatus" in plan
    assert "l_shipdate" not in plan and "l_returnflag" not in plan     # unused columns never read
