"""Benchmark the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and prints
ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.

Each query is executed in full with the ``noop`` sink (every row is produced, nothing
is collected to the driver). One untimed warm-up query runs first (JVM start,
codegen caches); each query is then timed once.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from vendorlens.plans import tables as tb  # noqa: E402
from vendorlens.plans.registry import all_queries  # noqa: E402
from vendorlens.session import get_spark  # noqa: E402

# headline queries: the build chain, the notebook chain and the analysis hot spots
HEADLINE = [
    "T1_vendor_sales_summary", "T2_vendor_sales_summary_replicated", "T4a_vendor_rollup", "T9_vendor_risk_summary",
    "T13a_final_all", "T13b_final_all_replicated", "Q5_describe", "A13_purchase_pareto", "A19_action_scorecard",
    "D3_spearman_brand", "H6_bootstrap_diff_ci", "H7_permutation_test",
]


def t1_margin_buckets(spark, d):
    v = tb.vss(spark, d)
    return v.agg(F.count_if(F.col("ProfitMargin") < 10).alias("margin_lt_10"),
                 F.count_if(F.col("ProfitMargin") < 35).alias("margin_lt_35"),
                 F.count_if(F.col("GrossProfit") < 0).alias("gp_negative"),
                 F.count_if(F.col("FreightCost") == 0).alias("freight_zero"))


def t1_totals(spark, d):
    v = tb.vss(spark, d)
    return v.agg(*[F.sum(c).alias(c) for c in ["TotalSalesDollars", "TotalPurchaseDollars", "FreightCost",
                                                "GrossProfit"]])


def e1_build(spark, d):
    """E1 end to end: the nine build tables written (T1 once) under a fresh shared folder."""
    import uuid
    from vendorlens.plans.build import build_final_tables
    from vendorlens.session import checkpoint_dir
    root = f"{checkpoint_dir(spark).rstrip('/')}/bench-{uuid.uuid4().hex[:8]}"
    return build_final_tables(spark, tb.base(spark, d), out_dir=root)["final_all"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", int(cpus))
    qs = all_queries()
    work = [(n, qs[n].run) for n in HEADLINE if n in qs]
    work += [("t1_margin_buckets", t1_margin_buckets), ("t1_totals", t1_totals), ("E1_build_final_tables", e1_build)]
    run(tb.vss(spark, sf_dir))  # warm-up
    times = {}
    for name, fn in work:
        t0 = time.perf_counter()
        run(fn(spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
