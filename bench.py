"""Benchmark: the warehouse build and its heavy marts at one scale factor.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1) and
prints one JSON line.  Each timing forces full execution with the ``noop``
sink (no collect, no output files):

* ``build_enriched`` - adapter + staging + velocity windows + scoring,
  written once as Parquet under the checkpoint folder (the materialised
  layer every later mart reads);
* ``build_fct`` - star-schema fact (joins with both dimensions), materialised;
* one entry per mart / analysis over the materialised layers;
* ``registry_*`` - selected registered queries exactly as the correctness
  check calls them (``queries()[name](spark, sf_dir)``); the first one that
  needs the enriched layer materialises the session's shared warehouse.

``value`` is the production path (build + marts).  The ``registry_*``
timings rebuild the session's shared warehouse and are reported separately
as ``registry_sec``.  Before timing, the same suite runs once on the
smallest tables to warm the JVM (JIT, codegen cache); that time is reported
as ``warmup_sec``.  Neither is part of ``value``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from paymart.session import local_session
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="paymart-bench", driver_memory="16g")

    from paymart.operators import dashboard, eda, kpis
    from paymart.plans.catalog import load_all
    from paymart.plans.warehouse import Warehouse

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        fn()
        timings[name] = round(time.perf_counter() - t, 3)

    def suite(wh, timed_fn):
        timed_fn("build_enriched", lambda: wh.enriched)
        timed_fn("build_fct", lambda: wh.fct)
        for name in ("hourly_fraud_trends", "velocity_anomaly_detection", "merchant_risk_profiling",
                     "fraud_customer_segments", "cohort_analysis", "daily_overview_kpis", "daily_merchant_kpis",
                     "user_metrics", "fraud_analysis_mart"):
            timed_fn(name, lambda n=name: run(getattr(wh, n)()))
        timed_fn("kpi_monthly_mom", lambda: run(kpis.kpi_monthly_mom(wh.fct)))
        timed_fn("monthly_risk_report",
                 lambda: run(dashboard.monthly_risk_report(wh.fct, wh.velocity_anomaly_detection())))
        timed_fn("eda_cohort_matrix", lambda: run(eda.eda_cohort_matrix(wh.eda_frame())))
        timed_fn("fraud_loss_tertiles", lambda: run(eda.fraud_loss_tertiles(wh.eda_frame())))

    # warm-up (JIT, codegen caches, file listing): the same suite once on the
    # smallest tables, reported separately and not part of the total
    smoke = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    t0 = time.perf_counter()
    if os.path.isdir(smoke):
        suite(Warehouse.from_driver_tables(spark, smoke, materialize=True), lambda _n, fn: fn())
    warmup = round(time.perf_counter() - t0, 3)

    wh = Warehouse.from_driver_tables(spark, sf_dir, materialize=True)
    suite(wh, timed)
    registry = load_all()
    for name in ("velocity_counts", "cohort_analysis", "merchant_risk_profiling"):
        timed(f"registry_{name}", lambda n=name: run(registry[n](spark, sf_dir)))

    rows = wh.fct.count()
    total = round(sum(v for k, v in timings.items() if not k.startswith("registry_")), 3)
    registry_total = round(sum(v for k, v in timings.items() if k.startswith("registry_")), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "warehouse_build_and_marts_total", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": int(cpus), "transactions": rows,
                      "warmup_sec": warmup, "registry_sec": registry_total,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
