"""Plan-shape guards: the scale decisions, checked on the physical plans."""

import contextlib
import io

import pytest


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def scans_of(text: str, column: str) -> list[str]:
    return [line for line in text.splitlines() if "FileScan parquet [" in line and f"{column}#" in line]


def ran(df) -> str:
    """The plan that ran, without the initial plans beside it (also those of subqueries)."""
    df.collect()
    kept, skip = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth > skip:
            continue
        skip = depth - 3 if "== Initial Plan ==" in line else None
        kept.append(line)
    return "\n".join(kept)


@pytest.fixture(scope="module")
def wh(spark):
    from paymart.plans.warehouse import Warehouse
    w = Warehouse.from_driver_tables(spark, "/root/testdata/sf0.001", materialize=True)
    w.fct
    return w


def test_velocity_queue_is_a_pushed_filter(wh):
    p = plan(wh.velocity_anomaly_detection())
    assert "Exchange" not in p and "PushedFilters: [Or(" in p


def test_no_row_is_expanded_for_distinct_counts(wh):
    from paymart.operators import kpis
    for df in (wh.cohort_analysis(), wh.user_metrics(), wh.daily_overview_kpis(), kpis.kpi_activity(wh.fct)):
        assert "Expand" not in plan(df)


@pytest.mark.parametrize("mart", ["fraud_customer_segments", "cohort_analysis"])
def test_anchor_and_mart_share_one_fact_scan(wh, mart):
    p = ran(getattr(wh, mart)())
    assert len(scans_of(p, "transaction_ts")) == 1 and "ReusedExchange" in p


def test_orphans_read_both_id_columns_once(spark, wh):
    from paymart.operators import facts
    scans = []
    real = facts.orphan_ids

    def once(*args):
        scans.append(1)
        return real(*args)

    facts.orphan_ids = once
    try:
        p = plan(facts.fct_transactions(wh.enriched, wh.dim_users, wh.dim_merchants, keys_from_hash=True))
    finally:
        facts.orphan_ids = real
    assert len(scans) == 1 and len(scans_of(p, "user_id")) == 1 and len(scans_of(p, "kind")) == 2


def test_marts_read_only_needed_columns(wh):
    p = plan(wh.hourly_fraud_trends())
    assert "fraud_reason" not in p.split("ReadSchema:")[1].split("\n")[0]


def test_top_k_is_take_ordered(wh):
    from paymart.operators import dashboard
    assert "TakeOrderedAndProject" in plan(dashboard.top_velocity_users(wh.velocity_anomaly_detection()))


def test_no_cartesian_products(wh):
    for df in (wh.fraud_customer_segments(), wh.cohort_analysis(), wh.merchant_risk_profiling()):
        p = plan(df)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_fact_build_does_not_shuffle_rows_against_dimensions(spark, wh):
    from paymart.operators import facts
    p = plan(facts.fct_transactions(wh.enriched, wh.dim_users, wh.dim_merchants, keys_from_hash=True))
    assert "SortMergeJoin" not in p
