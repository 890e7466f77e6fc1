"""Marts on hand-built fixtures and invariants on the smoke data."""

import datetime as dt

import pytest
from decimal import Decimal

from pyspark.sql import functions as F

from paymart.operators import marts
from paymart.plans.warehouse import Warehouse
from paymart.sources import schemas

AS_OF = dt.date(2025, 7, 1)


def tx(i, user, merchant, ts, status="success", fraud=False, amount="100.00", cat="Retail"):
    return (f"T{i:05d}", user, merchant, cat, "UPI", Decimal(amount), "INR", status, fraud, "mobile", None, None,
            ts, dt.datetime(2025, 7, 1))


def warehouse(spark, txs, users=None, merchants=None):
    users = users or [(u, "18-25", "savings", dt.date(2024, 1, 1), None, None)
                      for u in sorted({t[1] for t in txs})]
    merchants = merchants or [(m, f"name {m}", "Retail", None, None, dt.date(2023, 1, 1))
                              for m in sorted({t[2] for t in txs})]
    raw = {"transactions": spark.createDataFrame(txs, schemas.TRANSACTIONS),
           "users": spark.createDataFrame(users, schemas.USERS),
           "merchants": spark.createDataFrame(merchants, schemas.MERCHANTS)}
    return Warehouse(spark, raw, as_of=AS_OF)


def test_merchant_tiers_and_volume_guardrail(spark):
    base = dt.datetime(2024, 2, 1)
    txs = [tx(i, f"U{i % 7}", "M49", base + dt.timedelta(days=i)) for i in range(49)]
    txs += [tx(100 + i, f"U{i % 7}", "M50", base + dt.timedelta(days=i), fraud=(i < 3)) for i in range(50)]
    merchants = [(m, m, "Retail", None, None, dt.date(2023, 1, 1)) for m in ("M49", "M50", "IDLE")]
    wh = warehouse(spark, txs, merchants=merchants)
    got = {r.merchant_id: r for r in wh.merchant_risk_profiling().collect()}
    assert got["IDLE"].merchant_risk_category == "No Activity" and got["IDLE"].total_transactions == 0
    assert got["IDLE"].avg_ticket_size is None and got["IDLE"].fraud_transactions == 0
    assert got["M49"].merchant_risk_category == "Insufficient Volume" and got["M49"].fraud_rate_pct is None
    assert got["M50"].fraud_rate_pct == 6.0 and got["M50"].merchant_risk_category == "High Risk"
    assert got["M50"].is_rate_reliable and got["M50"].customer_tx_ratio == 0.14


def test_recency_counts_whole_days(spark):
    anchor = dt.datetime(2024, 6, 30, 12)
    txs = [tx(0, "A", "M", anchor), tx(1, "B", "M", anchor - dt.timedelta(days=7)),
           tx(2, "C", "M", anchor - dt.timedelta(days=7, hours=23)), tx(3, "D", "M", anchor - dt.timedelta(days=8))]
    got = {r.user_id: (r.recency_days, r.recency_segment) for r in warehouse(spark, txs).fraud_customer_segments().collect()}
    assert got == {"A": (0, "Active"), "B": (7, "Active"), "C": (7, "Active"), "D": (8, "Recent")}


def test_cohort_rules(spark):
    m = lambda y, mo, d=10: dt.datetime(y, mo, d, 12)
    txs = [
        tx(0, "never", "M", m(2024, 1), status="failed"),           # never succeeds: no cohort
        tx(1, "late", "M", m(2024, 1), status="failed"),            # failed before first success
        tx(2, "late", "M", m(2024, 2)),                              # cohort Feb
        tx(3, "late", "M", m(2024, 3)),                              # retained at month 1
        tx(4, "fresh", "M", m(2024, 6)),                             # cohort = anchor month: immature
    ]
    rows = {r.cohort_month.month: r for r in warehouse(spark, txs).cohort_analysis().collect()}
    assert set(rows) == {2, 6}
    feb, jun = rows[2], rows[6]
    assert feb.cohort_size == 1 and feb.total_transactions == 2        # the January failure is excluded
    assert feb.retention_1m_pct == 100.0 and feb.retention_3m_pct == 0.0 and feb.retention_6m_pct is None
    assert feb.mature_3m_cohort_size == 1 and feb.mature_6m_cohort_size == 0
    assert jun.retention_1m_pct is None and jun.mature_1m_cohort_size == 0


def test_same_name_merchants_merge_in_top_loss(spark):
    base = dt.datetime(2024, 2, 1)
    txs = [tx(i, "U", "M1" if i % 2 else "M2", base + dt.timedelta(hours=i), fraud=(i % 10 == 0))
           for i in range(120)]
    merchants = [("M1", "Same Name", "Travel", None, None, dt.date(2023, 1, 1)),
                 ("M2", "Same Name", "Travel", None, None, dt.date(2023, 1, 1))]
    from paymart.operators import dashboard
    wh = warehouse(spark, txs, merchants=merchants)
    out = dashboard.top_merchants_by_fraud_loss(wh.fct, wh.dim_merchants).collect()
    assert len(out) == 1 and out[0].merchant_name == "Same Name" and float(out[0].fraud_loss_inr) == 1200.0


def test_orphans_kept_in_fact_dropped_in_segments(spark):
    txs = [tx(0, "KNOWN", "M", dt.datetime(2024, 2, 1)), tx(1, "GHOST", "M", dt.datetime(2024, 2, 2))]
    users = [("KNOWN", "18-25", "savings", dt.date(2024, 1, 1), None, None)]
    wh = warehouse(spark, txs, users=users)
    assert wh.fct.where(F.col("user_sk").isNull()).count() == 1
    assert [r.user_id for r in wh.fraud_customer_segments().collect()] == ["KNOWN"]


def test_invariants_on_smoke_data(wh_small):
    n = wh_small.fct.count()
    assert wh_small.hourly_fraud_trends().agg(F.sum("total_transactions")).first()[0] == n
    prof = wh_small.merchant_risk_profiling().agg(F.sum("total_transactions")).first()[0]
    orphans = wh_small.fct.where(F.col("merchant_sk").isNull()).count()
    assert prof + orphans == n
    bad = wh_small.cohort_analysis().where(
        (F.col("mature_1m_cohort_size") > F.col("cohort_size")) | (F.col("mature_6m_cohort_size") > F.col("mature_3m_cohort_size"))
        | (F.col("retention_1m_pct") > 100)).count()
    assert bad == 0
    levels = wh_small.enriched.select("fraud_risk_score", "fraud_risk_level").distinct().collect()
    for r in levels:
        assert (r.fraud_risk_level == "critical") == (r.fraud_risk_score >= 70)
    q = wh_small.velocity_anomaly_detection()
    assert q.where(F.col("is_critical") & (F.col("velocity_alert_level") != "Critical")).count() == 0
    assert q.where((F.col("velocity_score") < 0) | (F.col("velocity_score") > 100)).count() == 0


def test_velocity_score_decimal_arithmetic(spark):
    row = dict(tx_count_1h=9, tx_count_24h=17, tx_same_category_24h=8, is_high_amount=True, is_odd_hour=False,
               fraud_risk_score=55)
    df = spark.createDataFrame([tuple(row.values())], ", ".join(
        f"{k} {'boolean' if k.startswith('is_') else 'int'}" for k in row))
    from paymart.functions import velocity
    h = df.select(velocity.velocity_score_hundredths().alias("h")).first().h
    # 30 (capped 1h) + 9.0 (24h: 5 * 1.8) + 7.5 (cat: 3 * 2.5) + 12 + 0 + 6.6 (55 * 0.12) = 65.10
    assert h == 6510


def test_queue_amount_edge_is_strict(spark):
    # High needs amount > 30000 together with a category burst
    base = dt.datetime(2024, 3, 1, 12)
    txs = [tx(i, "U", "M", base + dt.timedelta(minutes=90 * i), amount="30000.00" if i == 9 else "30000.01")
           for i in range(10)]
    q = {r.transaction_id: r for r in warehouse(spark, txs).velocity_anomaly_detection().collect()}
    assert q["T00009"].tx_same_category_24h == 10 and q["T00008"].tx_same_category_24h == 9
    assert q["T00009"].velocity_alert_level != "High" or q["T00009"].velocity_score >= 48


def test_build_writes_every_table(spark, tmp_root):
    from paymart.sources import tables
    wh = Warehouse.from_driver_tables(spark, "/root/testdata/sf0.001")
    out = wh.build(f"{tmp_root}/wh")
    assert len(out) == 13
    fct = tables.read_table(spark, f"{tmp_root}/wh", "marts", "fct_transactions")
    assert fct.count() == wh.enriched.count()
    with pytest.raises(LookupError):
        tables.read_table(spark, f"{tmp_root}/wh", "marts", "nothing")
    ordered = marts.for_sink("daily_overview_kpis", wh.daily_overview_kpis()).collect()
    assert [r.day for r in ordered] == sorted(r.day for r in ordered)


def test_rank_is_the_place_in_the_whole_order(spark):
    from paymart.operators.ordering import with_rank
    rows = [(i, (i * 37) % 10 if i % 7 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(9)
    got = {r.k: r.rank for r in with_rank(df, [("v", False), ("k", True)]).collect()}
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert got == {k: n for n, (k, _) in enumerate(want, 1)}
    assert with_rank(df.limit(0), [("k", True)]).isEmpty()


def test_distinct_counts_with_nulls(spark):
    from paymart.operators.distincts import with_distinct_counts
    rows = [("a", 1, "x"), ("a", 1, "y"), ("a", None, "y"), (None, 2, None), (None, None, None), ("b", None, None)]
    df = spark.createDataFrame(rows, "g string, i int, j string")
    out = with_distinct_counts(df, ["g"], {"n_i": "i", "n_j": "j"}, {"_n": F.count(F.lit(1))}, {"n": F.sum("_n")})
    assert {r.g: (r.n, r.n_i, r.n_j) for r in out.collect()} == {"a": (3, 1, 2), None: (2, 1, 0), "b": (1, 0, 0)}
    assert with_distinct_counts(df.limit(0), [], {"n_i": "i", "n_j": "j"}, {"_n": F.count(F.lit(1))}, {"n": F.sum("_n")}).first().n_i == 0


def test_broadcast_only_below_bound(spark):
    from paymart.operators.joins import broadcast_if_small
    big = spark.range(1000).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")

    def plan(df):
        import contextlib
        import io
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        return buf.getvalue()

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(big.join(broadcast_if_small(small, 10), "k"))
        assert "BroadcastHashJoin" not in plan(big.join(broadcast_if_small(small, 9), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fact_keys_via_orphans_equal_joins(spark, wh_small):
    from paymart.operators import facts
    txs = [tx(0, "KNOWN", "M", dt.datetime(2024, 2, 1)), tx(1, "GHOST", "M", dt.datetime(2024, 2, 2)),
           tx(2, "KNOWN", "NOWHERE", dt.datetime(2024, 2, 3))]
    users = [("KNOWN", "18-25", "savings", dt.date(2024, 1, 1), None, None)]
    merchants = [("M", "m", "Retail", None, None, dt.date(2023, 1, 1))]
    small = warehouse(spark, txs, users=users, merchants=merchants)
    for w in (small, wh_small):
        a = facts.fct_transactions(w.enriched, w.dim_users, w.dim_merchants, keys_from_hash=True)
        b = facts.fct_transactions(w.enriched, w.dim_users, w.dim_merchants, keys_from_hash=False)
        c = facts.fct_transactions(w.enriched, w.dim_users, w.dim_merchants, max_broadcast_rows=0,
                                   keys_from_hash=True)   # orphan set joined without a broadcast
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and c.exceptAll(b).count() == 0
    got = {r.transaction_id: (r.user_sk is None, r.merchant_sk is None) for r in small.fct.collect()}
    assert got == {"T00000": (False, False), "T00001": (True, False), "T00002": (False, True)}
