"""Trailing-window velocity counts: edge fixtures and brute force."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from paymart.operators.velocity_windows import add_velocity_counts, add_velocity_counts_unsplit

SCHEMA = "transaction_id string, user_id string, merchant_category string, transaction_ts timestamp"
T0 = dt.datetime(2024, 1, 1, 23, 30)


def counts(df):
    return {r.transaction_id: (r.tx_count_1h, r.tx_count_24h, r.tx_same_category_24h) for r in df.collect()}


def test_ties_count_peers(spark):
    df = spark.createDataFrame([("a", "u", "X", T0), ("b", "u", "X", T0)], SCHEMA)
    assert counts(add_velocity_counts(df)) == {"a": (2, 2, 2), "b": (2, 2, 2)}


def test_lower_bound_inclusive_and_microsecond(spark):
    t1 = T0 + dt.timedelta(hours=1)                     # exactly 1 h later (crosses midnight)
    t2 = t1 + dt.timedelta(hours=1, microseconds=1)     # 1 h + 1 us after t1
    df = spark.createDataFrame([("a", "u", "X", T0), ("b", "u", "Y", t1), ("c", "u", "X", t2)], SCHEMA)
    got = counts(add_velocity_counts(df))
    assert got["b"] == (2, 2, 1)
    assert got["c"] == (1, 3, 2)


def brute(rows):
    out = {}
    for tid, u, c, ts in rows:
        n1 = sum(1 for _, u2, _, t2 in rows if u2 == u and ts - dt.timedelta(hours=1) <= t2 <= ts)
        n24 = sum(1 for _, u2, _, t2 in rows if u2 == u and ts - dt.timedelta(hours=24) <= t2 <= ts)
        nc = sum(1 for _, u2, c2, t2 in rows if u2 == u and c2 == c and ts - dt.timedelta(hours=24) <= t2 <= ts)
        out[tid] = (n1, n24, nc)
    return out


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["u1", "u2", "u3"]), st.sampled_from(["X", "Y", None]),
                          st.integers(0, 3 * 86400 * 10 ** 6)), min_size=1, max_size=60))
def test_split_windows_equal_brute_force(spark, items):
    base = dt.datetime(2024, 3, 1)
    # coarse grid so that ties and exact 1 h / 24 h distances occur
    rows = [(str(i), u, c, base + dt.timedelta(microseconds=(us // (900 * 10 ** 6)) * 900 * 10 ** 6))
            for i, (u, c, us) in enumerate(items)]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = brute(rows)
    assert counts(add_velocity_counts(df)) == expected
    assert counts(add_velocity_counts_unsplit(df)) == expected


def test_one_exchange_for_three_windows(wh_small):
    plan = add_velocity_counts(wh_small.stg)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_hot_user_spreads_over_tasks(spark):
    """One user with most of the rows: the (user, bucket) split spreads that
    user over many window tasks instead of one."""
    from pyspark.sql import functions as F
    base = dt.datetime(2024, 5, 1)
    hot = [(f"h{i}", "hot", "X", base + dt.timedelta(minutes=259 * i)) for i in range(1200)]   # ~7 months
    cold = [(f"c{i}", f"u{i % 5}", "Y", base + dt.timedelta(hours=5 * i)) for i in range(100)]
    df = spark.createDataFrame(hot + cold, SCHEMA)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")   # keep the hash partitions as planned
    try:
        out = add_velocity_counts(df).where(F.col("user_id") == "hot").groupBy(
            F.spark_partition_id().alias("p")).count()
        per_task = [r["count"] for r in out.collect()]
    finally:
        spark.conf.set(key, "true")
    assert sum(per_task) == 1200
    assert len(per_task) >= 4 and max(per_task) < 0.5 * 1200


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["u1", "u2", "u3"]), st.sampled_from(["X", "Y", None]),
                          st.integers(0, 3 * 86400 * 10 ** 6)), min_size=1, max_size=60))
def test_tiered_counts_equal_brute_force(spark, items):
    from paymart.operators.velocity_windows import add_velocity_counts_tiered
    base = dt.datetime(2024, 3, 1)
    rows = [(str(i), u, c, base + dt.timedelta(microseconds=(us // (900 * 10 ** 6)) * 900 * 10 ** 6))
            for i, (u, c, us) in enumerate(items)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert counts(add_velocity_counts_tiered(df)) == brute(rows)


def test_tiered_edges(spark):
    from paymart.operators.velocity_windows import add_velocity_counts_tiered
    t1 = T0 + dt.timedelta(hours=1)
    t2 = t1 + dt.timedelta(hours=1, microseconds=1)
    df = spark.createDataFrame([("a", "u", "X", T0), ("b", "u", "Y", t1), ("c", "u", "X", t2), ("d", "u", "X", t2)],
                               SCHEMA)
    got = counts(add_velocity_counts_tiered(df))
    assert got == {"a": (1, 1, 1), "b": (2, 2, 1), "c": (2, 4, 3), "d": (2, 4, 3)}


def test_busy_users_are_counted_by_bounded_windows(spark):
    from dataclasses import replace
    from paymart.config import DEFAULT
    from paymart.operators.velocity_windows import hot_users, velocity_counts
    rows = [(str(i), "hot", "X", T0 + dt.timedelta(seconds=i)) for i in range(50)]
    rows += [(f"n{i}", None, "X", T0 + dt.timedelta(seconds=i)) for i in range(30)]
    rows += [(f"c{i}", f"u{i % 9}", "XY"[i % 2], T0 + dt.timedelta(hours=i)) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    low = replace(DEFAULT, window_bucket_row_limit=25)
    assert {r[0] for r in hot_users(df, low).collect()} == {"hot", None}
    assert hot_users(df).isEmpty()
    assert counts(velocity_counts(df, low)) == counts(velocity_counts(df)) == counts(add_velocity_counts_unsplit(df))


def test_hot_user_day_equals_unsplit(spark):
    """A third of the rows on one user inside one day, 200 of them at one time."""
    from dataclasses import replace
    from paymart.config import DEFAULT
    from paymart.operators.velocity_windows import velocity_counts
    day = dt.datetime(2024, 4, 2)
    hot = [(f"h{i}", "hot", "XY"[i % 2], day + dt.timedelta(seconds=7 * i)) for i in range(3000)]
    ties = [(f"t{i}", "hot", "X", day + dt.timedelta(hours=3)) for i in range(200)]
    rest = [(f"r{i}", f"u{i % 40}", "Y", day + dt.timedelta(minutes=11 * i)) for i in range(6000)]
    df = spark.createDataFrame(hot + ties + rest, SCHEMA)
    cfg = replace(DEFAULT, window_bucket_row_limit=1000)
    assert counts(velocity_counts(df, cfg)) == counts(velocity_counts(df)) == counts(add_velocity_counts_unsplit(df))


def test_few_context_rows_and_no_sliding_frames(spark, wh_small):
    from paymart.operators.velocity_windows import with_context
    day = 86_400_000_000
    for sf in ("/root/testdata/sf0.01", "/root/testdata/sf0.001"):
        from paymart.sources.driver_tables import load_raw
        tx = load_raw(spark, sf)["transactions"]
        dealt = with_context(tx, day, 7 * day, "transaction_ts", {"user_id", "merchant_category"}).count()
        assert tx.count() < dealt < 1.2 * tx.count()
    plan = add_velocity_counts(wh_small.stg)._jdf.queryExecution().executedPlan().toString()
    assert "specifiedwindowframe(RangeFrame, unboundedpreceding$()" in plan
    assert "specifiedwindowframe(RangeFrame, -" not in plan


def test_no_tiered_windows_without_busy_users(wh_small):
    from paymart.operators.velocity_windows import velocity_counts
    df = velocity_counts(wh_small.stg)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window [" in plan and "_minute" not in plan


def test_buckets_before_1970_and_far_ahead(spark):
    rows = [(str(i), "u", "X", t) for i, t in enumerate(
        dt.datetime(1969, 12, 31, 20) + dt.timedelta(hours=k) for k in (0, 1, 3, 4, 5, 24, 25, 27, 28, 29, 52))]
    rows += [(f"f{k}", "u", "X", dt.datetime(9000, 1, 1) + dt.timedelta(hours=13 * k)) for k in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert counts(add_velocity_counts(df)) == brute(rows)


def test_null_time_and_user_in_every_plan(spark):
    from paymart.operators.velocity_windows import add_velocity_counts_tiered
    rows = [("a", "u", "X", None), ("b", "u", "Y", None), ("c", "u", "X", T0), ("d", None, "X", T0), ("e", None, "X", None),
            ("f", None, "X", T0 + dt.timedelta(hours=2))]
    df = spark.createDataFrame(rows, SCHEMA)
    want = counts(add_velocity_counts_unsplit(df))
    assert want["a"] == (2, 2, 1) and want["f"] == (1, 2, 2)
    assert counts(add_velocity_counts(df)) == want
    assert counts(add_velocity_counts_tiered(df)) == want


def test_every_event_is_a_transaction(spark):
    from paymart.sources.driver_tables import load_raw
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        raw = load_raw(spark, sf)
        assert raw["transactions"].count() == spark.read.parquet(f"{sf}/events.parquet").count()
        assert raw["transactions"].join(raw["users"], "user_id", "left_anti").isEmpty()
