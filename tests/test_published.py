"""The published warehouse: incremental builds equal full ones, new sessions find tables and views, the command line."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from paymart.operators import ingest
from paymart.plans.published import MONTHLY, WHOLE, NotPublishedError, Published
from paymart.sources import driver_tables

RUN = dt.datetime(2025, 7, 1)
STAMPS = ("dbt_updated_at", "updated_at", "raw_loaded_at")
NAMES = ("dim_users", "dim_merchants", *MONTHLY, *WHOLE)


def rows(df):
    return df.drop(*STAMPS)


def same(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """Two deliveries into one root, with a build after each; new users come with the second."""
    root = str(tmp_path_factory.mktemp("wh"))
    raw = driver_tables.load_raw(spark, "/root/testdata/sf0.001")
    tx = raw["transactions"]
    cut = dt.datetime(2024, 9, 1)
    early, late = tx.where(F.col("transaction_ts") < F.lit(cut)), tx.where(F.col("transaction_ts") >= F.lit(cut))
    late_only = late.select("user_id").distinct().join(early.select("user_id").distinct(), "user_id", "left_anti").limit(1)
    ghost = early.groupBy("user_id").count().orderBy("count", "user_id").first().user_id      # known later only
    ingest.load_dimension(spark, raw["users"].where(F.col("user_id") != ghost).join(late_only, "user_id", "left_anti"), root, "users", RUN)
    ingest.load_dimension(spark, raw["merchants"], root, "merchants", RUN)
    ingest.load_transactions(spark, early, root, RUN)
    one = Published(spark, root)
    first = one.update(RUN)
    before = {n: {(e.part, e.version) for e in one.log(n).live()} for n in MONTHLY}
    ingest.load_dimension(spark, raw["users"], root, "users", RUN)
    ingest.load_transactions(spark, late, root, RUN)
    second = Published(spark, root).update(RUN)
    return root, first, second, before, ghost, cut


def test_second_load_rewrites_touched_months_and_equals_a_full_build(spark, built, tmp_path):
    root, first, second, before, ghost, cut = built
    published = Published(spark, root)
    new = set(second["fct_transactions"])
    enr = published.table("int_transactions_enriched")
    touched = enr.where((F.col("transaction_ts") >= F.lit(cut)) | (F.col("user_id") == ghost))
    assert {r.m for r in touched.select(F.date_format("transaction_ts", "yyyy-MM").alias("m")).distinct().collect()} <= new
    for name in MONTHLY:
        after = {(e.part, e.version) for e in published.log(name).live()}
        assert {m for m, v in after if (m, v) not in before[name]} <= new
        kept = {(m, v) for m, v in before[name] if m not in new}
        assert kept <= after
    assert set(first["fct_transactions"]) - new      # some months were left alone
    full = Published(spark, str(tmp_path))
    full.update_from({n: ingest.read_current(spark, root, n) for n in ("users", "merchants", "transactions")}, RUN)
    for name in NAMES:
        assert same(rows(published.table(name)), rows(full.table(name))), name
    assert not published.table("fct_transactions").where("user_sk is null").count()


def test_a_build_that_stops_is_repeated(spark, built, monkeypatch, tmp_path):
    root = built[0]
    marks = Published(spark, root)._marks()
    late = ingest.read_current(spark, root, "transactions").orderBy(F.col("transaction_ts").desc()).limit(3)
    late = late.withColumn("transaction_id", F.concat("transaction_id", F.lit("-b"))).withColumn(
        "transaction_ts", F.col("transaction_ts") + F.expr("interval 40 minutes"))
    ingest.load_transactions(spark, late, root, RUN)
    renamed = ingest.read_current(spark, root, "merchants").orderBy("merchant_id").limit(1).withColumn("merchant_name", F.lit("New"))
    ingest.load_dimension(spark, renamed, root, "merchants", RUN)
    real, calls = Published._write_months, []

    def stops(self, name, *args):
        calls.append(name)
        if name == "daily_overview_kpis":
            raise KeyboardInterrupt
        return real(self, name, *args)

    with monkeypatch.context() as m:
        m.setattr(Published, "_write_months", stops)
        with pytest.raises(KeyboardInterrupt):
            Published(spark, root).update(RUN)
    assert Published(spark, root)._marks() == marks
    done = Published(spark, root).update(RUN)
    assert done["fct_transactions"]
    full = Published(spark, str(tmp_path))
    full.update_from({n: ingest.read_current(spark, root, n) for n in ("users", "merchants", "transactions")}, RUN)
    for name in ("fct_transactions", "daily_merchant_kpis", "fraud_analysis_mart", "cohort_analysis"):
        assert same(rows(Published(spark, root).table(name)), rows(full.table(name))), name


def test_run_date_reaches_the_tables(spark, built):
    table = Published(spark, built[0]).table
    assert table("cohort_analysis").select("dbt_updated_at").distinct().collect() == [(RUN,)]
    assert table("int_user_metrics").select("updated_at").distinct().collect() == [(RUN,)]
    off = table("dim_users").where(F.col("days_since_registration") != F.datediff(F.lit(RUN.date()), "registration_date"))
    assert off.isEmpty() and not table("dim_users").isEmpty()


def test_a_raw_table_started_anew_is_noticed(spark, tmp_path):
    published = Published(spark, str(tmp_path))
    log = ingest.raw_table(spark, str(tmp_path), "transactions")
    log.begin()
    seen = max(e.seq for e in log.lines())
    assert published._new_commits("transactions", seen) == ([], seen, False)
    ingest.reset_raw(spark, str(tmp_path))
    assert published._new_commits("transactions", seen) == ([], seen + 1, True)


def test_views_and_tables_are_found_by_another_session(spark, built, monkeypatch):
    root = built[0]
    names = Published(spark, root).deploy_views(RUN)
    other = spark.newSession()
    assert not other.catalog.tableExists(names[0])

    def none(*_):
        raise AssertionError("a view must not build anything")

    monkeypatch.setattr(Published, "_build", none)
    assert Published(other, root).open_views() == names and len(names) == 5
    view = other.table("reporting_merchant_risk_profiling")
    assert view.select("view_generated_at").distinct().collect() == [(RUN,)]
    assert view.count() == Published(other, root).table("merchant_risk_profiling").count()


def test_missing_tables_say_so(spark, tmp_path):
    from paymart.operators.reporting import ViewDeployError
    empty = Published(spark, str(tmp_path))
    with pytest.raises(NotPublishedError):
        empty.table("dim_users")
    with pytest.raises(NotPublishedError):
        empty.open_views()
    with pytest.raises(ViewDeployError):
        empty.deploy_views()


def test_empty_raw_tables_build(spark, tmp_path):
    from paymart.sources import raw
    published = Published(spark, str(tmp_path))
    published.update_from({n: raw.empty(spark, n) for n in ("users", "merchants", "transactions")}, RUN)
    assert published.table("cohort_analysis").isEmpty() and published.table("dim_users").isEmpty()


def test_command_line_views_and_export(spark, built, tmp_path, capsys, monkeypatch):
    from paymart.__main__ import main
    from paymart.operators import export
    root = built[0]

    def last():
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    before = {n: Published(spark, root).log(n).live() for n in MONTHLY}
    assert main(["build", "--raw-root", root, "--as-of", "2025-08-01"]) == 0
    done = last()      # nothing new: no month is written
    assert set(done) == set(NAMES) and not any(done.values())
    assert {n: Published(spark, root).log(n).live() for n in MONTHLY} == before
    assert main(["views", "--root", root]) == 0
    assert "reporting_velocity_anomaly_detection" in last()
    assert main(["export", "--root", root, "--out", str(tmp_path / "out")]) == 0
    assert len(last()) == 8
    first = min(p for p in (tmp_path / "out" / "Fraud_Mart").iterdir() if p.name.startswith("part-"))
    assert os.path.getsize(first) > 0
    real = export.export_sets
    monkeypatch.setattr(export, "export_sets", lambda *a: real(*a) | {"Broken": lambda: 1 / 0})
    assert main(["export", "--root", root, "--out", str(tmp_path / "out2")]) == 1
