"""Structured Streaming loader and report export."""

import csv
import datetime as dt
import glob

from pyspark.sql import functions as F

from paymart.operators import export, ingest, reporting
from paymart.sources import schemas
from paymart.streaming.incremental import stream_transactions


def _csv(path, rows):
    header = [f.name for f in schemas.TRANSACTIONS if f.name != "created_at"]
    with open(path, "w") as fh:
        fh.write(",".join(header) + "\n")
        for r in rows:
            fh.write(",".join(r) + "\n")


def _row(tid, ts):
    return [tid, "USR_00000001", "MER_000001", "Retail", "UPI", "10.00", "INR", "success", "false", "mobile", "", "", ts]


def test_streaming_loader_applies_mark_and_dedup(spark, tmp_root):
    landing = f"{tmp_root}/landing"
    import os
    os.makedirs(landing)
    _csv(f"{landing}/a.csv", [_row("T1", "2024-03-01 10:00:00"), _row("T2", "2024-03-02 10:00:00")])
    root = f"{tmp_root}/wh"
    q, reports = stream_transactions(spark, landing, root, as_of=dt.datetime(2025, 7, 1),
                                     checkpoint=f"{tmp_root}/ckpt")
    q.awaitTermination(120)
    _csv(f"{landing}/b.csv", [_row("T2", "2024-03-02 10:00:00"), _row("T3", "2024-03-03 10:00:00"),
                             _row("T0", "2024-02-01 10:00:00")])
    q2, reports2 = stream_transactions(spark, landing, root, as_of=dt.datetime(2025, 7, 2),
                                       checkpoint=f"{tmp_root}/ckpt")
    q2.awaitTermination(120)
    got = sorted(r.transaction_id for r in ingest.read_current(spark, root, "transactions").collect())
    assert got == ["T1", "T2", "T3"]
    assert reports2 and reports2[0].rows_skipped_late == 2
    assert ingest.read_current(spark, root, "watermark").first().last_loaded_ts == dt.datetime(2024, 3, 3, 10)


def test_export_shapes_and_writes(spark, wh_small, tmp_root):
    marts = {"daily_overview_kpis": wh_small.daily_overview_kpis(), "dim_users": wh_small.dim_users,
             "fraud_analysis_mart": wh_small.fraud_analysis_mart()}
    rep = {"cohort_analysis": reporting.rpt_cohort_analysis(wh_small.cohort_analysis(), as_of=dt.datetime(2025, 7, 1)),
           "fraud_customer_segments": reporting.rpt_fraud_customer_segments(wh_small.fraud_customer_segments()),
           "hourly_fraud_trends": reporting.rpt_hourly_fraud_trends(wh_small.hourly_fraud_trends()),
           "merchant_risk_profiling": reporting.rpt_merchant_risk_profiling(wh_small.merchant_risk_profiling()),
           "velocity_anomaly_detection": reporting.rpt_velocity_anomaly_detection(wh_small.velocity_anomaly_detection())}
    sets = export.export_sets(marts, rep)
    sets["Broken"] = lambda: (_ for _ in ()).throw(RuntimeError("boom"))
    written = export.export_reports(sets, f"{tmp_root}/out")
    assert "Broken" not in written and len(written) == 8
    with open(sorted(glob.glob(f"{written['Cohort_Data']}/part-*.csv"))[0]) as fh:
        rows = list(csv.DictReader(fh))
    assert "view_generated_at" not in rows[0] and len(rows[0]["cohort_month"]) == 10
    with open(sorted(glob.glob(f"{written['Velocity_Data']}/part-*.csv"))[0]) as fh:
        r = next(csv.DictReader(fh))
    assert len(r["transaction_ts"]) == 19


def test_deploy_views(spark, wh_small):
    marts = {"hourly_fraud_trends": wh_small.hourly_fraud_trends(),
             "merchant_risk_profiling": wh_small.merchant_risk_profiling(),
             "fraud_customer_segments": wh_small.fraud_customer_segments(),
             "cohort_analysis": wh_small.cohort_analysis(),
             "velocity_anomaly_detection": wh_small.velocity_anomaly_detection()}
    names = reporting.deploy_views(spark, marts)
    assert len(names) == 5 and spark.table("reporting_merchant_risk_profiling").where(
        F.col("fraud_rate_ratio") > 1).count() == 0
    import pytest
    with pytest.raises(reporting.ViewDeployError):
        reporting.deploy_views(spark, {k: v for k, v in marts.items() if k != "cohort_analysis"})


def test_late_rows_are_visible(spark):
    from paymart.streaming.incremental import late_rows
    state = spark.createDataFrame([("raw.transactions", dt.datetime(2024, 3, 2, 10), 2, None)], schemas.WATERMARK)
    batch = spark.createDataFrame([_row("T1", "2024-03-01 10:00:00")[:1] + [dt.datetime(2024, 3, 1, 10)],
                                   ["T2", dt.datetime(2024, 3, 2, 10)], ["T3", dt.datetime(2024, 3, 3, 10)]],
                                  "transaction_id string, transaction_ts timestamp")
    assert sorted(r.transaction_id for r in late_rows(batch, state).collect()) == ["T1", "T2"]
