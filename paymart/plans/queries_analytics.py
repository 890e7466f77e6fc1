"""Reporting, KPI, dashboard, EDA, data-quality, ingestion and export queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from paymart.operators import dashboard as D
from paymart.operators import eda as E
from paymart.operators import export as X
from paymart.operators import ingest as I
from paymart.operators import kpis as K
from paymart.operators import quality as Q
from paymart.operators import reporting as R
from paymart.plans.catalog import query
from paymart.plans.replay import replay_of
from paymart.plans.warehouse import Warehouse
from paymart.session import scratch_path
from paymart.sources import raw as rawsrc
from paymart.sources import text as text_source

# --------------------------------------------------------------- reporting
query("rpt_hourly_fraud_trends")(lambda wh: R.rpt_hourly_fraud_trends(wh.hourly_fraud_trends()))
query("rpt_merchant_risk_profiling")(lambda wh: R.rpt_merchant_risk_profiling(wh.merchant_risk_profiling()))
query("rpt_fraud_customer_segments")(lambda wh: R.rpt_fraud_customer_segments(wh.fraud_customer_segments()))
query("rpt_cohort_analysis")(lambda wh: R.rpt_cohort_analysis(wh.cohort_analysis()))
query("rpt_velocity_anomaly_detection")(lambda wh: R.rpt_velocity_anomaly_detection(wh.velocity_anomaly_detection()))

# --------------------------------------------------------------- KPIs
query("kpi_transactions")(lambda wh: K.kpi_transactions(wh.fct))
query("kpi_monthly_mom")(lambda wh: K.kpi_monthly_mom(wh.fct))
query("kpi_daily_mart")(lambda wh: K.kpi_daily_mart(wh.daily_overview_kpis()))
query("kpi_fraud")(lambda wh: K.kpi_fraud(wh.fct))
query("kpi_off_hours")(lambda wh: K.kpi_off_hours(wh.fct, wh.cfg))
query("kpi_hourly_rate")(lambda wh: K.kpi_hourly_rate(wh.hourly_fraud_trends()))
query("kpi_activity")(lambda wh: K.kpi_activity(wh.fct))
query("kpi_customers")(lambda wh: K.kpi_customers(wh.fraud_customer_segments(), wh.dim_users))
query("kpi_weighted_retention")(lambda wh: K.kpi_weighted_retention(wh.cohort_analysis()))
query("kpi_gmv_variance")(lambda wh: K.kpi_gmv_variance(wh.fct, wh.daily_overview_kpis()))

# --------------------------------------------------------------- dashboard / top-k
query("by_risk_level")(lambda wh: D.by_risk_level(wh.fct))
query("by_fraud_reason")(lambda wh: D.by_fraud_reason(wh.fct))
query("status_split")(lambda wh: D.status_split(wh.fct))
query("method_share")(lambda wh: D.method_share(wh.fct))
query("slice_by_city")(lambda wh: D.slice_by(wh.fct, "city"))
query("slice_by_method")(lambda wh: D.slice_by(wh.fct, "payment_method"))
query("slice_by_category")(lambda wh: D.slice_by(wh.fct, "merchant_category"))
query("hour_category_heatmap")(lambda wh: D.hour_category_heatmap(wh.hourly_fraud_trends()))
query("fraud_loss_category_method")(lambda wh: D.fraud_loss_category_method(wh.fct))
query("merchant_review_list")(lambda wh: D.merchant_review_list(wh.merchant_risk_profiling(), wh.cfg))
query("alert_action_share")(lambda wh: D.alert_action_share(wh.velocity_anomaly_detection()))
query("segment_matrix")(lambda wh: D.segment_matrix(wh.fraud_customer_segments()))
query("step_up_candidates")(lambda wh: D.step_up_candidates(wh.fct, wh.cfg))
query("win_back_list")(lambda wh: D.win_back_list(wh.fraud_customer_segments()))
query("monthly_risk_report")(lambda wh: D.monthly_risk_report(wh.fct, wh.velocity_anomaly_detection(), wh.cfg))
query("top_reliable_merchants")(lambda wh: D.top_reliable_merchants(wh.merchant_risk_profiling()))
query("top_velocity_users")(lambda wh: D.top_velocity_users(wh.velocity_anomaly_detection()))
query("top_merchants_by_fraud_loss")(lambda wh: D.top_merchants_by_fraud_loss(wh.fct, wh.dim_merchants, wh.cfg))

# --------------------------------------------------------------- EDA
query("eda_prepared")(lambda wh: wh.eda_frame(business_keys=True))
query("eda_amount_coercion")(lambda wh: E.amount_coercion_report(wh.fct))
query("eda_headline")(lambda wh: E.eda_headline(wh.eda_frame()))
query("eda_monthly_volume")(lambda wh: E.eda_monthly_volume(wh.eda_frame()))
query("eda_status_mix")(lambda wh: E.eda_status_mix(wh.eda_frame()))
query("daily_success_rate_ma7")(lambda wh: E.daily_success_rate_ma7(wh.eda_frame()))
query("payment_mix_by_month")(lambda wh: E.payment_mix_by_month(wh.eda_frame()))
query("success_rate_by_method")(lambda wh: E.success_rate_by_method(wh.eda_frame()))
query("fail_decline_by_method")(lambda wh: E.fail_decline_by_method(wh.eda_frame()))
query("monthly_atv")(lambda wh: E.monthly_atv(wh.eda_frame()))
query("monthly_fraud_rate")(lambda wh: E.monthly_fraud_rate(wh.eda_frame()))
query("monthly_fraud_loss")(lambda wh: E.monthly_fraud_loss(wh.eda_frame()))
query("fraud_matrix_category_method")(lambda wh: E.fraud_matrix_category_method(wh.eda_frame()))
query("fraud_by_amount_bucket")(lambda wh: E.fraud_by_amount_bucket(wh.eda_frame()))
query("fraud_matrix_dow_hour")(lambda wh: E.fraud_matrix_dow_hour(wh.eda_frame()))
query("eda_cohort_matrix")(lambda wh: E.eda_cohort_matrix(wh.eda_frame()))
query("fraud_loss_tertiles")(lambda wh: E.fraud_loss_tertiles(wh.eda_frame()))
query("risk_calibration")(lambda wh: E.risk_calibration(wh.enriched))
query("merchant_scatter")(lambda wh: E.merchant_scatter(wh.fct, wh.dim_merchants, wh.cfg))
query("velocity_uplift")(lambda wh: E.velocity_uplift(wh.enriched, wh.cfg))
query("data_sanity")(lambda wh: E.data_sanity(wh.eda_frame()))


# --------------------------------------------------------------- data quality
def _models(wh: Warehouse) -> dict:
    return {"raw.transactions": wh.raw["transactions"], "raw.users": wh.raw["users"],
            "raw.merchants": wh.raw["merchants"], "stg_transactions": wh.stg,
            "int_transactions_enriched": wh.enriched, "int_user_metrics": wh.user_metrics()}


query("dq_not_null")(lambda wh: Q.dq_not_null(_models(wh)))
query("dq_null_keys")(lambda wh: Q.dq_null_keys(wh.raw["transactions"]))
query("dq_unique")(lambda wh: Q.dq_unique(_models(wh)))
query("dq_accepted_values")(lambda wh: Q.dq_accepted_values(_models(wh)))
query("dq_accepted_range")(lambda wh: Q.dq_accepted_range(_models(wh)))
query("dq_score_range")(lambda wh: Q.dq_score_range(wh.enriched))
query("dq_orphans")(lambda wh: Q.dq_orphans(wh.raw["transactions"], wh.raw["users"], wh.raw["merchants"]))
query("dq_row_counts")(lambda wh: Q.dq_row_counts(wh.raw))
query("dq_key_format")(lambda wh: Q.dq_key_format(wh.raw["users"], wh.raw["merchants"]))
query("dq_fraud_rate")(lambda wh: Q.dq_fraud_rate(wh.raw["transactions"], wh.cfg))
query("dq_status")(lambda wh: Q.dq_status(wh.raw["transactions"]))

# --------------------------------------------------------------- ingestion scenario
# Fixed scenario parameters: a first load of everything before FIRST_LOAD_END,
# then a re-delivered file; the overlapping batch starts at OVERLAP_START and
# carries a later load time.
FIRST_LOAD_END = dt.datetime(2024, 7, 1)
OVERLAP_START = dt.datetime(2024, 6, 1)
SECOND_LOAD_AT = dt.datetime(2025, 8, 1)
STATE_UPDATED_AT = dt.datetime(2025, 7, 1)
CHANGED_DIM_FROM = dt.date(2025, 1, 1)


def first_load(wh: Warehouse):
    return wh.raw["transactions"].where(F.col("transaction_ts") < F.lit(FIRST_LOAD_END))


def first_state(wh: Warehouse):
    empty_state = rawsrc.empty(wh.spark, "watermark")
    return I.advance_watermark(empty_state, first_load(wh), as_of=STATE_UPDATED_AT)


@query("incremental_filter")
def incremental_filter(wh: Warehouse):
    """IO4: a re-delivered full file filtered by the mark of the first load."""
    return I.filter_new_by_state(wh.raw["transactions"], first_state(wh))


@query("insert_if_absent")
def insert_if_absent(wh: Warehouse):
    """IO5: overlapping batch with a later load time; stored rows win."""
    batch = (wh.raw["transactions"].where(F.col("transaction_ts") >= F.lit(OVERLAP_START))
             .withColumn("created_at", F.lit(SECOND_LOAD_AT).cast("timestamp")))
    return I.insert_new(first_load(wh), batch, "transaction_id")


@query("upsert_dim")
def upsert_dim(wh: Warehouse):
    """IO6: users registered from CHANGED_DIM_FROM on move city (city := state)."""
    users = wh.raw["users"]
    batch = users.where(F.col("registration_date") >= F.lit(CHANGED_DIM_FROM)).withColumn("city", F.col("state"))
    return I.upsert(users, batch, "user_id")


@query("watermark_row")
def watermark_row(wh: Warehouse):
    """IO9: the load-state table after the first load."""
    return first_state(wh)


@query("dq_watermark")
def dq_watermark(wh: Warehouse):
    """Q13 on the state written by the first load."""
    return Q.dq_watermark(first_state(wh), first_load(wh))


# --------------------------------------------------------------- replayed deliveries
query("replay_loads")(lambda wh: replay_of(wh).loads())
query("replay_rejected")(lambda wh: replay_of(wh).rejected())
query("replay_transactions")(lambda wh: replay_of(wh).table("transactions"))
query("dq_row_counts_replay")(lambda wh: replay_of(wh).row_counts())
query("dq_watermark_replay")(lambda wh: replay_of(wh).watermark())


# --------------------------------------------------------------- text source
# What is planted in the text columns, by the number in transaction_id.
BAD_AMOUNTS = {101: "n/a", 103: "12,50", 107: " "}
BAD_TIME, BAD_FLAG = (109, "yesterday"), (113, "maybe")


def text_folder(wh: Warehouse) -> str:
    """The raw transactions written as text files, some values spoilt."""
    n = F.substring("transaction_id", 5, 10).cast("bigint")
    tx = wh.raw["transactions"]
    text = {c: F.col(c).cast("string") for c in tx.columns}
    for every, value in BAD_AMOUNTS.items():
        text["amount"] = F.when(n % every == 0, F.lit(value)).otherwise(text["amount"])
    text["amount"] = F.concat(F.lit(" "), text["amount"])
    for column, (every, value) in (("transaction_ts", BAD_TIME), ("is_fraud", BAD_FLAG)):
        text[column] = F.when(n % every == 0, F.lit(value)).otherwise(text[column])
    path = scratch_path(wh.spark, "text")
    tx.select(*[c.alias(name) for name, c in text.items()]).write.option("header", True).option("quoteAll", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def text_rows(wh: Warehouse):
    return text_source.typed(text_source.read_text(wh.spark, text_folder(wh)), "transactions")


@query("text_amounts")
def text_amounts(wh: Warehouse):
    """P30, IO1: what became NULL, row by row."""
    rows = text_rows(wh)
    return rows.select("transaction_id", "amount", "is_fraud", "transaction_ts",
                       F.concat_ws("; ", F.transform(text_source.REJECTED, lambda v: F.concat_ws("=", v["column"], v["text"])))
                       .alias("rejected"))


query("text_rejected_counts")(lambda wh: text_source.rejected_counts(text_rows(wh)))
query("text_amount_coercion")(lambda wh: E.amount_coercion_report(text_source.read_text(wh.spark, text_folder(wh))))


# --------------------------------------------------------------- export
query("export_velocity")(lambda wh: X.shape_for_export(R.rpt_velocity_anomaly_detection(
    wh.velocity_anomaly_detection())))
query("export_cohort")(lambda wh: X.shape_for_export(R.rpt_cohort_analysis(wh.cohort_analysis())))
query("export_segments")(lambda wh: X.shape_for_export(R.rpt_fraud_customer_segments(wh.fraud_customer_segments())))
query("export_hourly")(lambda wh: X.shape_for_export(R.rpt_hourly_fraud_trends(wh.hourly_fraud_trends())))
query("export_merchant")(lambda wh: X.shape_for_export(R.rpt_merchant_risk_profiling(wh.merchant_risk_profiling())))
query("export_daily_kpis")(lambda wh: X.shape_for_export(wh.daily_overview_kpis()))
query("export_dim_users")(lambda wh: X.shape_for_export(wh.dim_users))
query("export_fraud_mart")(lambda wh: X.shape_for_export(wh.fraud_analysis_mart()))
