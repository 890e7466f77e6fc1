"""Core layers and marts as registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from paymart.functions import scoring
from paymart.operators import marts
from paymart.operators import velocity_windows
from paymart.plans.catalog import query
from paymart.plans.warehouse import Warehouse


@query("raw_transactions")
def raw_transactions(wh: Warehouse):
    """IO2: typed raw transactions (the conformed source table)."""
    return wh.raw["transactions"]


@query("raw_users")
def raw_users(wh: Warehouse):
    return wh.raw["users"]


@query("raw_merchants")
def raw_merchants(wh: Warehouse):
    return wh.raw["merchants"]


@query("stg_transactions")
def stg_transactions(wh: Warehouse):
    """P1-P7."""
    return wh.stg


@query("velocity_counts")
def velocity_counts(wh: Warehouse):
    """Trailing 1 h / 24 h counts per user and 24 h per user x category."""
    return velocity_windows.velocity_counts(wh.stg, wh.cfg).select(
        "transaction_id", "user_id", "merchant_category", "transaction_ts",
        "tx_count_1h", "tx_count_24h", "tx_same_category_24h")


@query("velocity_counts_tiered")
def velocity_counts_tiered(wh: Warehouse):
    """W1-W3 under the skew-proof plan (two-level prefix sums over distinct
    timestamps); same result as ``velocity_counts``."""
    return velocity_windows.add_velocity_counts_tiered(wh.stg, wh.cfg).select(
        "transaction_id", "user_id", "merchant_category", "transaction_ts",
        "tx_count_1h", "tx_count_24h", "tx_same_category_24h")


@query("int_transactions_enriched")
def int_transactions_enriched(wh: Warehouse):
    """P8-P13, J2."""
    return wh.enriched


@query("fraud_score_macro")
def fraud_score_macro(wh: Warehouse):
    """P10: the score as a function of raw flags and counts."""
    e = wh.enriched
    return e.select("transaction_id", scoring.fraud_score_from_counts(
        "is_high_amount", "is_risky_merchant_category", "is_odd_hour", "tx_count_1h", "tx_count_24h",
        wh.cfg).alias("fraud_risk_score"))


@query("dim_users")
def dim_users(wh: Warehouse):
    return wh.dim_users


@query("dim_merchants")
def dim_merchants(wh: Warehouse):
    return wh.dim_merchants


@query("fct_transactions")
def fct_transactions(wh: Warehouse):
    """P16, J1."""
    return wh.fct


@query("int_user_metrics")
def int_user_metrics(wh: Warehouse):
    return wh.user_metrics()


@query("hourly_fraud_trends")
def hourly_fraud_trends(wh: Warehouse):
    return wh.hourly_fraud_trends()


@query("daily_overview_kpis")
def daily_overview_kpis(wh: Warehouse):
    return wh.daily_overview_kpis()


@query("daily_merchant_kpis")
def daily_merchant_kpis(wh: Warehouse):
    return wh.daily_merchant_kpis()


@query("merchant_risk_profiling")
def merchant_risk_profiling(wh: Warehouse):
    return wh.merchant_risk_profiling()


@query("fraud_customer_segments")
def fraud_customer_segments(wh: Warehouse):
    return wh.fraud_customer_segments()


@query("user_monthly_activity")
def user_monthly_activity(wh: Warehouse):
    return wh.user_monthly_activity()


@query("cohort_analysis")
def cohort_analysis(wh: Warehouse):
    return wh.cohort_analysis()


@query("fraud_analysis_mart")
def fraud_analysis_mart(wh: Warehouse):
    return wh.fraud_analysis_mart()


@query("velocity_anomaly_detection")
def velocity_anomaly_detection(wh: Warehouse):
    return wh.velocity_anomaly_detection()


@query("velocity_worklist")
def velocity_worklist(wh: Warehouse):
    """Rows needing action; ``velocity_worklist_ranked`` has their order."""
    return marts.velocity_anomaly_detection(wh.enriched, wh.cfg).where(F.col("action_required"))


@query("daily_merchant_kpis_ranked")
def daily_merchant_kpis_ranked(wh: Warehouse):
    """The mart with each row's place in its published order."""
    return marts.ranked("daily_merchant_kpis", wh.daily_merchant_kpis())


@query("fraud_analysis_mart_ranked")
def fraud_analysis_mart_ranked(wh: Warehouse):
    """S1."""
    return marts.ranked("fraud_analysis_mart", wh.fraud_analysis_mart())


@query("velocity_worklist_ranked")
def velocity_worklist_ranked(wh: Warehouse):
    """Rows needing action with their place in the list, highest score first."""
    return marts.ranked("velocity_anomaly_detection", velocity_worklist(wh))
