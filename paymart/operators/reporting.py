"""Reporting views over the marts.

Each view is a projection of its mart plus 0-1 scale ratios.  A ratio is
``round(pct / 100, 4)``; since ``pct`` already has at most two (or one)
decimals the division is exact, so the ratio is computed from the same
integer as the percentage and emitted as a double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _ratio_of_pct(col: str, pct_digits: int = 2) -> F.Column:
    """round(pct / 100, 4) for a pct with ``pct_digits`` decimals."""
    scale = 10 ** pct_digits
    k = F.round(F.col(col) * scale).cast("long")  # the exact integer behind the pct double
    return F.when(F.col(col).isNotNull(), k.cast("double") / F.lit(float(scale * 100)))


def _generated_at(df: DataFrame, as_of) -> DataFrame:
    return df if as_of is None else df.withColumn("view_generated_at", F.lit(as_of).cast("timestamp"))


HOURLY_COLUMNS = ("tx_hour", "merchant_category", "payment_method", "total_transactions", "fraud_transactions",
                  "fraud_rate_pct", "avg_transaction_amount", "avg_fraud_risk_score", "unique_users",
                  "odd_hour_transactions")


def rpt_hourly_fraud_trends(hourly: DataFrame, as_of=None) -> DataFrame:
    return _generated_at(hourly.select(*HOURLY_COLUMNS), as_of)


MERCHANT_COLUMNS = ("merchant_id", "merchant_name", "merchant_category", "city", "state", "onboarding_date",
                    "total_transactions", "total_volume", "avg_ticket_size", "fraud_transactions", "fraud_rate_pct",
                    "avg_fraud_risk_score", "high_risk_transactions", "unique_customers", "customer_tx_ratio",
                    "failed_transactions", "failure_rate_pct", "is_rate_reliable", "merchant_risk_category")


def rpt_merchant_risk_profiling(profile: DataFrame, as_of=None) -> DataFrame:
    return _generated_at(profile.select(
        *MERCHANT_COLUMNS,
        _ratio_of_pct("fraud_rate_pct").alias("fraud_rate_ratio"),
        _ratio_of_pct("failure_rate_pct").alias("failure_rate_ratio")), as_of)


SEGMENT_COLUMNS = ("user_id", "recency_days", "frequency", "monetary_value", "fraud_count", "category_diversity",
                   "recency_segment", "frequency_segment", "monetary_segment", "fraud_segment")


def rpt_fraud_customer_segments(segments: DataFrame, as_of=None) -> DataFrame:
    return _generated_at(segments.select(*SEGMENT_COLUMNS), as_of)


COHORT_COLUMNS = ("cohort_month", "cohort_size", "total_transactions", "total_volume", "fraud_rate_pct",
                  "avg_fraud_risk_score", "high_risk_transactions", "retention_1m_pct", "retention_3m_pct",
                  "retention_6m_pct", "mature_1m_cohort_size", "mature_3m_cohort_size", "mature_6m_cohort_size")


def rpt_cohort_analysis(cohorts: DataFrame, as_of=None) -> DataFrame:
    return _generated_at(cohorts.select(
        *COHORT_COLUMNS,
        _ratio_of_pct("retention_1m_pct", 1).alias("retention_1m_rate"),
        _ratio_of_pct("retention_3m_pct", 1).alias("retention_3m_rate"),
        _ratio_of_pct("retention_6m_pct", 1).alias("retention_6m_rate"),
        _ratio_of_pct("fraud_rate_pct").alias("fraud_rate_ratio")), as_of)


VELOCITY_COLUMNS = ("transaction_id", "user_id", "transaction_ts", "transaction_date", "tx_hour",
                    "merchant_category", "payment_method", "amount", "device_type", "status", "tx_count_1h",
                    "tx_count_24h", "tx_same_category_24h", "velocity_score", "velocity_alert_level", "is_critical",
                    "action_required", "velocity_breach_type", "fraud_risk_score", "fraud_risk_level",
                    "fraud_reason", "is_fraud")


def rpt_velocity_anomaly_detection(queue: DataFrame, as_of=None) -> DataFrame:
    return _generated_at(queue.select(*VELOCITY_COLUMNS), as_of)


VIEWS = {
    "hourly_fraud_trends": ("hourly_fraud_trends", rpt_hourly_fraud_trends),
    "merchant_risk_profiling": ("merchant_risk_profiling", rpt_merchant_risk_profiling),
    "fraud_customer_segments": ("fraud_customer_segments", rpt_fraud_customer_segments),
    "cohort_analysis": ("cohort_analysis", rpt_cohort_analysis),
    "velocity_anomaly_detection": ("velocity_anomaly_detection", rpt_velocity_anomaly_detection),
}


class ViewDeployError(RuntimeError):
    pass


def deploy_views(spark: SparkSession, marts: dict[str, DataFrame], as_of=None, prefix: str = "reporting_") -> list[str]:
    """Publish the five reporting views as temp views, then verify that
    each one exists; a missing mart or view raises."""
    published = []
    for view, (mart_name, fn) in VIEWS.items():
        if mart_name not in marts:
            raise ViewDeployError(f"mart {mart_name!r} for view {view!r} is missing")
        name = prefix + view
        fn(marts[mart_name], as_of).createOrReplaceTempView(name)
        published.append(name)
    missing = [n for n in published if not spark.catalog.tableExists(n)]
    if missing:
        raise ViewDeployError(f"views not found after deploy: {missing}")
    return published
