"""KPI catalogue (K1-K64) as aggregates over the fact and the marts.

Catalogue ratios return 0 on a zero denominator (unlike the marts' NULL).
Money sums stay decimal until the final division, so totals are exact.
Every KPI table is one global aggregate (partial aggregation on the map
side, one row reduced on the driver side) or a per-month aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.config import DEFAULT, FRAUD_SEGMENTS, MONETARY_SEGMENTS, RISK_LEVELS, RiskConfig
from paymart.functions.rounding import money, safe_ratio
from paymart.functions.scoring import count_if, flag_true
from paymart.operators.distincts import with_distinct_counts


def _success() -> F.Column:
    return F.col("status") == "success"


def _success_amount() -> F.Column:
    return F.when(_success(), F.col("amount")).otherwise(F.lit(0))


def kpi_transactions(fct: DataFrame) -> DataFrame:
    """K1-K7: volume, GMV (success only), average ticket per attempt,
    success / failure rates and capture rate (identically 1 when GMV > 0)."""
    a = fct.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(F.when(_success(), F.col("amount"))).alias("_gmv"),
        count_if(_success()).alias("success_transactions"),
        count_if(F.col("status") == "failed").alias("failed_transactions"),
    )
    gmv = F.coalesce(F.col("_gmv"), F.lit(0)).cast("decimal(38,2)")
    return a.select(
        "total_transactions", money(gmv).alias("gmv"), money(gmv).alias("success_gmv"),
        safe_ratio(gmv, F.col("total_transactions")).alias("avg_ticket"),
        safe_ratio(F.col("success_transactions"), F.col("total_transactions")).alias("success_rate"),
        safe_ratio(F.col("failed_transactions"), F.col("total_transactions")).alias("failure_rate"),
        safe_ratio(gmv, gmv).alias("capture_rate"))


def monthly_gmv(fct: DataFrame) -> DataFrame:
    return fct.groupBy(F.date_trunc("month", "transaction_ts").alias("month")).agg(
        F.coalesce(F.sum(F.when(_success(), F.col("amount"))), F.lit(0)).cast("decimal(38,2)").alias("gmv"),
        F.count(F.lit(1)).alias("transactions"))


def kpi_monthly_mom(fct: DataFrame) -> DataFrame:
    """K8-K9: month-over-month change.  The previous month is matched by
    calendar (month - 1), not by row order, so a gap month yields no prior
    value (and a 0 change under the catalogue's zero rule)."""
    m = monthly_gmv(fct)
    prev = m.select(F.add_months(F.col("month"), 1).cast("timestamp").alias("month"),
                    F.col("gmv").alias("prev_gmv"), F.col("transactions").alias("prev_transactions"))
    j = m.join(prev, "month", "left")
    return j.select(
        "month", money(F.col("gmv")).alias("gmv"), "transactions",
        money(F.col("prev_gmv")).alias("prev_gmv"), "prev_transactions",
        safe_ratio(F.col("gmv") - F.col("prev_gmv"), F.col("prev_gmv")).alias("gmv_mom"),
        safe_ratio(F.col("transactions") - F.col("prev_transactions"), F.col("prev_transactions"))
        .alias("transactions_mom"))


def kpi_daily_mart(daily: DataFrame) -> DataFrame:
    """GMV (all statuses) and fraud loss summed from the daily mart."""
    return daily.agg(money(F.sum("total_revenue")).alias("daily_kpi_gmv"),
                     money(F.sum("fraud_loss_amount")).alias("daily_kpi_fraud_loss"))


def kpi_fraud(fct: DataFrame) -> DataFrame:
    """K12-K15, K21-K22."""
    fraud = flag_true("is_fraud")
    a = fct.agg(
        F.count(F.lit(1)).alias("_n"),
        count_if(fraud).alias("fraud_transactions"),
        F.coalesce(F.sum(F.when(fraud, F.col("amount"))), F.lit(0)).cast("decimal(38,2)").alias("_loss"),
        F.coalesce(F.sum(F.when(_success(), F.col("amount"))), F.lit(0)).cast("decimal(38,2)").alias("_gmv"),
        count_if(F.col("fraud_risk_level").isin(*RISK_LEVELS[2:])).alias("high_risk_transactions"),
        F.sum("fraud_risk_score").alias("_score_sum"),
        F.count("fraud_risk_score").alias("_score_n"),
    )
    return a.select(
        "fraud_transactions",
        safe_ratio(F.col("fraud_transactions"), F.col("_n")).alias("fraud_rate"),
        money(F.col("_loss")).alias("fraud_loss"),
        safe_ratio(F.col("_loss"), F.col("_gmv")).alias("fraud_loss_rate"),
        "high_risk_transactions",
        safe_ratio(F.col("_score_sum"), F.col("_score_n")).alias("avg_fraud_risk_score"))


def kpi_off_hours(fct: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Off-hours = transaction hour in the odd-hour window."""
    off = F.hour("transaction_ts").between(cfg.odd_hour_start, cfg.odd_hour_end)
    fraud = flag_true("is_fraud")
    a = fct.agg(
        count_if(off).alias("off_hours_transactions"),
        count_if(off & fraud).alias("off_hours_fraud_transactions"),
        count_if(~off).alias("_normal"),
        count_if(~off & fraud).alias("normal_hours_fraud_transactions"),
    )
    return a.select(
        "off_hours_transactions", "off_hours_fraud_transactions",
        safe_ratio(F.col("off_hours_fraud_transactions"), F.col("off_hours_transactions"))
        .alias("off_hours_fraud_rate"),
        "normal_hours_fraud_transactions",
        safe_ratio(F.col("normal_hours_fraud_transactions"), F.col("_normal")).alias("normal_hours_fraud_rate"))


def kpi_hourly_rate(hourly: DataFrame) -> DataFrame:
    """The hourly mart's fraud rate on the 0-1 scale (exact: pct/100)."""
    k = F.round(F.col("fraud_rate_pct") * 100).cast("long")
    return hourly.select("tx_hour", "merchant_category", "payment_method",
                         F.when(F.col("fraud_rate_pct").isNotNull(), k.cast("double") / F.lit(10000.0))
                         .alias("hourly_fraud_rate"))


def kpi_activity(fct: DataFrame) -> DataFrame:
    """K31-K33."""
    a = with_distinct_counts(fct, [], {"active_users": "user_sk", "active_merchants": "merchant_sk"},
                             partial={"_c": F.count(F.lit(1))}, final={"_n": F.sum("_c")})
    return a.select("active_users", "active_merchants",
                    safe_ratio(F.coalesce(F.col("_n"), F.lit(0)), F.col("active_users")).alias("transactions_per_user"))


def kpi_customers(segments: DataFrame, du: DataFrame) -> DataFrame:
    """Segment counts plus mean user tenure (a scalar subquery
    over the user dimension, no join)."""
    tenure = du.agg(safe_ratio(F.sum("days_since_registration"), F.count("days_since_registration"))).scalar()
    a = segments.agg(
        count_if(F.col("fraud_segment").isin(*FRAUD_SEGMENTS[:2])).alias("fraud_prone_customers"),
        count_if(F.col("monetary_segment") == MONETARY_SEGMENTS[0]).alias("high_monetary_customers"),
        count_if(F.col("fraud_segment") == FRAUD_SEGMENTS[0]).alias("repeat_fraudster_count"))
    return a.select("*", tenure.alias("avg_days_since_registration"))


def kpi_weighted_retention(cohorts: DataFrame) -> DataFrame:
    """sum(retention_1m_pct * mature_1m) / sum(mature_1m) / 100, from
    the exact tenths behind the one-decimal percentage."""
    tenths = F.round(F.col("retention_1m_pct") * 10).cast("long")
    a = cohorts.agg(F.sum(F.coalesce(tenths, F.lit(0)) * F.col("mature_1m_cohort_size")).alias("_num"),
                    F.sum("mature_1m_cohort_size").alias("_den"))
    return a.select(safe_ratio(F.col("_num"), F.col("_den") * 1000).alias("weighted_retention_1m"))


def kpi_gmv_variance(fct: DataFrame, daily: DataFrame) -> DataFrame:
    """Star-schema GMV (success only) minus the daily mart's revenue
    (all statuses), as two scalar subqueries."""
    dgmv = daily.agg(F.coalesce(F.sum("total_revenue"), F.lit(0)).cast("decimal(38,2)")).scalar()
    a = fct.agg(F.coalesce(F.sum(F.when(_success(), F.col("amount"))), F.lit(0)).cast("decimal(38,2)").alias("_gmv"))
    return a.select(money(F.col("_gmv")).alias("gmv"), money(dgmv).alias("daily_kpi_gmv"),
                    money(F.col("_gmv") - dgmv).alias("gmv_variance"))
