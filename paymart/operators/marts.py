"""Analytics marts over the enriched rows, the fact and the dimensions.

Plan notes that hold for every mart here:

* Aggregations run with Spark's partial (map-side) aggregation, so a busy key
  is combined inside each map task before the shuffle; only one row per key
  and task crosses the network.
* A mart that needs dimension attributes aggregates the fact first and joins
  the (much smaller) aggregate to the dimension afterwards.
* Wall-clock columns (``dbt_updated_at``) are added only when ``as_of`` is
  passed, so results are reproducible.
* Output ordering belongs to the sink (exports sort); a table has no order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paymart.config import DEFAULT, RISK_LEVELS, RiskConfig
from paymart.functions import rounding as R
from paymart.functions import scoring, segments, velocity
from paymart.functions.scoring import count_if
from paymart.operators.distincts import with_distinct_counts
from paymart.operators.joins import broadcast_if_small
from paymart.operators.ordering import with_rank

DAY_US = 86_400_000_000


def _stamp(df: DataFrame, as_of, name: str = "dbt_updated_at") -> DataFrame:
    return df if as_of is None else df.withColumn(name, F.lit(as_of).cast("timestamp"))


def _is_fraud() -> F.Column:
    return scoring.flag_true("is_fraud")


def _high_or_critical() -> F.Column:
    return F.col("fraud_risk_level").isin(*RISK_LEVELS[2:])


# --------------------------------------------------------------------------- A1
def user_metrics(enr: DataFrame, as_of=None) -> DataFrame:
    agg = with_distinct_counts(
        enr, ["user_id"], {"unique_merchants_used": "merchant_id", "unique_categories_used": "merchant_category"},
        partial={"_n": F.count(F.lit(1)), "_spend": F.sum("amount"), "_na": F.count("amount"),
                 "_fraud": count_if(_is_fraud()), "_first": F.min("transaction_ts"), "_last": F.max("transaction_ts"),
                 "_odd": count_if(F.col("is_odd_hour")), "_score": F.max("fraud_risk_score")},
        final={"total_transactions": F.sum("_n"), "total_spend": F.sum("_spend"), "_n_amount": F.sum("_na"),
               "fraud_count": F.sum("_fraud"), "first_transaction_date": F.min("_first"),
               "last_transaction_date": F.max("_last"), "odd_hour_tx_count": F.sum("_odd"),
               "max_fraud_risk_score": F.max("_score")})
    spend = F.col("total_spend").cast("decimal(22,2)")
    out = agg.select(
        scoring.surrogate_key("user_id").alias("user_sk"), "user_id", "total_transactions",
        R.round_avg_money(spend, F.col("_n_amount")).alias("avg_transaction_amount"),
        spend.alias("total_spend"), "fraud_count", "first_transaction_date", "last_transaction_date",
        "unique_categories_used", "unique_merchants_used", "odd_hour_tx_count", "max_fraud_risk_score")
    return _stamp(out, as_of, "updated_at")


# --------------------------------------------------------------------------- A2
def daily_overview_kpis(fct: DataFrame) -> DataFrame:
    amount = F.col("amount")
    loss = F.when(_is_fraud(), amount).otherwise(F.lit(0))
    agg = with_distinct_counts(
        fct.withColumn("day", F.to_date("transaction_ts")), ["day"],
        {"active_users": "user_sk", "active_merchants": "merchant_sk"},
        partial={"_n": F.count(F.lit(1)), "_revenue": F.sum(amount), "_na": F.count(amount),
                 "_fraud": count_if(_is_fraud()), "_loss": F.sum(loss), "_failed": count_if(F.col("status") == "failed")},
        final={"total_transactions": F.sum("_n"), "total_revenue": F.sum("_revenue"), "_n_amount": F.sum("_na"),
               "fraud_count": F.sum("_fraud"), "fraud_loss_amount": F.sum("_loss"),
               "failed_transactions": F.sum("_failed")})
    money = {c: F.col(c).cast("decimal(22,2)") for c in ("total_revenue", "fraud_loss_amount")}
    return agg.withColumns(money).select(
        "day", "total_transactions", "active_users", "active_merchants", "total_revenue",
        (F.col("total_revenue").cast("double") / F.nullif(F.col("_n_amount"), F.lit(0))).alias("avg_transaction_value"),
        "fraud_count", "fraud_loss_amount", "failed_transactions")


# --------------------------------------------------------------------------- A3
def daily_merchant_kpis(fct: DataFrame, dm: DataFrame) -> DataFrame:
    amount = F.col("amount")
    agg = fct.groupBy("merchant_sk", F.to_date("transaction_ts").alias("day")).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum(amount).alias("total_revenue"),
        F.count(amount).alias("_n_amount"),
        count_if(_is_fraud()).alias("fraud_count"),
        F.sum(F.when(_is_fraud(), amount).otherwise(F.lit(0))).alias("fraud_loss"),
        F.countDistinct("user_sk").alias("unique_customers"),
    )
    attrs = broadcast_if_small(
        dm.select("merchant_sk", "merchant_id", "merchant_name", "merchant_category", "is_high_risk_category"))
    return agg.join(attrs, "merchant_sk", "left").select(
        "merchant_sk", "merchant_id", "merchant_name", "merchant_category", "is_high_risk_category", "day",
        "transaction_count", "total_revenue",
        (F.col("total_revenue").cast("double") / F.nullif(F.col("_n_amount"), F.lit(0))).alias("avg_transaction_value"),
        "fraud_count", "fraud_loss", "unique_customers")


# --------------------------------------------------------------------------- A4
def hourly_fraud_trends(enr: DataFrame, as_of=None) -> DataFrame:
    agg = enr.groupBy("tx_hour", "merchant_category", "payment_method").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        count_if(_is_fraud()).alias("fraud_transactions"),
        F.sum("amount").alias("_sum_amount"),
        F.count("amount").alias("_n_amount"),
        F.sum("fraud_risk_score").alias("_sum_score"),
        F.count("fraud_risk_score").alias("_n_score"),
        F.countDistinct("user_id").alias("unique_users"),
        count_if(F.col("is_odd_hour")).alias("odd_hour_transactions"),
    )
    out = agg.select(
        "tx_hour", "merchant_category", "payment_method", "total_transactions", "fraud_transactions",
        R.pct(F.col("fraud_transactions"), F.col("total_transactions")).alias("fraud_rate_pct"),
        R.round_avg_money(F.col("_sum_amount"), F.col("_n_amount")).alias("avg_transaction_amount"),
        R.round_avg_int(F.col("_sum_score"), F.col("_n_score")).alias("avg_fraud_risk_score"),
        "unique_users", "odd_hour_transactions")
    return _stamp(out, as_of)


# --------------------------------------------------------------------------- A5
def _merchant_fact_aggregate(fct: DataFrame) -> DataFrame:
    return fct.where(F.col("merchant_sk").isNotNull()).groupBy("merchant_sk").agg(
        F.count("transaction_id").alias("total_transactions"),
        F.sum("amount").alias("_sum_amount"),
        F.count("amount").alias("_n_amount"),
        count_if(_is_fraud()).alias("fraud_transactions"),
        F.sum("fraud_risk_score").alias("_sum_score"),
        F.count("fraud_risk_score").alias("_n_score"),
        count_if(_high_or_critical()).alias("high_risk_transactions"),
        F.countDistinct("user_sk").alias("unique_customers"),
        count_if(F.col("status") == "failed").alias("failed_transactions"),
    )


def merchant_risk_profiling(dm: DataFrame, fct: DataFrame, cfg: RiskConfig = DEFAULT, as_of=None) -> DataFrame:
    """Every merchant, with or without transactions; facts without a merchant
    are not counted.  The fact is aggregated per merchant before the join."""
    agg = _merchant_fact_aggregate(fct)
    j = dm.select("merchant_sk", "merchant_id", "merchant_name", "merchant_category", "city", "state",
                  "onboarding_date").join(agg, "merchant_sk", "left")
    zero = F.lit(0).cast("long")
    n = F.coalesce(F.col("total_transactions"), zero)
    fraud = F.coalesce(F.col("fraud_transactions"), zero)
    failed = F.coalesce(F.col("failed_transactions"), zero)
    avg_score = R.round_avg_int(F.col("_sum_score"), F.col("_n_score"))
    out = j.select(
        "merchant_id", "merchant_name", "merchant_category", "city", "state", "onboarding_date",
        n.alias("total_transactions"),
        F.coalesce(F.col("_sum_amount"), F.lit(0).cast("decimal(22,2)")).alias("total_volume"),
        R.round_avg_money(F.col("_sum_amount"), F.col("_n_amount")).alias("avg_ticket_size"),
        fraud.alias("fraud_transactions"),
        F.when(n >= cfg.merchant_risk_min_transactions, R.pct(fraud, n)).alias("fraud_rate_pct"),
        avg_score.alias("avg_fraud_risk_score"),
        F.coalesce(F.col("high_risk_transactions"), zero).alias("high_risk_transactions"),
        F.coalesce(F.col("unique_customers"), zero).alias("unique_customers"),
        R.ratio(F.coalesce(F.col("unique_customers"), zero), n).alias("customer_tx_ratio"),
        failed.alias("failed_transactions"),
        R.pct(failed, n).alias("failure_rate_pct"),
        (n >= cfg.merchant_risk_min_transactions).alias("is_rate_reliable"),
        segments.merchant_tier(n, fraud, avg_score >= cfg.merchant_risk_high_avg_score,
                               avg_score >= cfg.merchant_risk_medium_avg_score, cfg).alias("merchant_risk_category"),
    )
    return _stamp(out, as_of)


def _newest(rows: DataFrame, ts: str) -> F.Column:
    """The newest ``ts`` of ``rows`` as a scalar subquery that runs on the same
    exchange as ``rows`` themselves.  A plain ``max(ts)`` would have its other
    columns pruned and so read the fact a second time; the maximum of a struct
    of all columns, ``ts`` first, keeps the two plans alike."""
    rest = [c for c in rows.columns if c != ts]
    return rows.agg(F.max(F.struct(ts, *rest))).scalar()[ts]


# --------------------------------------------------------------------------- A6
def fraud_customer_segments(fct: DataFrame, du: DataFrame, cfg: RiskConfig = DEFAULT, as_of=None) -> DataFrame:
    """RFM segments per user that joins the user dimension.

    The fact is aggregated per ``user_sk`` first; the inner join with the
    dimension then drops orphan facts and maps the key back to ``user_id``.
    ``recency_days`` counts whole 24-hour periods between the user's last
    transaction and the newest transaction of any joined user, a scalar
    subquery over the same per-user aggregate."""
    per_user = fct.where(F.col("user_sk").isNotNull()).groupBy("user_sk").agg(
        F.max("transaction_ts").alias("last_transaction_ts"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("amount").alias("monetary_value"),
        count_if(_is_fraud()).alias("fraud_count"),
        F.countDistinct("merchant_category").alias("category_diversity"),
    )
    rfm = per_user.join(du.select("user_sk", "user_id"), "user_sk", "inner")
    anchor = _newest(rfm, "last_transaction_ts")
    rec = R.idiv(F.unix_micros(anchor) - F.unix_micros(F.col("last_transaction_ts")), F.lit(DAY_US))
    out = rfm.select(
        "user_id", rec.alias("recency_days"), "frequency", "monetary_value", "fraud_count", "category_diversity",
    ).select(
        "*",
        segments.recency_segment("recency_days", cfg).alias("recency_segment"),
        segments.frequency_segment("frequency", cfg).alias("frequency_segment"),
        segments.monetary_segment("monetary_value", cfg).alias("monetary_segment"),
        segments.fraud_segment("fraud_count", cfg).alias("fraud_segment"),
    )
    return _stamp(out, as_of)


# --------------------------------------------------------------------------- A7-A10
def _monthly_by_user_sk(fct: DataFrame) -> DataFrame:
    """Per user key and calendar month, aggregated from the fact first."""
    return fct.where(F.col("user_sk").isNotNull()).groupBy(
        "user_sk", F.date_trunc("month", "transaction_ts").alias("activity_month")).agg(
        F.count(F.lit(1)).alias("tx_count"),
        F.sum("amount").alias("total_amount"),
        count_if(_is_fraud()).alias("fraud_tx_count"),
        F.avg(F.col("fraud_risk_score").cast("double")).alias("avg_risk_score"),
        count_if(_high_or_critical()).alias("high_risk_transactions"),
        count_if(F.col("status") == "success").alias("successful_tx_count"),
        F.max("transaction_ts").alias("newest_ts"),
    )


def user_monthly_activity(fct: DataFrame, du: DataFrame) -> DataFrame:
    """Per user and calendar month: counts, amount, fraud, mean score,
    high-risk and successful counts, for users that join the dimension.
    The fact is aggregated per (user key, month) before the join, so only
    one row per user-month meets the dimension."""
    agg = _monthly_by_user_sk(fct)
    return agg.join(du.select("user_sk", "user_id"), "user_sk", "inner").select(
        "user_id", "activity_month", "tx_count", "total_amount", "fraud_tx_count", "avg_risk_score",
        "high_risk_transactions", "successful_tx_count")


def cohort_analysis(fct: DataFrame, du: DataFrame, as_of=None) -> DataFrame:
    """Acquisition cohorts by month of the first *successful* transaction.

    Two-level aggregate instead of seven ``count(distinct)``: user-month
    activity -> per (cohort, user) sums and retained flags -> per cohort.
    The cohort month of a user is a window minimum over that user's
    *monthly* rows (at most one row per month, so no user can be large).
    A cohort is mature for k months when cohort month + k <= month of the
    newest transaction; immature retention is NULL, not 0.
    """
    # user-months of users present in the dimension (semi join on aggregated rows)
    # a month is known if its newest time is: said here of both, so that the
    # anchor's plan and this one prune and filter alike
    known = F.col("activity_month").isNotNull() & F.col("newest_ts").isNotNull()
    uma = _monthly_by_user_sk(fct).where(known).join(du.select("user_sk"), "user_sk", "left_semi")
    anchor_month = F.date_trunc("month", _newest(uma, "newest_ts"))
    first_success = F.min(F.when(F.col("successful_tx_count") > 0, F.col("activity_month"))) \
        .over(Window.partitionBy("user_sk"))
    ca = (uma.withColumn("cohort_month", first_success)
          .where(F.col("cohort_month").isNotNull() & (F.col("activity_month") >= F.col("cohort_month")))
          .withColumn("month_offset",
                      (F.year("activity_month") - F.year("cohort_month")) * 12
                      + (F.month("activity_month") - F.month("cohort_month"))))

    def retained(k: int) -> F.Column:
        return F.max((F.col("month_offset") == k) & (F.col("successful_tx_count") > 0))

    per_user = ca.groupBy("cohort_month", "user_sk").agg(
        F.sum("tx_count").alias("tx_count"),
        F.sum("total_amount").alias("total_amount"),
        F.sum("fraud_tx_count").alias("fraud_tx_count"),
        F.sum("avg_risk_score").alias("sum_user_month_score"),
        F.count("avg_risk_score").alias("n_user_months"),
        F.sum("high_risk_transactions").alias("high_risk_transactions"),
        retained(1).alias("r1"), retained(3).alias("r3"), retained(6).alias("r6"),
    )

    def mature(k: int) -> F.Column:
        return (F.col("cohort_month") + F.make_ym_interval(F.lit(0), F.lit(k))) <= F.col("_anchor_month")

    per_cohort = per_user.groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("cohort_size"),
        F.coalesce(F.sum("tx_count"), F.lit(0)).cast("long").alias("total_transactions"),
        F.coalesce(F.sum("total_amount"), F.lit(0)).alias("total_volume"),
        F.coalesce(F.sum("fraud_tx_count"), F.lit(0)).cast("long").alias("fraud_tx_count"),
        (F.sum("sum_user_month_score") / F.sum("n_user_months")).alias("_avg_score"),
        F.coalesce(F.sum("high_risk_transactions"), F.lit(0)).cast("long").alias("high_risk_transactions"),
        count_if(F.col("r1")).alias("_r1"), count_if(F.col("r3")).alias("_r3"), count_if(F.col("r6")).alias("_r6"),
    ).withColumn("_anchor_month", anchor_month)  # one subquery, referenced as a column
    cols = ["cohort_month", "cohort_size", "total_transactions", "total_volume",
            R.pct(F.col("fraud_tx_count"), F.col("total_transactions")).alias("fraud_rate_pct"),
            R.round_double(F.col("_avg_score")).alias("avg_fraud_risk_score"),
            "high_risk_transactions"]
    for k in (1, 3, 6):
        size_k = F.when(mature(k), F.col("cohort_size")).otherwise(F.lit(0)).cast("long")
        kept_k = F.when(mature(k), F.col(f"_r{k}")).otherwise(F.lit(0)).cast("long")
        cols.append(R.pct(kept_k, size_k, 1).alias(f"retention_{k}m_pct"))
    for k in (1, 3, 6):
        cols.append(F.when(mature(k), F.col("cohort_size")).otherwise(F.lit(0)).cast("long")
                    .alias(f"mature_{k}m_cohort_size"))
    return _stamp(per_cohort.select(*cols), as_of)


# --------------------------------------------------------------------------- A11
def fraud_analysis_mart(fct: DataFrame, dm: DataFrame) -> DataFrame:
    attrs = broadcast_if_small(
        dm.select("merchant_sk", "merchant_id", "merchant_name", "merchant_category", "is_high_risk_category"))
    return fct.drop("merchant_category").join(attrs, "merchant_sk", "left").select(
        "transaction_id", "amount", "currency", "payment_method", "device_type", "city", "state", "transaction_ts",
        "is_fraud", "fraud_risk_score", "fraud_risk_level", "fraud_reason", "merchant_id", "merchant_name",
        "merchant_category", "is_high_risk_category")


# --------------------------------------------------------------------------- P17-P22
VELOCITY_COLUMNS = ("transaction_id", "user_id", "transaction_ts", "transaction_date", "tx_hour",
                    "merchant_category", "payment_method", "amount", "device_type", "status", "tx_count_1h",
                    "tx_count_24h", "tx_same_category_24h")


def velocity_anomaly_detection(enr: DataFrame, cfg: RiskConfig = DEFAULT, as_of=None) -> DataFrame:
    """Ops queue: rows past any entry threshold, scored and banded.  A
    narrow filter on the enriched rows; no shuffle."""
    q = enr.where(velocity.queue_entry(cfg)).withColumn("velocity_score_h", velocity.velocity_score_hundredths(cfg))
    out = q.select(
        *VELOCITY_COLUMNS,
        velocity.hundredths_to_decimal(F.col("velocity_score_h")).alias("velocity_score"),
        velocity.alert_level(cfg).alias("velocity_alert_level"),
        velocity.is_critical(cfg).alias("is_critical"),
        velocity.action_required(cfg).alias("action_required"),
        velocity.breach_type(cfg).alias("velocity_breach_type"),
        "fraud_risk_score", "fraud_risk_level", "fraud_reason", "is_fraud")
    return _stamp(out, as_of)


# --------------------------------------------------------------------------- S1, S2, S6
# Row order the published tables are read in, with a key last so that it is a
# total one.  A stored table has no order: rows are sorted where they leave
# the warehouse (``for_sink``), or carry their place (``ranked``).
SINK_ORDER = {
    "daily_overview_kpis": [("day", True)],
    "daily_merchant_kpis": [("day", True), ("total_revenue", False), ("merchant_sk", True)],
    "fraud_analysis_mart": [("fraud_risk_score", False), ("transaction_ts", False), ("transaction_id", True)],
    "velocity_anomaly_detection": [("velocity_score", False), ("transaction_ts", False), ("transaction_id", True)],
}


def for_sink(name: str, df: DataFrame) -> DataFrame:
    """Sort a mart in its published order (a range-partitioned global sort)."""
    order = SINK_ORDER.get(name)
    if not order:
        return df
    return df.orderBy(*[F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in order])


def ranked(name: str, df: DataFrame) -> DataFrame:
    """A mart with the place of each row in its published order as ``rank``."""
    return with_rank(df, SINK_ORDER[name])
