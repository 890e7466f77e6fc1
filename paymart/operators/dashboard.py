"""Dashboard and report aggregates (D1-D12) and top-k lists.

All are aggregates or filters over the fact, the enriched rows and the
marts.  Top-k lists sort with a full tie-break so the k rows are
deterministic; Spark plans ``orderBy(...).limit(k)`` as a per-partition
top-k followed by a single merge of k rows per partition
(TakeOrderedAndProject), never a global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paymart.config import (DEFAULT, MERCHANT_TIERS, MONETARY_SEGMENTS, RECENCY_SEGMENTS, STEP_UP_CATEGORIES,
                            STEP_UP_MIN_AMOUNT, RiskConfig)
from paymart.functions.rounding import money, safe_ratio
from paymart.functions.scoring import count_if, flag_true


def _fraud() -> F.Column:
    return flag_true("is_fraud")


def _fraud_measures():
    return [F.count(F.lit(1)).alias("transactions"),
            count_if(_fraud()).alias("fraud_transactions"),
            money(F.coalesce(F.sum(F.when(_fraud(), F.col("amount"))), F.lit(0))).alias("fraud_loss")]


def by_risk_level(fct: DataFrame) -> DataFrame:
    """D1."""
    return fct.groupBy("fraud_risk_level").agg(*_fraud_measures())


def by_fraud_reason(fct: DataFrame) -> DataFrame:
    """Whole reason string; the NULL (no reason) group is kept."""
    return fct.groupBy("fraud_reason").agg(*_fraud_measures())


def _over_all_groups(col: str) -> F.Column:
    """Grand total taken from the (few) grouped rows, not a second pass over
    the fact."""
    return F.sum(col).over(Window.partitionBy(F.lit(0)))


def status_split(fct: DataFrame) -> DataFrame:
    """D3: transactions per status, share of all, average ticket."""
    a = fct.groupBy("status").agg(F.count(F.lit(1)).alias("transactions"), F.sum("amount").alias("_amt"),
                                  F.count("amount").alias("_n_amt"))
    return a.select("status", "transactions",
                    safe_ratio(F.col("transactions"), _over_all_groups("transactions")).alias("share"),
                    safe_ratio(F.col("_amt"), F.col("_n_amt")).alias("avg_ticket"))


def method_share(fct: DataFrame) -> DataFrame:
    """D3: payment-method share of amount volume."""
    a = fct.groupBy("payment_method").agg(F.count(F.lit(1)).alias("transactions"), F.sum("amount").alias("_vol"))
    return a.select("payment_method", "transactions", money(F.col("_vol")).alias("volume"),
                    safe_ratio(F.col("_vol"), _over_all_groups("_vol")).alias("share_of_volume"))


def slice_by(fct: DataFrame, column: str) -> DataFrame:
    """Fact measures sliced by one attribute (method, city, category)."""
    return fct.groupBy(column).agg(
        F.count(F.lit(1)).alias("transactions"),
        money(F.coalesce(F.sum("amount"), F.lit(0))).alias("volume"),
        count_if(_fraud()).alias("fraud_transactions"),
        money(F.coalesce(F.sum(F.when(_fraud(), F.col("amount"))), F.lit(0))).alias("fraud_loss"),
        count_if(F.col("status") == "success").alias("success_transactions"))


def hour_category_heatmap(hourly: DataFrame) -> DataFrame:
    """Hour x category fraud rate = sum(fraud) / sum(transactions) over
    payment methods (never a mean of percentages)."""
    a = hourly.groupBy("tx_hour", "merchant_category").agg(
        F.sum("total_transactions").alias("transactions"),
        F.sum("fraud_transactions").alias("fraud_transactions"))
    return a.select("tx_hour", "merchant_category", "transactions", "fraud_transactions",
                    safe_ratio(F.col("fraud_transactions"), F.col("transactions")).alias("fraud_rate"))


def fraud_loss_category_method(fct: DataFrame) -> DataFrame:
    """Fraud loss by category x method (sorted descending at the sink)."""
    return fct.groupBy("merchant_category", "payment_method").agg(*_fraud_measures())


def merchant_review_list(profile: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Reliable merchants that are High Risk or above the high fraud %."""
    return profile.where(F.col("is_rate_reliable") & (
        (F.col("merchant_risk_category") == MERCHANT_TIERS[2])
        | (F.col("fraud_rate_pct") > cfg.merchant_risk_high_fraud_rate_pct)))


def alert_action_share(queue: DataFrame) -> DataFrame:
    """Share of queue rows flagged ``action_required``."""
    a = queue.agg(F.count(F.lit(1)).alias("queue_rows"), count_if(F.col("action_required")).alias("action_rows"))
    return a.select("queue_rows", "action_rows",
                    safe_ratio(F.col("action_rows"), F.col("queue_rows")).alias("action_share"))


def segment_matrix(segments: DataFrame) -> DataFrame:
    """Customers by fraud segment x monetary segment."""
    return segments.groupBy("fraud_segment", "monetary_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        money(F.sum("monetary_value")).alias("monetary_value"),
        F.sum("fraud_count").cast("long").alias("fraud_transactions"))


def step_up_candidates(fct: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Risky-category, high-ticket, odd-hour transactions (a pushed-down
    filter over the fact)."""
    return fct.where(F.col("merchant_category").isin(*STEP_UP_CATEGORIES)
                     & (F.col("amount") > STEP_UP_MIN_AMOUNT)
                     & F.hour("transaction_ts").between(cfg.odd_hour_start, cfg.odd_hour_end)).select(
        "transaction_id", "user_sk", "merchant_sk", "merchant_category", "payment_method", "amount",
        "transaction_ts", "is_fraud", "fraud_risk_score", "fraud_risk_level")


def win_back_list(segments: DataFrame) -> DataFrame:
    """High-value lapsed customers without fraud."""
    return segments.where((F.col("monetary_segment") == MONETARY_SEGMENTS[0])
                          & (F.col("recency_segment") == RECENCY_SEGMENTS[2])
                          & (F.col("fraud_count") == 0))


def monthly_risk_report(fct: DataFrame, queue: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Per month fraud rate and loss, the action backlog of the velocity
    queue, and merchants whose fraud % in that month exceeds the high bar
    with at least the reliability volume.  Three monthly aggregates joined
    on month (each is at most one row per month)."""
    month = F.date_trunc("month", "transaction_ts").alias("month")
    base = fct.groupBy(month).agg(
        F.count(F.lit(1)).alias("transactions"), count_if(_fraud()).alias("fraud_transactions"),
        F.coalesce(F.sum(F.when(_fraud(), F.col("amount"))), F.lit(0)).alias("_loss"))
    backlog = queue.groupBy(F.date_trunc("month", "transaction_ts").alias("month")).agg(
        count_if(F.col("action_required")).alias("queue_backlog"))
    per_merchant = fct.where(F.col("merchant_sk").isNotNull()).groupBy(month, "merchant_sk").agg(
        F.count(F.lit(1)).alias("n"), count_if(_fraud()).alias("f"))
    hot = per_merchant.where((F.col("n") >= cfg.merchant_risk_min_transactions)
                             & (F.col("f") * 100 > F.col("n") * cfg.merchant_risk_high_fraud_rate_pct)) \
        .groupBy("month").agg(F.count(F.lit(1)).alias("merchants_above_threshold"))
    j = base.join(backlog, "month", "left").join(hot, "month", "left")
    return j.select(
        "month", "transactions", "fraud_transactions",
        safe_ratio(F.col("fraud_transactions"), F.col("transactions")).alias("fraud_rate"),
        money(F.col("_loss")).alias("fraud_loss"),
        F.coalesce(F.col("queue_backlog"), F.lit(0)).cast("long").alias("queue_backlog"),
        F.coalesce(F.col("merchants_above_threshold"), F.lit(0)).cast("long").alias("merchants_above_threshold"))


# ------------------------------------------------------------------ top-k
def top_reliable_merchants(profile: DataFrame, n: int = 10) -> DataFrame:
    """Highest fraud % among merchants with a reliable rate."""
    return (profile.where(F.col("is_rate_reliable"))
            .orderBy(F.col("fraud_rate_pct").desc(), F.col("merchant_id").asc()).limit(n))


def top_velocity_users(queue: DataFrame, n: int = 20) -> DataFrame:
    """Users ranked by their highest velocity score, then by how many
    queue rows they have."""
    a = queue.groupBy("user_id").agg(F.max("velocity_score").alias("max_velocity_score"),
                                     F.count(F.lit(1)).alias("queue_rows"),
                                     count_if(F.col("action_required")).alias("action_rows"))
    return a.orderBy(F.col("max_velocity_score").desc(), F.col("queue_rows").desc(), F.col("user_id")).limit(n)


def top_merchants_by_fraud_loss(fct: DataFrame, dm: DataFrame, cfg: RiskConfig = DEFAULT, n: int = 10) -> DataFrame:
    """Grouped by merchant *name and category* (not id), volume of
    at least the reliability bar and some fraud.  The fact is aggregated by
    merchant key first, joined to the dimension, then re-grouped by name."""
    per_key = fct.where(F.col("merchant_sk").isNotNull()).groupBy("merchant_sk").agg(
        F.count("transaction_id").alias("n"), count_if(_fraud()).alias("f"),
        F.sum(F.when(_fraud(), F.col("amount")).otherwise(F.lit(0))).alias("loss"))
    j = per_key.join(dm.select("merchant_sk", "merchant_name", "merchant_category"), "merchant_sk", "inner")
    g = j.groupBy("merchant_name", "merchant_category").agg(
        F.sum("n").alias("n"), F.sum("f").alias("f"), F.sum("loss").alias("fraud_loss_inr"))
    g = g.where((F.col("n") >= cfg.merchant_risk_min_transactions) & (F.col("f") > 0))
    return (g.orderBy(F.col("fraud_loss_inr").desc(), "merchant_name", "merchant_category").limit(n)
            .select("merchant_name", "merchant_category", money(F.col("fraud_loss_inr")).alias("fraud_loss_inr")))
