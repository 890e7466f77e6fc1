"""Exploratory analyses (E1-E20): the data behind every notebook chart.

The notebooks pull the whole merged fact to one machine and use pandas;
here each analysis stays a distributed aggregate and only its small result
leaves the executors.  Wide matrices are built with ``pivot`` over a fixed
value list (no extra pass to discover the values).  Money sums stay decimal
until the final division.  Ratios of counts are ``count * 100 / total`` in
double arithmetic, the same IEEE steps in any engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paymart.config import (AMOUNT_BUCKETS, DAY_ORDER, DEFAULT, PAYMENT_METHODS, SCORE_BUCKETS, STATUSES, TERTILES,
                            RiskConfig)
from paymart.functions import rounding, segments
from paymart.functions.rounding import idiv, money, round_double
from paymart.functions.scoring import count_if, flag_true
from paymart.operators.joins import broadcast_if_small


def pct_double(num: F.Column, den: F.Column) -> F.Column:
    """``num * 100 / den`` in double arithmetic; NULL when den is 0."""
    return num.cast("double") * F.lit(100.0) / F.nullif(den.cast("double"), F.lit(0.0))


def rate_double(num: F.Column, den: F.Column) -> F.Column:
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


# ------------------------------------------------------------------ frame
def merged_fact(fct: DataFrame, du: DataFrame, dm: DataFrame) -> DataFrame:
    """Fact with business keys looked up from both dimensions."""
    return (fct.join(broadcast_if_small(du.select("user_sk", "user_id")), "user_sk", "left")
            .join(broadcast_if_small(dm.select("merchant_sk", "merchant_id")), "merchant_sk", "left")
            .select("transaction_id", "user_id", "merchant_id", "merchant_category", "payment_method", "amount",
                    "currency", "status", "is_fraud", "device_type", "city", "state", "transaction_ts"))


def prepare_transactions(merged: DataFrame) -> DataFrame:
    """Numeric amount (unparseable -> NULL), month label, success
    flag, and the conditional fraud / success amounts.

    Takes the merged frame (business keys) or the fact itself (surrogate
    keys, one-to-one with the business keys): analyses that only group by
    user do not need the dimension lookups."""
    amount = F.col("amount").try_cast("decimal(12,2)")
    keys = [c for c in ("user_id", "merchant_id", "user_sk", "merchant_sk") if c in merged.columns]
    return merged.select(
        "transaction_id", *keys, "merchant_category", "payment_method",
        amount.alias("amount"), "currency", "status", flag_true("is_fraud").alias("is_fraud"), "device_type",
        "city", "state", "transaction_ts",
        F.date_format("transaction_ts", "yyyy-MM").alias("month"),
        (F.coalesce(F.col("status") == "success", F.lit(False))).alias("is_success"),
    ).withColumns({
        "fraud_amount": F.when(F.col("is_fraud"), F.col("amount")).otherwise(F.lit(0)),
        "success_amount": F.when(F.col("is_success"), F.col("amount")).otherwise(F.lit(0)),
    })


def amount_coercion_report(merged: DataFrame) -> DataFrame:
    """How many amounts the numeric coercion turned into NULL (the
    notebooks log this count as a warning)."""
    coerced = F.col("amount").isNotNull() & F.col("amount").try_cast("decimal(12,2)").isNull()
    return merged.agg(F.count(F.lit(1)).alias("rows"), count_if(coerced).alias("coerced_to_null"),
                      count_if(F.col("amount").isNull()).alias("null_amounts"))


# ------------------------------------------------------------------ E1-E8
def eda_headline(df: DataFrame) -> DataFrame:
    """Attempt volume, success GMV, capture rate (NULL with no attempts)."""
    a = df.agg(F.sum("amount").alias("_att"), F.sum("success_amount").alias("_gmv"))
    att = F.coalesce(F.col("_att"), F.lit(0))
    return a.select(money(att).alias("attempt_volume"), money(F.coalesce(F.col("_gmv"), F.lit(0))).alias("success_gmv"),
                    F.when(att > 0, rate_double(F.col("_gmv"), att)).alias("capture_rate"))


def eda_monthly_volume(df: DataFrame) -> DataFrame:
    """E2."""
    return df.groupBy("month").agg(
        money(F.sum("amount")).alias("attempt_volume"),
        money(F.sum("success_amount")).alias("success_gmv"),
        rate_double(count_if(F.col("is_success")), F.count(F.lit(1))).alias("success_rate"))


def eda_status_mix(df: DataFrame) -> DataFrame:
    """The four statuses in fixed order; a status that never occurs has
    a NULL count (one aggregate row exploded into four)."""
    a = df.agg(*[count_if(F.col("status") == s).alias(f"_n{i}") for i, s in enumerate(STATUSES)])
    rows = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(s).alias("status"),
                              F.when(F.col(f"_n{i}") > 0, F.col(f"_n{i}")).alias("transactions"))
                     for i, s in enumerate(STATUSES)])
    return a.select(F.inline(rows))


def daily_success_rate_ma7(df: DataFrame) -> DataFrame:
    """Daily success %, its 7-row moving average (rows are days with
    data; from the first row on) and the platform average.  Both windows run
    over the daily aggregate (one row per calendar day), so the fact is read
    once."""
    daily = df.groupBy(F.to_date("transaction_ts").alias("day")).agg(
        count_if(F.col("is_success")).alias("_s"), F.count(F.lit(1)).alias("_n"))
    everything = Window.partitionBy(F.lit(0))
    platform = pct_double(F.sum("_s").over(everything), F.sum("_n").over(everything))
    w = Window.orderBy("day").rowsBetween(-6, 0)
    daily = daily.select("day", pct_double(F.col("_s"), F.col("_n")).alias("pct"), platform.alias("platform_pct"))
    return daily.select("day", "pct", round_double(F.avg("pct").over(w), 6).alias("ma7"), "platform_pct")


def _snake(v: str) -> str:
    return v.lower().replace(" ", "_").replace("&", "and")


def payment_mix_by_month(df: DataFrame, methods=PAYMENT_METHODS) -> DataFrame:
    """Method share of each month's transactions, absent = 0
    (pivot over the fixed method list)."""
    p = df.groupBy("month").pivot("payment_method", list(methods)).agg(F.count(F.lit(1)))
    total = sum((F.coalesce(F.col(m), F.lit(0)) for m in methods), F.lit(0))
    return p.select("month", *[pct_double(F.coalesce(F.col(m), F.lit(0)), total).alias(f"share_{_snake(m)}")
                               for m in methods])


def success_rate_by_method(df: DataFrame, min_n: int = 100) -> DataFrame:
    """Methods with at least ``min_n`` transactions."""
    a = df.groupBy("payment_method").agg(count_if(F.col("is_success")).alias("_s"), F.count(F.lit(1)).alias("n"))
    return a.where(F.col("n") >= min_n).select("payment_method", rate_double(F.col("_s"), F.col("n")).alias("rate"), "n")


def fail_decline_by_method(df: DataFrame, min_n: int = 100) -> DataFrame:
    """E7."""
    a = df.groupBy("payment_method").agg(F.count(F.lit(1)).alias("total"),
                                         count_if(F.col("status").isin("failed", "declined")).alias("bad"))
    return a.where(F.col("total") >= min_n).select("payment_method", "total", "bad",
                                                   pct_double(F.col("bad"), F.col("total")).alias("rate"))


def monthly_atv(df: DataFrame) -> DataFrame:
    """Mean ticket of all attempts, and of successful amounts > 0."""
    ok = F.col("success_amount") > 0
    return df.groupBy("month").agg(
        rate_double(F.sum("amount"), F.count("amount")).alias("attempt_atv"),
        rate_double(F.sum(F.when(ok, F.col("success_amount"))), count_if(ok)).alias("success_atv"))


# ------------------------------------------------------------------ E9-E13
def monthly_fraud_rate(df: DataFrame) -> DataFrame:
    """Monthly fraud % next to the platform % (summed from the monthly
    rows; one pass over the fact)."""
    m = df.groupBy("month").agg(count_if(F.col("is_fraud")).alias("_f"), F.count(F.lit(1)).alias("_n"))
    everything = Window.partitionBy(F.lit(0))
    return m.select("month", pct_double(F.col("_f"), F.col("_n")).alias("fraud_rate_pct"),
                    pct_double(F.sum("_f").over(everything), F.sum("_n").over(everything))
                    .alias("platform_fraud_rate_pct"))


def monthly_fraud_loss(df: DataFrame) -> DataFrame:
    """E10."""
    return df.groupBy("month").agg(money(F.sum("fraud_amount")).alias("fraud_loss_inr"))


def fraud_matrix_category_method(df: DataFrame, methods=PAYMENT_METHODS) -> DataFrame:
    """Fraud % per category (rows) x method (columns); empty cell NULL."""
    cell = df.groupBy("merchant_category", "payment_method").agg(
        pct_double(count_if(F.col("is_fraud")), F.count(F.lit(1))).alias("pct"))
    p = cell.groupBy("merchant_category").pivot("payment_method", list(methods)).agg(F.first("pct"))
    return p.select("merchant_category", *[F.col(m).alias(f"fraud_pct_{_snake(m)}") for m in methods])


def _amount_bucket(amount: F.Column):
    label, order = None, None
    for i, (lo, name) in reversed(list(enumerate(AMOUNT_BUCKETS))):
        cond = amount >= lo
        label = F.when(cond, name) if label is None else label.when(cond, name)
        order = F.when(cond, i) if order is None else order.when(cond, i)
    return label, order


def fraud_by_amount_bucket(df: DataFrame) -> DataFrame:
    """Observed buckets with transactions, fraud count, loss and rate;
    ``has_loss`` marks the buckets the chart keeps."""
    label, order = _amount_bucket(F.col("amount"))
    a = (df.where(F.col("amount") >= 0)
         .groupBy(label.alias("amount_bucket"), order.alias("bucket_order"))
         .agg(F.count("transaction_id").alias("txns"), count_if(F.col("is_fraud")).alias("fraud_txns"),
              F.sum("fraud_amount").alias("_loss")))
    return a.select("amount_bucket", "bucket_order", "txns", "fraud_txns", money(F.col("_loss")).alias("fraud_loss"),
                    pct_double(F.col("fraud_txns"), F.col("txns")).alias("fraud_rate"),
                    (F.col("_loss") > 0).alias("has_loss"))


def fraud_matrix_dow_hour(df: DataFrame) -> DataFrame:
    """Fraud % per weekday (rows, Monday first) x hour (24 columns)."""
    cell = df.groupBy(F.date_format("transaction_ts", "EEEE").alias("dow"),
                      F.hour("transaction_ts").alias("hour")).agg(
        pct_double(count_if(F.col("is_fraud")), F.count(F.lit(1))).alias("pct"))
    p = cell.groupBy("dow").pivot("hour", list(range(24))).agg(F.first("pct"))
    order = None
    for i, d in enumerate(DAY_ORDER):
        order = F.when(F.col("dow") == d, i + 1) if order is None else order.when(F.col("dow") == d, i + 1)
    return p.select("dow", order.alias("dow_order"), *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)])


# ------------------------------------------------------------------ E14-E15
def _round_half_even_pct(num: F.Column, den: F.Column) -> F.Column:
    """round(num * 100 / den) to an integer, ties to even, exactly."""
    n = num.cast("long") * 100
    d = den.cast("long")
    q, r = idiv(n, d), n % d
    up = (r * 2 > d) | ((r * 2 == d) & (q % 2 == 1))
    return (q + F.when(up, 1).otherwise(0)).cast("double")


def _user_key(df: DataFrame) -> str:
    return "user_id" if "user_id" in df.columns else "user_sk"


def eda_cohort_matrix(df: DataFrame, max_offset: int = 5) -> DataFrame:
    """cohort = month of a user's first transaction of any status; %
    of the cohort active at month offsets 0..5, rounded half to even.

    Per-user first month is an aggregate; activity is the distinct
    (user, month) set; both are grouped data, so no per-row join happens."""
    user = _user_key(df)
    um = (df.where(F.col(user).isNotNull())
          .select(user, F.date_trunc("month", "transaction_ts").alias("activity")).distinct())
    cohort = F.min("activity").over(Window.partitionBy(user))
    off = um.withColumn("cohort", cohort).withColumn(
        "offset", (F.year("activity") - F.year("cohort")) * 12 + (F.month("activity") - F.month("cohort")))
    off = off.where(F.col("offset").between(0, max_offset))
    p = off.groupBy(F.date_format("cohort", "yyyy-MM").alias("cohort")).pivot(
        "offset", list(range(max_offset + 1))).agg(F.count(F.lit(1)))
    size = F.col("0")
    return p.select("cohort", *[_round_half_even_pct(F.coalesce(F.col(str(k)), F.lit(0)), size).alias(f"m{k}")
                                for k in range(max_offset + 1)])


def fraud_loss_tertiles(df: DataFrame) -> DataFrame:
    """Users cut into tertiles of their fraud-transaction count (exact
    interpolated quantiles; a value equal to a cut point goes to the lower
    bin).  The cut points are one global aggregate over per-user counts."""
    user = _user_key(df)
    per_user = df.where(F.col(user).isNotNull()).groupBy(user).agg(
        count_if(F.col("is_fraud")).alias("fraud_txns"), F.sum("fraud_amount").alias("fraud_loss"))
    cuts = per_user.agg(F.percentile(F.col("fraud_txns"), F.array(F.lit(1.0 / 3), F.lit(2.0 / 3)))).scalar()
    x = F.col("fraud_txns")
    seg = F.when(x <= F.col("_cuts")[0], TERTILES[0]).when(x <= F.col("_cuts")[1], TERTILES[1]).otherwise(TERTILES[2])
    a = per_user.withColumn("_cuts", cuts).groupBy(seg.alias("segment")).agg(
        F.count(F.lit(1)).alias("users"), rate_double(F.sum("fraud_txns"), F.count(F.lit(1))).alias("fraud_txns"),
        F.sum("fraud_loss").alias("_loss"))
    # loss share: the grand total is the sum over the (three) segment rows
    total = F.sum("_loss").over(Window.partitionBy(F.lit(1)))
    order = F.when(F.col("segment") == TERTILES[0], 1).when(F.col("segment") == TERTILES[1], 2).otherwise(3)
    return a.select("segment", order.alias("segment_order"), "users", "fraud_txns",
                    money(F.col("_loss")).alias("fraud_loss"), total.alias("_total")).select(
        "segment", "segment_order", "users", "fraud_txns", "fraud_loss",
        F.when(F.col("_total") > 0, pct_double(F.col("fraud_loss"), F.col("_total"))).otherwise(F.lit(0.0))
        .alias("loss_share_pct"))


# ------------------------------------------------------------------ E16-E20
def risk_calibration(enr: DataFrame) -> DataFrame:
    """Observed fraud rate per score bucket (0,30] (30,50] (50,70]
    (70,100], 0 counted in the first."""
    s = F.col("fraud_risk_score")
    label, order = None, None
    for i, (hi, name) in enumerate(SCORE_BUCKETS):
        cond = (s >= 0) & (s <= hi)
        label = F.when(cond, name) if label is None else label.when(cond, name)
        order = F.when(cond, i + 1) if order is None else order.when(cond, i + 1)
    a = enr.where(label.isNotNull()).groupBy(label.alias("bucket"), order.alias("bucket_order")).agg(
        F.count(F.lit(1)).alias("txns"), count_if(flag_true("is_fraud")).alias("_f"))
    return a.select("bucket", "bucket_order", rate_double(F.col("_f"), F.col("txns")).alias("observed_fraud_rate"),
                    "txns")


def merchant_scatter(fct: DataFrame, dm: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Merchants with at least the reliability volume; tier from the
    *unrounded* mean score and no volume tiers."""
    agg = fct.where(F.col("merchant_sk").isNotNull()).groupBy("merchant_sk").agg(
        F.sum("amount").alias("_vol"), F.count("transaction_id").alias("total_transactions"),
        count_if(flag_true("is_fraud")).alias("_f"), F.sum("fraud_risk_score").alias("_ss"),
        F.count("fraud_risk_score").alias("_sn"))
    j = agg.join(dm.select("merchant_sk", "merchant_id"), "merchant_sk", "inner")
    j = j.where(F.col("total_transactions") >= cfg.merchant_risk_min_transactions)
    ss, sn = F.col("_ss"), F.col("_sn")
    tier = segments.merchant_tier(
        F.col("total_transactions"), F.col("_f"),
        (sn > 0) & (ss >= sn * cfg.merchant_risk_high_avg_score),
        (sn > 0) & (ss >= sn * cfg.merchant_risk_medium_avg_score), cfg, volume_tiers=False)
    return j.select("merchant_id", money(F.coalesce(F.col("_vol"), F.lit(0))).alias("total_volume"),
                    "total_transactions", rounding.pct(F.col("_f"), F.col("total_transactions")).alias("fraud_rate_pct"),
                    tier.alias("merchant_risk_category"))


def velocity_uplift(enr: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Fraud % of velocity-flagged rows over the platform fraud %."""
    flagged = (F.col("tx_count_1h") >= cfg.fraud_velocity_threshold_1h) | (
        F.col("tx_count_24h") >= cfg.fraud_velocity_threshold_24h)
    fraud = flag_true("is_fraud")
    a = enr.agg(F.count(F.lit(1)).alias("_n"), count_if(fraud).alias("_f"),
                count_if(flagged).alias("_vn"), count_if(flagged & fraud).alias("_vf"))
    base = pct_double(F.col("_f"), F.col("_n"))
    vel = pct_double(F.col("_vf"), F.col("_vn"))
    return a.select(base.alias("baseline_fraud_pct"), vel.alias("flagged_fraud_pct"),
                    F.col("_vn").alias("flagged_rows"),
                    F.when(base > 0, vel / base).alias("uplift"))


def data_sanity(df: DataFrame) -> DataFrame:
    """Rows, date range, success and fraud rate, fraud loss."""
    a = df.agg(F.count(F.lit(1)).alias("rows"), F.min("transaction_ts").alias("min_ts"),
               F.max("transaction_ts").alias("max_ts"), count_if(F.col("is_success")).alias("_s"),
               count_if(F.col("is_fraud")).alias("_f"),
               F.sum(F.when(F.col("is_fraud"), F.col("amount"))).alias("_loss"))
    return a.select("rows", "min_ts", "max_ts", rate_double(F.col("_s"), F.col("rows")).alias("success_rate"),
                    rate_double(F.col("_f"), F.col("rows")).alias("fraud_rate"),
                    money(F.coalesce(F.col("_loss"), F.lit(0))).alias("fraud_loss"))
