"""Data-quality checks (Q1-Q13): each returns failing rows or verdict rows.

Checks over one table are folded into one aggregate (one scan), then turned
into rows with ``inline``; checks over several tables are unions of such
one-row-per-check results.  A NULL value passes ``accepted_values`` and
``accepted_range`` tests, as in the warehouse's schema tests.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.config import (CURRENCIES, DEFAULT, DEVICE_TYPES, MERCHANT_CATEGORIES, MERCHANT_ID_PATTERN,
                            PAYMENT_METHODS, RISK_LEVELS, STATUSES, TRANSACTIONS_TABLE, USER_ID_PATTERN, RiskConfig)
from paymart.functions.scoring import count_if


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _checks_as_rows(df: DataFrame, model: str, checks: list[tuple[str, F.Column]], value_name: str) -> DataFrame:
    """One aggregate computing every check, exploded to (model, column, value)."""
    a = df.agg(*[c.alias(f"_c{i}") for i, (_, c) in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(model).alias("model"), F.lit(name).alias("column_name"),
                              F.col(f"_c{i}").cast("long").alias(value_name))
                     for i, (name, _) in enumerate(checks)])
    return a.select(F.inline(rows))


# The not-null checks per model.
NOT_NULL = {
    "raw.transactions": ("transaction_id", "user_id", "merchant_id", "merchant_category", "payment_method", "amount",
                         "currency", "status", "is_fraud", "device_type", "transaction_ts"),
    "raw.users": ("user_id", "age_group", "account_type"),
    "raw.merchants": ("merchant_id", "merchant_name", "merchant_category"),
    "stg_transactions": ("transaction_id", "user_id", "merchant_id", "merchant_category", "payment_method", "amount",
                         "currency", "status", "is_fraud", "transaction_ts", "transaction_date"),
    "int_transactions_enriched": ("transaction_sk", "transaction_id", "tx_count_1h", "tx_count_24h"),
    "int_user_metrics": ("user_sk", "user_id", "total_transactions", "avg_transaction_amount", "total_spend",
                         "fraud_count", "first_transaction_date", "last_transaction_date", "unique_categories_used",
                         "unique_merchants_used", "odd_hour_tx_count"),
}


def dq_not_null(models: dict[str, DataFrame]) -> DataFrame:
    """Q1: NULL count per (model, column)."""
    return _union([_checks_as_rows(models[m], m, [(c, count_if(F.col(c).isNull())) for c in cols], "failing_rows")
                   for m, cols in NOT_NULL.items() if m in models])


def dq_null_keys(tx: DataFrame) -> DataFrame:
    """Q11: rows with any of the four transaction keys NULL."""
    cond = (F.col("transaction_id").isNull() | F.col("user_id").isNull() | F.col("merchant_id").isNull()
            | F.col("transaction_ts").isNull())
    return tx.agg(count_if(cond).alias("null_key_rows"))


# The uniqueness checks per model.
UNIQUE = {
    "raw.transactions": ("transaction_id",), "raw.users": ("user_id",), "raw.merchants": ("merchant_id",),
    "stg_transactions": ("transaction_id",), "int_transactions_enriched": ("transaction_sk", "transaction_id"),
    "int_user_metrics": ("user_sk", "user_id"),
}


def _duplicate_keys(df: DataFrame, model: str, col: str) -> DataFrame:
    dup = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return dup.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                   F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("duplicate_rows")).select(
        F.lit(model).alias("model"), F.lit(col).alias("column_name"), "duplicate_keys", "duplicate_rows")


def dq_unique(models: dict[str, DataFrame]) -> DataFrame:
    """Q2: key values that occur more than once (NULLs excluded)."""
    return _union([_duplicate_keys(models[m], m, c) for m, cols in UNIQUE.items() if m in models for c in cols])


# Accepted-value domains per (model, column).
ACCEPTED = {
    "raw.transactions": {"merchant_category": MERCHANT_CATEGORIES, "payment_method": PAYMENT_METHODS,
                         "currency": CURRENCIES, "status": STATUSES, "is_fraud": (True, False),
                         "device_type": DEVICE_TYPES},
    "stg_transactions": {"is_odd_hour": (True, False), "is_high_amount": (True, False),
                         "is_risky_merchant_category": (True, False)},
    "int_transactions_enriched": {"fraud_risk_level": RISK_LEVELS, "is_velocity_spike_1h": (True, False),
                                  "is_velocity_spike_24h": (True, False)},
}


def dq_accepted_values(models: dict[str, DataFrame]) -> DataFrame:
    """Q3: rows whose value lies outside the accepted set (NULL passes)."""
    return _union([_checks_as_rows(models[m], m, [(c, count_if(~F.col(c).isin(*vals))) for c, vals in spec.items()],
                                   "failing_rows")
                   for m, spec in ACCEPTED.items() if m in models])


# Accepted ranges (inclusive).
RANGES = {
    "stg_transactions": {"tx_hour": (0, 23), "tx_day_of_week": (0, 6)},
    "int_transactions_enriched": {"fraud_risk_score": (0, 100)},
}


def dq_accepted_range(models: dict[str, DataFrame]) -> DataFrame:
    """Q4: rows outside [min, max] (NULL passes)."""
    return _union([_checks_as_rows(models[m], m, [(c, count_if(~F.col(c).between(lo, hi)))
                                                  for c, (lo, hi) in spec.items()], "failing_rows")
                   for m, spec in RANGES.items() if m in models])


def dq_score_range(enr: DataFrame) -> DataFrame:
    """Q5: the singular test - rows with a score outside 0..100."""
    return enr.where((F.col("fraud_risk_score") < 0) | (F.col("fraud_risk_score") > 100)) \
        .select("transaction_id", "fraud_risk_score")


def dq_orphans(tx: DataFrame, users: DataFrame, merchants: DataFrame) -> DataFrame:
    """Transactions whose user or merchant is missing (anti-joins)."""
    def orphan_rows(key: str, dim: DataFrame) -> DataFrame:
        # rows per key first (map-side combine), so only distinct keys meet the dimension
        per_key = tx.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        return per_key.join(dim.select(key), key, "left_anti")

    n_ou = orphan_rows("user_id", users).agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long")).scalar()
    om = orphan_rows("merchant_id", merchants)
    return om.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("orphan_merchants")).select(
        n_ou.alias("orphan_users"), "orphan_merchants")


def dq_row_counts(raw: dict[str, DataFrame], expected: dict[str, int] | None = None) -> DataFrame:
    """Q7: row count per raw table (and whether it equals an expected count)."""
    frames = []
    for name in ("users", "merchants", "transactions"):
        a = raw[name].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        if expected is not None:
            a = a.withColumn("matches_expected", F.col("row_count") == F.lit(expected.get(name)))
        frames.append(a)
    return _union(frames)


def require_schema(df: DataFrame, required, table: str) -> None:
    """Q8: required columns present (a schema check, no job)."""
    from paymart.sources.raw import require_columns
    require_columns(df, required, table)


def dq_key_format(users: DataFrame, merchants: DataFrame) -> DataFrame:
    """Q9: business keys that do not match their pattern."""
    u = _checks_as_rows(users, "raw.users", [("user_id", count_if(~F.col("user_id").rlike(USER_ID_PATTERN)))],
                        "failing_rows")
    m = _checks_as_rows(merchants, "raw.merchants",
                        [("merchant_id", count_if(~F.col("merchant_id").rlike(MERCHANT_ID_PATTERN)))], "failing_rows")
    return u.unionByName(m)


def dq_fraud_rate(tx: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """Q10: fraud rate within the target band."""
    lo = cfg.target_fraud_rate_pct - cfg.target_fraud_tolerance_pct
    hi = cfg.target_fraud_rate_pct + cfg.target_fraud_tolerance_pct
    a = tx.agg(count_if(F.col("is_fraud")).alias("_f"), F.count("is_fraud").alias("_n"))
    rate = F.col("_f").cast("double") * F.lit(100.0) / F.nullif(F.col("_n").cast("double"), F.lit(0.0))
    return a.select(rate.alias("fraud_rate_pct"), F.lit(lo).alias("lower_pct"), F.lit(hi).alias("upper_pct"),
                    F.coalesce(rate.between(lo, hi), F.lit(False)).alias("passed"))


def dq_status(tx: DataFrame) -> DataFrame:
    """Q12: distinct invalid statuses, NULL counted as invalid."""
    return tx.where(~F.col("status").isin(*STATUSES) | F.col("status").isNull()).select("status").distinct()


def dq_watermark(state: DataFrame, tx: DataFrame, table: str = TRANSACTIONS_TABLE) -> DataFrame:
    """Q13: the load-state row exists, counts the loaded rows and marks the
    newest loaded timestamp (two scalars compared)."""
    # one scalar subquery (a struct) = one pass over the table for both numbers
    facts = tx.agg(F.struct(F.count(F.lit(1)).alias("n"), F.max("transaction_ts").alias("mx"))).scalar()
    row = state.where(F.col("table_name") == table)
    a = row.agg(F.count(F.lit(1)).alias("_rows"), F.max("last_loaded_ts").alias("last_loaded_ts"),
                F.max("rows_loaded").alias("rows_loaded")).withColumn("_facts", facts).select(
        "_rows", "last_loaded_ts", "rows_loaded", F.col("_facts.mx").alias("max_transaction_ts"),
        F.col("_facts.n").alias("table_rows"))
    return a.select(
        (F.col("_rows") == 1).alias("row_exists"), "last_loaded_ts", "rows_loaded", "max_transaction_ts",
        "table_rows", F.coalesce(F.col("rows_loaded") == F.col("table_rows"), F.lit(False)).alias("rows_match"),
        F.coalesce(F.col("last_loaded_ts") == F.col("max_transaction_ts"), F.lit(False)).alias("mark_matches_max"))
