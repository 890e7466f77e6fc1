"""Staging: typed projection of raw transactions plus calendar and flag columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.config import DEFAULT, RiskConfig
from paymart.functions import scoring

RAW_COLUMNS = ("transaction_id", "user_id", "merchant_id", "merchant_category", "payment_method", "amount",
               "currency", "status", "is_fraud", "device_type", "city", "state", "transaction_ts")


def stage_transactions(raw: DataFrame, cfg: RiskConfig = DEFAULT) -> DataFrame:
    ts = F.col("transaction_ts")
    return raw.select(
        *RAW_COLUMNS,
        F.col("created_at").alias("raw_loaded_at"),
        F.to_date(ts).alias("transaction_date"),
        F.hour(ts).alias("tx_hour"),
        scoring.day_of_week_sun0(ts).alias("tx_day_of_week"),
        scoring.odd_hour(ts, cfg).alias("is_odd_hour"),
        scoring.high_amount("amount", cfg).alias("is_high_amount"),
        scoring.risky_category("merchant_category", cfg).alias("is_risky_merchant_category"),
    )
