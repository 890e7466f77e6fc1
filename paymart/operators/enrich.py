"""Enrichment: velocity counts, spike flags, risk score, level and reason."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.config import DEFAULT, RiskConfig
from paymart.functions import scoring
from paymart.operators.staging import stage_transactions
from paymart.operators.velocity_windows import velocity_counts


def enrich_transactions(stg: DataFrame, cfg: RiskConfig = DEFAULT, as_of: dt.datetime | None = None) -> DataFrame:
    """``int_transactions_enriched``: one row per staged transaction.

    The velocity counts are added in place (no self-join on transaction_id,
    which would give the same rows while transaction_id is unique), by
    ``velocity_counts``.  ``as_of`` adds the wall-clock
    ``dbt_updated_at`` column when given.
    """
    v = velocity_counts(stg, cfg)
    v = v.withColumns({
        "is_velocity_spike_1h": F.col("tx_count_1h") >= cfg.fraud_velocity_threshold_1h,
        "is_velocity_spike_24h": F.col("tx_count_24h") >= cfg.fraud_velocity_threshold_24h,
    })
    v = v.withColumn("fraud_risk_score", scoring.fraud_risk_score(cfg=cfg))
    cols = [scoring.surrogate_key("transaction_id").alias("transaction_sk")] + [F.col(c) for c in v.columns] + [
        scoring.risk_level("fraud_risk_score", cfg).alias("fraud_risk_level"),
        scoring.fraud_reason().alias("fraud_reason"),
    ]
    if as_of is not None:
        cols.append(F.lit(as_of).cast("timestamp").alias("dbt_updated_at"))
    return v.select(*cols)


def enrich_raw(raw_transactions: DataFrame, cfg: RiskConfig = DEFAULT, as_of=None) -> DataFrame:
    return enrich_transactions(stage_transactions(raw_transactions, cfg), cfg, as_of)
