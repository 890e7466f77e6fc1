"""Customer and merchant segment labels as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paymart.config import (DEFAULT, FRAUD_SEGMENTS, FREQUENCY_SEGMENTS, MERCHANT_TIERS, MONETARY_SEGMENTS,
                            RECENCY_SEGMENTS, RiskConfig)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def recency_segment(days="recency_days", cfg: RiskConfig = DEFAULT) -> Column:
    d = _c(days)
    active, recent, lapsed, inactive = RECENCY_SEGMENTS
    return (F.when(d <= cfg.recency_active_days, active)
            .when(d <= cfg.recency_recent_days, recent)
            .when(d <= cfg.recency_lapsed_days, lapsed)
            .otherwise(inactive))


def frequency_segment(freq="frequency", cfg: RiskConfig = DEFAULT) -> Column:
    f = _c(freq)
    high, medium, low = FREQUENCY_SEGMENTS
    return F.when(f >= cfg.frequency_high, high).when(f >= cfg.frequency_medium, medium).otherwise(low)


def monetary_segment(value="monetary_value", cfg: RiskConfig = DEFAULT) -> Column:
    v = _c(value)
    high, medium, low = MONETARY_SEGMENTS
    return F.when(v >= cfg.monetary_high, high).when(v >= cfg.monetary_medium, medium).otherwise(low)


def fraud_segment(count="fraud_count", cfg: RiskConfig = DEFAULT) -> Column:
    c = _c(count)
    repeat, single, clean = FRAUD_SEGMENTS
    return F.when(c >= cfg.fraud_repeat, repeat).when(c >= cfg.fraud_single, single).otherwise(clean)


def merchant_tier(total="total_transactions", fraud="fraud_transactions", score_hi=None, score_med=None,
                  cfg: RiskConfig = DEFAULT, volume_tiers: bool = True) -> Column:
    """Merchant risk bucket.

    ``score_hi`` / ``score_med`` are boolean Columns telling whether the
    merchant's average risk score reaches the high / medium bar (the mart
    compares the rounded average, the scatter analysis the raw one).  The
    fraud-rate comparison ``fraud * 100 / total >= p`` is done in integers.
    """
    n, f = _c(total), _c(fraud)
    high = (f * 100 >= n * cfg.merchant_risk_high_fraud_rate_pct) | score_hi
    med = (f * 100 >= n * cfg.merchant_risk_medium_fraud_rate_pct) | score_med
    idle, thin, t_high, t_med, t_low = MERCHANT_TIERS
    tier = F.when(F.coalesce(high, F.lit(False)), t_high).when(F.coalesce(med, F.lit(False)), t_med) \
        .otherwise(t_low)
    if not volume_tiers:
        return tier
    return (F.when(n == 0, idle)
            .when(n < cfg.merchant_risk_min_transactions, thin)
            .otherwise(tier))
