"""Velocity-queue scoring and banding as Column expressions.

The velocity score mixes integer counts with decimal weights (1.8, 2.5,
0.12) and is stored as numeric(5,2).  Every term has at most two decimals, so
the score is computed exactly in integer hundredths and only converted to a
decimal at the end; the bands compare the hundredths, which is the same as
comparing the numeric(5,2) value.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from paymart.config import ALERT_LEVELS, BREACH_TYPES, DEFAULT, RiskConfig


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _hundredths(value) -> int:
    h = Decimal(str(value)) * 100
    if h != h.to_integral_value():
        raise ValueError(f"weight {value} has more than two decimals")
    return int(h)


def _capped(count: Column, base: int, mult, cap: int) -> Column:
    """least(cap, greatest(0, (count - base) * mult)) in hundredths."""
    return F.least(F.lit(cap * 100), F.greatest(F.lit(0), (count - base) * _hundredths(mult)))


def velocity_score_hundredths(cfg: RiskConfig = DEFAULT, n1h="tx_count_1h", n24h="tx_count_24h",
                              ncat="tx_same_category_24h", high="is_high_amount", odd="is_odd_hour",
                              risk="fraud_risk_score") -> Column:
    total = (
        _capped(_c(n1h), cfg.velocity_score_base_1h, cfg.velocity_score_mult_1h, cfg.velocity_score_cap_1h)
        + _capped(_c(n24h), cfg.velocity_score_base_24h, cfg.velocity_score_mult_24h, cfg.velocity_score_cap_24h)
        + _capped(_c(ncat), cfg.velocity_score_base_category, cfg.velocity_score_mult_category,
                  cfg.velocity_score_cap_category)
        + F.when(_c(high), F.lit(cfg.velocity_score_high_amount_pts * 100)).otherwise(F.lit(0))
        + F.when(_c(odd), F.lit(cfg.velocity_score_odd_hour_pts * 100)).otherwise(F.lit(0))
        + F.least(F.lit(cfg.velocity_score_fraud_cap * 100), _c(risk) * _hundredths(cfg.velocity_score_fraud_mult))
    )
    return F.least(F.lit(10000), F.greatest(F.lit(0), total)).cast("long")


def hundredths_to_decimal(h: Column) -> Column:
    """Integer hundredths -> numeric(5,2)."""
    return (h.cast("decimal(7,0)") / F.lit(100)).cast("decimal(5,2)")


def alert_level(cfg: RiskConfig = DEFAULT, score_h="velocity_score_h") -> Column:
    s, n1, n24, nc = _c(score_h), F.col("tx_count_1h"), F.col("tx_count_24h"), F.col("tx_same_category_24h")
    risk, amount = F.col("fraud_risk_score"), F.col("amount")
    critical = ((s >= cfg.velocity_score_critical * 100)
                | ((n1 >= cfg.velocity_tx_1h_critical) & (risk >= cfg.velocity_fraud_score_critical))
                | ((n1 >= cfg.velocity_tx_1h_high) & (n24 >= cfg.velocity_tx_24h_critical_combo)))
    high = ((s >= cfg.velocity_score_high * 100)
            | ((n1 >= cfg.velocity_tx_1h_high) & (n24 >= cfg.velocity_tx_24h_high))
            | ((nc >= cfg.velocity_category_high) & (amount > cfg.velocity_high_amount_threshold)))
    medium = ((s >= cfg.velocity_score_medium * 100) | (n1 >= cfg.velocity_tx_1h_medium)
              | (n24 >= cfg.velocity_tx_24h_medium))
    l_crit, l_high, l_med, l_low = ALERT_LEVELS
    return (F.when(F.coalesce(critical, F.lit(False)), l_crit)
            .when(F.coalesce(high, F.lit(False)), l_high)
            .when(F.coalesce(medium, F.lit(False)), l_med)
            .otherwise(l_low))


def is_critical(cfg: RiskConfig = DEFAULT, score_h="velocity_score_h") -> Column:
    s, n1, risk = _c(score_h), F.col("tx_count_1h"), F.col("fraud_risk_score")
    cond = (s >= cfg.velocity_score_critical * 100) | (
        (n1 >= cfg.velocity_tx_1h_critical) & (risk >= cfg.velocity_fraud_score_critical))
    return F.coalesce(cond, F.lit(False))


def action_required(cfg: RiskConfig = DEFAULT, score_h="velocity_score_h") -> Column:
    s, n1, n24 = _c(score_h), F.col("tx_count_1h"), F.col("tx_count_24h")
    cond = ((s >= cfg.velocity_score_high * 100) | (n1 >= cfg.velocity_tx_1h_medium)
            | (n24 >= cfg.velocity_action_24h))
    return F.coalesce(cond, F.lit(False))


BREACH_COMPOUND, BREACH_1H, BREACH_24H, BREACH_CATEGORY, BREACH_ELEVATED = BREACH_TYPES


def breach_type(cfg: RiskConfig = DEFAULT) -> Column:
    n1, n24, nc = F.col("tx_count_1h"), F.col("tx_count_24h"), F.col("tx_same_category_24h")
    return (F.when((n1 >= cfg.velocity_tx_1h_high) & (n24 >= cfg.velocity_tx_24h_high)
                   & (nc >= cfg.velocity_category_compound), BREACH_COMPOUND)
            .when(n1 >= cfg.velocity_tx_1h_high, BREACH_1H)
            .when(n24 >= cfg.velocity_tx_24h_high, BREACH_24H)
            .when(nc >= cfg.velocity_category_high, BREACH_CATEGORY)
            .otherwise(BREACH_ELEVATED))


def queue_entry(cfg: RiskConfig = DEFAULT) -> Column:
    return ((F.col("tx_count_1h") >= cfg.velocity_entry_min_1h)
            | (F.col("tx_count_24h") >= cfg.velocity_entry_min_24h)
            | (F.col("tx_same_category_24h") >= cfg.velocity_entry_min_category_24h))
