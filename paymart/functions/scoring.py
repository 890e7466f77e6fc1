"""Row-level risk features of a transaction as Column expressions.

All functions are pure: they take Columns (or column names) plus a
``RiskConfig`` and return a Column, so they fold into whole-stage codegen of
whatever projection uses them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paymart.config import DEFAULT, REASON_LABELS, REASON_SEPARATOR, RISK_LEVELS, SURROGATE_NULL_TOKEN, RiskConfig

(REASON_ODD_HOUR, REASON_HIGH_AMOUNT, REASON_RISKY_CATEGORY, REASON_SPIKE_1H, REASON_SPIKE_24H) = REASON_LABELS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def surrogate_key(*cols) -> Column:
    """md5 over the '-'-joined text of the columns, NULL replaced by a token."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL_TOKEN)) for c in cols]
    text = parts[0] if len(parts) == 1 else F.concat_ws("-", *parts)
    return F.md5(text)


def odd_hour(ts="transaction_ts", cfg: RiskConfig = DEFAULT) -> Column:
    """Hour within [start, end], both inclusive; NULL timestamp -> False."""
    return F.coalesce(F.hour(_c(ts)).between(cfg.odd_hour_start, cfg.odd_hour_end), F.lit(False))


def high_amount(amount="amount", cfg: RiskConfig = DEFAULT) -> Column:
    return F.coalesce(_c(amount) >= F.lit(cfg.high_amount_threshold), F.lit(False))


def risky_category(category="merchant_category", cfg: RiskConfig = DEFAULT) -> Column:
    return F.coalesce(_c(category).isin(*cfg.risky_merchant_categories), F.lit(False))


def day_of_week_sun0(ts="transaction_ts") -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(_c(ts)) - 1


def _pts(flag: Column, weight: int) -> Column:
    return F.when(flag, F.lit(weight)).otherwise(F.lit(0))


def fraud_risk_score(odd="is_odd_hour", high="is_high_amount", risky="is_risky_merchant_category",
                     spike_1h="is_velocity_spike_1h", spike_24h="is_velocity_spike_24h",
                     cfg: RiskConfig = DEFAULT) -> Column:
    """Additive 0-100 score of the five indicator flags."""
    return (_pts(_c(odd), cfg.weight_odd_hour) + _pts(_c(high), cfg.weight_high_amount)
            + _pts(_c(risky), cfg.weight_risky_category) + _pts(_c(spike_1h), cfg.weight_spike_1h)
            + _pts(_c(spike_24h), cfg.weight_spike_24h))


def fraud_score_from_counts(is_high, is_risky, is_odd, count_1h, count_24h, cfg: RiskConfig = DEFAULT) -> Column:
    """The same score as a reusable function of raw velocity counts."""
    return fraud_risk_score(
        odd=_c(is_odd), high=_c(is_high), risky=_c(is_risky),
        spike_1h=_c(count_1h) >= cfg.fraud_velocity_threshold_1h,
        spike_24h=_c(count_24h) >= cfg.fraud_velocity_threshold_24h, cfg=cfg)


def risk_level(score="fraud_risk_score", cfg: RiskConfig = DEFAULT) -> Column:
    s = _c(score)
    low, medium, high, critical = RISK_LEVELS
    return (F.when(s >= cfg.level_critical, critical)
            .when(s >= cfg.level_high, high)
            .when(s >= cfg.level_medium, medium)
            .otherwise(low))


def fraud_reason(odd="is_odd_hour", high="is_high_amount", risky="is_risky_merchant_category",
                 spike_1h="is_velocity_spike_1h", spike_24h="is_velocity_spike_24h") -> Column:
    """Triggered labels joined by ' | ' in fixed order; NULL when none fired
    (a bare ``concat_ws`` would return the empty string)."""
    flags = [(_c(odd), REASON_ODD_HOUR), (_c(high), REASON_HIGH_AMOUNT),
             (_c(risky), REASON_RISKY_CATEGORY), (_c(spike_1h), REASON_SPIKE_1H),
             (_c(spike_24h), REASON_SPIKE_24H)]
    any_flag = flags[0][0]
    for f, _ in flags[1:]:
        any_flag = any_flag | f
    return F.when(any_flag, F.concat_ws(REASON_SEPARATOR, *[F.when(f, F.lit(label)) for f, label in flags]))


def flag_true(x) -> Column:
    """``CASE WHEN x THEN ...`` semantics: NULL counts as false."""
    return F.coalesce(_c(x), F.lit(False))


def count_if(cond: Column) -> Column:
    """``sum(case when cond then 1 else 0 end)`` as a long (NULL cond -> 0)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")
