"""Thresholds, weights and labels of the risk model.

Every operator takes a ``RiskConfig`` so a caller can tune a rule without
touching plan code; the defaults are the published model parameters.
"""

from __future__ import annotations

from dataclasses import dataclass


# The model parameters whose defaults must equal the published
# warehouse configuration for results to match.
@dataclass(frozen=True)
class RiskConfig:
    # scoring (staging + enrichment)
    odd_hour_start: int = 1
    odd_hour_end: int = 5
    high_amount_threshold: int = 25000
    risky_merchant_categories: tuple[str, ...] = ("Travel", "Electronics")
    fraud_velocity_threshold_1h: int = 5
    fraud_velocity_threshold_24h: int = 15

    # score weights
    weight_odd_hour: int = 20
    weight_high_amount: int = 30
    weight_risky_category: int = 25
    weight_spike_1h: int = 15
    weight_spike_24h: int = 10

    # risk levels (score lower bounds)
    level_critical: int = 70
    level_high: int = 50
    level_medium: int = 30

    # velocity queue: entry filters
    velocity_entry_min_1h: int = 4
    velocity_entry_min_24h: int = 12
    velocity_entry_min_category_24h: int = 7

    # velocity queue: score bands
    velocity_score_critical: int = 72
    velocity_score_high: int = 48
    velocity_score_medium: int = 28

    # velocity queue: count thresholds
    velocity_tx_1h_critical: int = 12
    velocity_tx_1h_high: int = 8
    velocity_tx_1h_medium: int = 6
    velocity_tx_24h_high: int = 20
    velocity_tx_24h_critical_combo: int = 25
    velocity_tx_24h_medium: int = 18
    velocity_action_buffer_24h: int = 3
    velocity_category_high: int = 10
    velocity_category_compound: int = 8
    velocity_high_amount_threshold: int = 30000
    velocity_fraud_score_critical: int = 55

    # velocity queue: score weights (decimal literals, kept as strings so that
    # the arithmetic stays exact: 1.8 is not a binary fraction)
    velocity_score_base_1h: int = 4
    velocity_score_mult_1h: str = "6"
    velocity_score_cap_1h: int = 30
    velocity_score_base_24h: int = 12
    velocity_score_mult_24h: str = "1.8"
    velocity_score_cap_24h: int = 25
    velocity_score_base_category: int = 5
    velocity_score_mult_category: str = "2.5"
    velocity_score_cap_category: int = 15
    velocity_score_high_amount_pts: int = 12
    velocity_score_odd_hour_pts: int = 6
    velocity_score_fraud_mult: str = "0.12"
    velocity_score_fraud_cap: int = 12

    # merchant risk profile
    merchant_risk_min_transactions: int = 50
    merchant_risk_high_fraud_rate_pct: int = 5
    merchant_risk_medium_fraud_rate_pct: int = 2
    merchant_risk_high_avg_score: int = 60
    merchant_risk_medium_avg_score: int = 40

    # merchant dimension: high-risk categories are a literal list there,
    # independent of ``risky_merchant_categories``
    dim_high_risk_categories: tuple[str, ...] = ("Travel", "Electronics")

    # customer segments
    recency_active_days: int = 7
    recency_recent_days: int = 30
    recency_lapsed_days: int = 90
    frequency_high: int = 30
    frequency_medium: int = 8
    monetary_high: int = 200000
    monetary_medium: int = 25000
    fraud_repeat: int = 3
    fraud_single: int = 1

    # data-quality expectations
    target_fraud_rate_pct: float = 3.5
    target_fraud_tolerance_pct: float = 0.25

    # velocity windows (microseconds)
    window_1h_us: int = 3_600_000_000
    window_24h_us: int = 86_400_000_000
    # users with more rows than this in one bucket (a week) are counted by the
    # tiered windows, whose partitions are bounded by time
    window_bucket_row_limit: int = 2_000_000

    @property
    def velocity_action_24h(self) -> int:
        return self.fraud_velocity_threshold_24h + self.velocity_action_buffer_24h


DEFAULT = RiskConfig()


# Output labels and tokens, each list in the order its rule
# tests them (they must equal the published warehouse's strings).
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
REASON_LABELS = ("Odd Hour", "High Amount", "Risky Category", "Velocity Spike (1h)", "Velocity Spike (24h)")
REASON_SEPARATOR = " | "
ALERT_LEVELS = ("Critical", "High", "Medium", "Low")
BREACH_TYPES = ("Compound Velocity Breach", "High Velocity (1 Hour)", "High Velocity (24 Hours)",
                "Category Concentration", "Elevated Velocity")
RECENCY_SEGMENTS = ("Active", "Recent", "Lapsed", "Inactive")
FREQUENCY_SEGMENTS = ("High Frequency", "Medium Frequency", "Low Frequency")
MONETARY_SEGMENTS = ("High Value", "Medium Value", "Low Value")
FRAUD_SEGMENTS = ("Repeat Fraudster", "Single Fraud", "Clean")
MERCHANT_TIERS = ("No Activity", "Insufficient Volume", "High Risk", "Medium Risk", "Low Risk")
AMOUNT_BUCKETS = ((0, "<₹1K"), (1000, "₹1–5K"), (5000, "₹5–10K"), (10000, "₹10–25K"), (25000, "₹25–50K"),
                  (50000, "₹50K+"))
SCORE_BUCKETS = ((30, "Low"), (50, "Med"), (70, "High"), (100, "Critical"))
DAY_ORDER = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
TERTILES = ("Low repeat", "Medium repeat", "High repeat")
STEP_UP_CATEGORIES = ("Travel", "Electronics")
STEP_UP_MIN_AMOUNT = 10000

# Accepted domains of the raw columns.
MERCHANT_CATEGORIES = (
    "Electronics", "Entertainment", "Fashion", "Food & Beverage",
    "Groceries", "Healthcare", "Retail", "Travel",
)
PAYMENT_METHODS = ("UPI", "Credit Card", "Debit Card", "NetBanking", "Wallet")
CURRENCIES = ("INR",)
STATUSES = ("success", "failed", "declined", "disputed")
DEVICE_TYPES = ("mobile", "desktop", "POS")
RISK_LEVELS = ("low", "medium", "high", "critical")
USER_ID_PATTERN = r"^USR_\d{8}$"
MERCHANT_ID_PATTERN = r"^MER_\d{6}$"

# Name of the incremental table in the load-state (watermark) table.
TRANSACTIONS_TABLE = "raw.transactions"
