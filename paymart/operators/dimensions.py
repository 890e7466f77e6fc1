"""User and merchant dimensions with hashed surrogate keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.config import DEFAULT, RiskConfig
from paymart.functions import scoring


def _as_date(as_of) -> F.Column:
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    return F.lit(as_of).cast("date")


def dim_users(users: DataFrame, as_of: dt.date) -> DataFrame:
    """``days_since_registration`` = run date - registration date, in days."""
    return users.select(
        scoring.surrogate_key("user_id").alias("user_sk"), *users.columns,
        F.datediff(_as_date(as_of), F.col("registration_date")).alias("days_since_registration"))


def dim_merchants(merchants: DataFrame, as_of: dt.date, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """``is_high_risk_category`` uses the dimension's own literal list."""
    return merchants.select(
        scoring.surrogate_key("merchant_id").alias("merchant_sk"), *merchants.columns,
        F.coalesce(F.col("merchant_category").isin(*cfg.dim_high_risk_categories), F.lit(False))
        .alias("is_high_risk_category"),
        F.datediff(_as_date(as_of), F.col("onboarding_date")).alias("days_since_onboarding"))
