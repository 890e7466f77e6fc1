"""Typed schemas of the raw layer (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

USERS = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("age_group", T.StringType(), False),
    T.StructField("account_type", T.StringType(), False),
    T.StructField("registration_date", T.DateType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("state", T.StringType(), True),
])

MERCHANTS = T.StructType([
    T.StructField("merchant_id", T.StringType(), False),
    T.StructField("merchant_name", T.StringType(), False),
    T.StructField("merchant_category", T.StringType(), False),
    T.StructField("city", T.StringType(), True),
    T.StructField("state", T.StringType(), True),
    T.StructField("onboarding_date", T.DateType(), True),
])

TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("merchant_id", T.StringType(), False),
    T.StructField("merchant_category", T.StringType(), True),
    T.StructField("payment_method", T.StringType(), True),
    T.StructField("amount", T.DecimalType(12, 2), True),
    T.StructField("currency", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("is_fraud", T.BooleanType(), True),
    T.StructField("device_type", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("state", T.StringType(), True),
    T.StructField("transaction_ts", T.TimestampType(), False),
    T.StructField("created_at", T.TimestampType(), True),
])

WATERMARK = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("last_loaded_ts", T.TimestampType(), True),
    T.StructField("rows_loaded", T.LongType(), True),
    T.StructField("updated_at", T.TimestampType(), True),
])

RAW = {"users": USERS, "merchants": MERCHANTS, "transactions": TRANSACTIONS, "watermark": WATERMARK}
KEYS = {"users": "user_id", "merchants": "merchant_id", "transactions": "transaction_id",
        "watermark": "table_name"}
