"""Raw payment tables derived from the driver's generic test tables.

The test harness ships TPC-H-like tables plus an ``events`` stream, not
payment CSVs.  This adapter derives ``users`` (from customer), ``merchants``
(from supplier) and ``transactions`` (from events) with integer / decimal
arithmetic only, so any SQL engine reproduces them bit for bit.  The rules
thin some users and pack others into short bursts so that every score band,
alert level, breach type and customer segment occurs.

Everything is a narrow projection over a scan plus joins with the tiny
``nation`` / ``region`` tables; the events scan is the only input that grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paymart.functions.rounding import idiv
from paymart.session import prepare
from paymart.sources import schemas

# Fixed values of the derivation (epoch of 2024-01-01 in microseconds, the
# category cycle and the event-type -> payment-method map).
EPOCH_2024_US = 1704067200000000
DAY_US = 86400000000
CATEGORY_CYCLE = ("Retail", "Food & Beverage", "Travel", "Electronics",
                  "Healthcare", "Entertainment", "Groceries", "Fashion")
METHOD_BY_EVENT = {"view": "UPI", "click": "Credit Card", "purchase": "Debit Card", "signup": "NetBanking"}
METHOD_OTHER = "Wallet"
LOAD_TS = "2025-07-01 00:00:00"


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cycle(key):
    expr = None
    for i, cat in enumerate(CATEGORY_CYCLE):
        cond = (key % len(CATEGORY_CYCLE)) == i
        expr = F.when(cond, cat) if expr is None else expr.when(cond, cat)
    return expr


def _geo(nation: DataFrame, region: DataFrame) -> DataFrame:
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select("n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("state")))


def users_from(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    out = (customer.join(_geo(nation, region), customer.c_nationkey == F.col("n_nationkey"))
           .select(
               F.concat(F.lit("USR_"), F.lpad(k.cast("string"), 8, "0")).alias("user_id"),
               F.when(k % 4 == 0, "18-25").when(k % 4 == 1, "26-35").when(k % 4 == 2, "36-50")
                .otherwise("50+").alias("age_group"),
               F.when(k % 3 == 0, "savings").when(k % 3 == 1, "current").otherwise("premium").alias("account_type"),
               F.date_add(F.lit("2024-01-01").cast("date"), (k % 455).cast("int")).alias("registration_date"),
               "city", "state"))
    return out


def merchants_from(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    return (supplier.join(_geo(nation, region), supplier.s_nationkey == F.col("n_nationkey"))
            .select(
                F.concat(F.lit("MER_"), F.lpad(k.cast("string"), 6, "0")).alias("merchant_id"),
                F.col("s_name").alias("merchant_name"),
                _cycle(k).alias("merchant_category"),
                "city", "state",
                F.date_add(F.lit("2023-01-01").cast("date"), ((k * 37) % 640).cast("int")).alias("onboarding_date")))


def transactions_from(events: DataFrame, customer: DataFrame, supplier: DataFrame, nation: DataFrame,
                      region: DataFrame) -> DataFrame:
    # number of merchants and of customers, as scalar subqueries (evaluated once, no join)
    ns = supplier.agg(F.count(F.lit(1))).scalar()
    nc = customer.agg(F.count(F.lit(1))).scalar()
    uid, eid = F.col("user_id"), F.col("event_id")
    e = (events
         .select("event_id", "user_id", "event_type", "value",
                 # every event is a transaction; some users give most of theirs to customers that have no events
                 F.when((uid % 5 == 1) & (eid % 3 != 0) | (uid % 5 == 2) & (eid % 12 != 0),
                        nc - 1 - (eid * 7919) % idiv(nc, F.lit(2))).otherwise(uid).alias("owner"),
                 (F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(EPOCH_2024_US)).alias("off"),
                 F.get_json_object("props", "$.k").cast("bigint").alias("k"),
                 ns.alias("ns")))
    k, ns = F.col("k"), F.col("ns")
    e = e.withColumn(
        "suppkey",
        F.when(uid % 25 == 1, F.lit(3) % ns)
         .when(eid % 97 == 0, ns - 1 - (eid % idiv(ns, F.lit(4))))
         .otherwise(idiv(k * (k + 1), F.lit(2)) % ns))
    s = F.col("suppkey")
    e = e.withColumn("is_fraud", (eid * 7919) % 1000 < F.when(s % 11 == 4, 110).when(s % 11 == 5, 12).otherwise(35))
    method = None
    for ev, m in METHOD_BY_EVENT.items():
        method = F.when(F.col("event_type") == ev, m) if method is None else method.when(F.col("event_type") == ev, m)
    method = method.otherwise(METHOD_OTHER)
    r13 = (eid * 13) % 100
    status = (F.when(F.col("is_fraud"),
                     F.when(eid % 20 < 11, "failed").when(eid % 20 < 17, "declined").otherwise("disputed"))
              .when(r13 < 92, "success").when(r13 < 96, "failed").when(r13 < 99, "declined").otherwise("disputed"))
    off = F.col("off")
    ts_us = (F.lit(EPOCH_2024_US) + (uid % 12) * 30 * DAY_US
             + F.when(uid % 25 == 0, idiv(off, F.lit(72))).when(uid % 25 == 1, idiv(off, F.lit(36))).otherwise(off * 6))
    out = (e.join(_geo(nation, region), (eid % 25) == F.col("n_nationkey"))
           .select(
               F.concat(F.lit("TXN_"), F.lpad(eid.cast("string"), 10, "0")).alias("transaction_id"),
               F.concat(F.lit("USR_"), F.lpad(F.col("owner").cast("string"), 8, "0")).alias("user_id"),
               F.concat(F.lit("MER_"), F.lpad(s.cast("string"), 6, "0")).alias("merchant_id"),
               _cycle(s).alias("merchant_category"),
               method.alias("payment_method"),
               (F.col("value").cast("decimal(12,2)") * F.when(uid % 10 == 2, 25).otherwise(250))
               .cast("decimal(12,2)").alias("amount"),
               F.lit("INR").alias("currency"),
               status.alias("status"),
               F.col("is_fraud"),
               F.when(eid % 4 == 2, "desktop").when(eid % 4 == 3, "POS").otherwise("mobile").alias("device_type"),
               "city", "state",
               F.timestamp_micros(ts_us).alias("transaction_ts"),
               F.lit(LOAD_TS).cast("timestamp").alias("created_at")))
    return out


def load_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """users, merchants, transactions as typed raw DataFrames."""
    prepare(spark)
    t = {n: read_driver_table(spark, sf_dir, n) for n in ("customer", "supplier", "events", "nation", "region")}
    raw = {
        "users": users_from(t["customer"], t["nation"], t["region"]),
        "merchants": merchants_from(t["supplier"], t["nation"], t["region"]),
        "transactions": transactions_from(t["events"], t["customer"], t["supplier"], t["nation"], t["region"]),
    }
    return {name: df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.RAW[name]])
            for name, df in raw.items()}
