"""Transaction fact: enriched rows with the dimension surrogate keys.

The fact left-joins both dimensions on the business keys; a transaction
whose user or merchant is missing keeps NULL keys.  Inside the warehouse the
keys come from the fact's own ids and the (small) set of orphan ids, so the
fact is not shuffled against a large dimension; the general path joins the
(business key, surrogate key) sides, broadcast only when a count shows they
are under a row bound, sort-merge (with AQE skew splitting) beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.functions.scoring import surrogate_key
from paymart.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_small
from paymart.session import scratch_path

FACT_COLUMNS = ("transaction_sk", "transaction_id", "user_sk", "merchant_sk", "merchant_category",
                "payment_method", "amount", "currency", "status", "is_fraud", "fraud_risk_score",
                "fraud_risk_level", "fraud_reason", "device_type", "city", "state", "transaction_ts",
                "raw_loaded_at")


def orphan_ids(enriched: DataFrame, du: DataFrame, dm: DataFrame) -> DataFrame:
    """(kind, id): user and merchant ids of the fact that their dimension lacks.

    One narrow pass reads both id columns; their distinct values, combined in
    every map task, meet the dimensions' keys.  The result - normally a handful
    of rows - is kept in the scratch folder, as it is counted and joined."""
    def named(kind: str, column: str) -> F.Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(column).alias("id"))

    ids = enriched.select(F.inline(F.array(named("user", "user_id"), named("merchant", "merchant_id"))))
    known = du.select(named("user", "user_id").alias("k")).unionByName(dm.select(named("merchant", "merchant_id").alias("k")))
    orphans = ids.where(F.col("id").isNotNull()).distinct().join(known.select("k.*"), ["kind", "id"], "left_anti")
    path = scratch_path(enriched.sparkSession, "orphan_ids")
    orphans.write.parquet(path)
    return enriched.sparkSession.read.schema(orphans.schema).parquet(path)


def _key_via_orphans(fact: DataFrame, orphans: DataFrame, kind: str, id_col: str, sk_col: str,
                     max_rows: int) -> DataFrame:
    """``sk_col`` for every fact row without joining the fact to the whole
    dimension.  The dimension's key is ``surrogate_key(id)``, so only the ids
    that are *missing* from the dimension matter; they are broadcast (behind a
    measured bound) and turn the key into NULL.  No wide shuffle of the fact."""
    missing = orphans.where(F.col("kind") == kind).select(F.col("id").alias(id_col), F.lit(True).alias("_orphan"))
    j = fact.join(broadcast_if_small(missing, max_rows), id_col, "left")
    sk = F.when(F.col(id_col).isNull() | F.col("_orphan").isNotNull(), F.lit(None).cast("string")) \
        .otherwise(surrogate_key(id_col))
    return j.withColumn(sk_col, sk).drop("_orphan")


def fct_transactions(enriched: DataFrame, du: DataFrame, dm: DataFrame,
                     max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                     keys_from_hash: bool = False) -> DataFrame:
    """``keys_from_hash=True`` is for dimensions built by
    ``paymart.operators.dimensions`` (surrogate key = hash of the business
    key, business key unique): the keys are then derived from the fact's
    own ids plus the small set of orphan ids, with the same result as the
    joins.  Otherwise both dimensions are joined (broadcast behind a measured
    bound, sort-merge beyond it)."""
    if keys_from_hash:
        orphans = orphan_ids(enriched, du, dm)
        joined = _key_via_orphans(enriched, orphans, "user", "user_id", "user_sk", max_broadcast_rows)
        joined = _key_via_orphans(joined, orphans, "merchant", "merchant_id", "merchant_sk", max_broadcast_rows)
    else:
        users = broadcast_if_small(du.select("user_id", "user_sk"), max_broadcast_rows)
        merchants = broadcast_if_small(dm.select("merchant_id", "merchant_sk"), max_broadcast_rows)
        joined = (enriched.join(users, "user_id", "left")
                  .join(merchants, "merchant_id", "left"))
    cols = list(FACT_COLUMNS)
    if "dbt_updated_at" in enriched.columns:
        cols.append("dbt_updated_at")
    return joined.select(*cols)
