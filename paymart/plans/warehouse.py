"""The warehouse build: raw -> staging -> enriched -> dimensions -> fact -> marts.

``Warehouse`` wires the layer functions together and memoises each layer as
a DataFrame.  With ``materialize=True`` the layers that feed the marts (enriched rows,
both dimensions and the fact) are written once as Parquet under the shared
checkpoint folder and read back: later marts then scan columnar files with
pruning and pushdown instead of recomputing the velocity windows, and the
lineage is cut so a lost executor costs a re-read, not a rebuild.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from paymart.config import DEFAULT, RiskConfig
from paymart.operators import dimensions, enrich, facts, marts, staging
from paymart.session import prepare, scratch_path
from paymart.sources import driver_tables

# Fixed run date used for tenure columns when none is given (the load time of
# the derived raw data), so results are reproducible.
DEFAULT_AS_OF = dt.date(2025, 7, 1)


class Warehouse:
    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], cfg: RiskConfig = DEFAULT,
                 as_of: dt.date = DEFAULT_AS_OF, materialize: bool = False):
        self.spark = prepare(spark)
        self.raw = raw
        self.cfg = cfg
        self.as_of = as_of
        self.materialize = materialize

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str, **kw) -> "Warehouse":
        return cls(spark, driver_tables.load_raw(spark, sf_dir), **kw)

    @classmethod
    def from_raw_root(cls, spark: SparkSession, root: str, **kw) -> "Warehouse":
        """The published raw tables written by ``paymart.operators.ingest``."""
        from paymart.operators.ingest import read_current
        raw = {n: read_current(spark, root, n) for n in ("users", "merchants", "transactions")}
        return cls(spark, raw, **kw)

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        if not self.materialize:
            return df
        path = scratch_path(self.spark, name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    # layers ---------------------------------------------------------------
    @cached_property
    def stg(self) -> DataFrame:
        return staging.stage_transactions(self.raw["transactions"], self.cfg)

    @cached_property
    def enriched(self) -> DataFrame:
        return self._keep(enrich.enrich_transactions(self.stg, self.cfg), "int_transactions_enriched")

    @cached_property
    def dim_users(self) -> DataFrame:
        return self._keep(dimensions.dim_users(self.raw["users"], self.as_of), "dim_users")

    @cached_property
    def dim_merchants(self) -> DataFrame:
        return self._keep(dimensions.dim_merchants(self.raw["merchants"], self.as_of, self.cfg), "dim_merchants")

    @cached_property
    def fct(self) -> DataFrame:
        return self._keep(facts.fct_transactions(self.enriched, self.dim_users, self.dim_merchants,
                                                 keys_from_hash=True), "fct_transactions")

    # marts ----------------------------------------------------------------
    def user_metrics(self) -> DataFrame:
        return marts.user_metrics(self.enriched)

    def hourly_fraud_trends(self) -> DataFrame:
        return marts.hourly_fraud_trends(self.enriched)

    def daily_overview_kpis(self) -> DataFrame:
        return marts.daily_overview_kpis(self.fct)

    def daily_merchant_kpis(self) -> DataFrame:
        return marts.daily_merchant_kpis(self.fct, self.dim_merchants)

    def merchant_risk_profiling(self) -> DataFrame:
        return marts.merchant_risk_profiling(self.dim_merchants, self.fct, self.cfg)

    def fraud_customer_segments(self) -> DataFrame:
        return marts.fraud_customer_segments(self.fct, self.dim_users, self.cfg)

    def cohort_analysis(self) -> DataFrame:
        return marts.cohort_analysis(self.fct, self.dim_users)

    def user_monthly_activity(self) -> DataFrame:
        return marts.user_monthly_activity(self.fct, self.dim_users)

    def fraud_analysis_mart(self) -> DataFrame:
        return marts.fraud_analysis_mart(self.fct, self.dim_merchants)

    def velocity_anomaly_detection(self) -> DataFrame:
        return marts.velocity_anomaly_detection(self.enriched, self.cfg)

    def eda_frame(self, business_keys: bool = False) -> DataFrame:
        """The notebooks' prepared frame.  With ``business_keys`` the user and
        merchant ids are looked up in the dimensions (two joins); without,
        the fact's surrogate keys stand in for them (one-to-one), which is
        all the per-user analyses need."""
        from paymart.operators import eda
        base = (eda.merged_fact(self.fct, self.dim_users, self.dim_merchants) if business_keys
                else self.fct)
        return eda.prepare_transactions(base)

    # whole build ------------------------------------------------------------
    def build(self, root: str, run_at: dt.datetime | None = None) -> dict[str, list[str]]:
        """Publish every layer and mart under ``root`` from this warehouse's raw tables (see ``plans.published``)."""
        from paymart.plans.published import Published
        return Published(self.spark, root, self.cfg).update_from(self.raw, run_at)
