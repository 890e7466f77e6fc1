"""Registry of driver-checkable queries: name -> f(spark, sf_dir) -> DataFrame.

Every query reads the driver tables in ``sf_dir`` (through the raw adapter)
and runs over the whole derived data; the layers several queries share are
materialised once per session (``warehouse_for``).  Outputs are normalised for the
cross-engine check: decimals become doubles, wall-clock columns are left
out (the run date is pinned for tenure columns).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paymart.plans.warehouse import Warehouse
from paymart.session import prepare

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def normalise(df: DataFrame) -> DataFrame:
    """Decimal columns -> double (exact for cents below 2^53)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


_WAREHOUSES: dict[tuple, Warehouse] = {}


def warehouse_for(spark: SparkSession, sf_dir: str) -> Warehouse:
    """One materialised warehouse per (application, input folder): the
    enriched rows, dimensions and fact are written once as Parquet under the
    checkpoint folder - as the source warehouse materialises them as tables -
    and every query of the session reads them."""
    import os
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # Spark Connect
        app = id(spark)
    key = (app, os.path.abspath(sf_dir))
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = Warehouse.from_driver_tables(spark, sf_dir, materialize=True)
    return _WAREHOUSES[key]


def query(name: str):
    def deco(fn: Callable[[Warehouse], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return normalise(fn(warehouse_for(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        run.build = fn  # the Warehouse-level function, for reuse by bench.py
        QUERIES[name] = run
        return fn
    return deco


def load_all() -> dict[str, QueryFn]:
    # importing the modules registers their queries
    from paymart.plans import queries_core, queries_analytics  # noqa: F401
    return dict(QUERIES)
