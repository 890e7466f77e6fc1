"""Warehouse tables as sources, and lazy views.

The sink - versioned folders, a log, months - is ``paymart.plans.published``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paymart.operators.table_log import TableLog


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def read_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """Read a published table; column pruning and filters reach the scan."""
    rows = TableLog(spark, table_path(root, layer, name)).read()
    if rows is None:
        raise LookupError(f"{layer}/{name} is not published under {root}")
    return rows


def publish_view(df: DataFrame, name: str) -> str:
    """Staging and reporting layers are lazy views, not tables."""
    df.createOrReplaceTempView(name)
    return name
