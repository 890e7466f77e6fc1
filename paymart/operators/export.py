"""Report export (IO15, X1-X8): eight named result sets written as CSV.

Each set is shaped before writing - the view timestamp is dropped,
``cohort_month`` is formatted yyyy-MM-dd and ``transaction_ts``
yyyy-MM-dd HH:mm:ss - and written by the executors (one folder of part
files per set; nothing is collected to the driver).  A set that fails is
logged and skipped; the others are still written.  ``max_rows`` caps a set
only when the caller asks for it.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.operators.marts import for_sink

log = logging.getLogger(__name__)


def shape_for_export(df: DataFrame) -> DataFrame:
    if "view_generated_at" in df.columns:
        df = df.drop("view_generated_at")
    repl = {}
    if "cohort_month" in df.columns:
        repl["cohort_month"] = F.date_format("cohort_month", "yyyy-MM-dd")
    if "transaction_ts" in df.columns:
        repl["transaction_ts"] = F.date_format("transaction_ts", "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(repl) if repl else df


def export_sets(marts: dict[str, DataFrame], reporting: dict[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """X1-X8 as lazily built DataFrames (name -> builder)."""
    return {
        "Cohort_Data": lambda: reporting["cohort_analysis"],
        "Segments_Data": lambda: reporting["fraud_customer_segments"],
        "Hourly_Data": lambda: reporting["hourly_fraud_trends"],
        "Merchant_Data": lambda: reporting["merchant_risk_profiling"],
        "Velocity_Data": lambda: for_sink("velocity_anomaly_detection", reporting["velocity_anomaly_detection"]),
        "Daily_KPIs": lambda: marts["daily_overview_kpis"].orderBy(F.col("day").desc()),
        "Dim_Users": lambda: marts["dim_users"],
        "Fraud_Mart": lambda: for_sink("fraud_analysis_mart", marts["fraud_analysis_mart"]),
    }


def export_reports(sets: dict[str, Callable[[], DataFrame]], out: str,
                   max_rows: dict[str, int] | None = None) -> dict[str, str]:
    written = {}
    for name, build in sets.items():
        try:
            df = shape_for_export(build())
            if max_rows and max_rows.get(name):
                df = df.limit(max_rows[name])
            path = f"{out.rstrip('/')}/{name}"
            df.write.mode("overwrite").option("header", True).csv(path)
            written[name] = path
            log.info("%-20s written to %s", name, path)
        except Exception:  # a failing set must not stop the others
            log.exception("%s failed, skipping", name)
    return written
