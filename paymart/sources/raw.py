"""CSV source of the raw layer (users, merchants, transactions).

Files are read with an explicit schema and ``FAILFAST``; a malformed row
stops the job instead of turning into NULLs.  Empty fields are NULL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paymart.sources import schemas


class MissingColumnError(ValueError):
    pass


def read_raw(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read one CSV (or a folder of CSVs) with its header.

    The header decides which columns are present; each present column is
    parsed with its declared type.  Columns absent from the file get their
    defaults in ``conform``.
    """
    header = spark.read.option("header", True).csv(path).columns
    declared = {f.name: f for f in schemas.RAW[table]}
    fields = [declared.get(c, T.StructField(c, T.StringType(), True)) for c in header]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
            .option("enforceSchema", False).option("timestampFormat", "yyyy-MM-dd[ ]['T']HH:mm:ss[.SSSSSS]")
            .csv(path))


def require_columns(df: DataFrame, columns, table: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumnError(
            f"{', '.join(repr(c) for c in missing)} column is required for table {table}")
    return df


def conform(df: DataFrame, table: str, as_of: dt.datetime | None = None) -> DataFrame:
    """Project onto the declared schema.

    A column missing from the input takes its table default: ``currency``
    'INR' and ``created_at`` = load time (``as_of``); other missing columns
    are NULL.  An explicit NULL in a present column stays NULL.
    """
    defaults = {"currency": F.lit("INR")}
    if as_of is not None:
        defaults["created_at"] = F.lit(as_of).cast("timestamp")
    cols = []
    for f in schemas.RAW[table]:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in defaults and table == "transactions":
            cols.append(defaults[f.name].cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schemas.RAW[table])
