"""Text source of the analyses (P30, IO1): every column arrives as text, and what doesn't parse is kept beside its row.

The warehouse's own CSV source stops at a malformed row.  The analyses read
files that people have edited: an amount such as ``n/a`` becomes NULL, is
counted, and ``rejected_values`` of its row names the column and the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paymart.sources import schemas

REJECTED = "rejected_values"


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV files with a header, every column as text; an empty field is NULL."""
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)


def typed(rows: DataFrame, table: str) -> DataFrame:
    """Text columns cast to the table's types, and ``rejected_values``: (column, text) of those that don't parse.

    Blanks around a value don't count; a column that the rows lack is NULL."""
    columns, rejected = [], []
    for field in schemas.RAW[table]:
        if field.name not in rows.columns:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        text = F.col(field.name)
        value = text if isinstance(field.dataType, T.StringType) else F.trim(text).try_cast(field.dataType)
        columns.append(value.alias(field.name))
        if not isinstance(field.dataType, T.StringType):
            bad = (F.trim(text) != "") & value.isNull()
            rejected.append(F.when(bad, F.struct(F.lit(field.name).alias("column"), text.alias("text"))))
    return rows.select(*columns, F.array_compact(F.array(*rejected)).alias(REJECTED))


def rejected_counts(rows: DataFrame) -> DataFrame:
    """Rejected values by column, with one of them (the smallest) as an example."""
    values = rows.select(F.inline(REJECTED))
    return values.groupBy("column").agg(F.count(F.lit(1)).alias("rejected"), F.min("text").alias("example"))
