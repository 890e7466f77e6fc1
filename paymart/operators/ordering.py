"""Published row order of a mart as a column.

A stored table has no order, so the place of a row is stored with it.  A
window over the whole table would bring all rows to one task; instead

1. the rows are range-partitioned by the order's columns and sorted inside
   each partition (Spark's own global sort), and every row notes its partition
   and its place there;
2. the partitions' sizes - one row a partition - give each partition the
   number of rows before it;
3. the two are added.

The ordered rows are written to the session's scratch folder between 1 and 2,
so that both steps see one and the same partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paymart.session import scratch_path

_ID, _PART = "_place", "_part"
_PLACES = 33  # bits of monotonically_increasing_id that count the rows of a partition


def with_rank(df: DataFrame, order: list[tuple[str, bool]], rank: str = "rank") -> DataFrame:
    """``df`` with ``rank`` 1..n by ``order`` (column, ascending).  Rows equal in
    all of these columns are numbered in any order, so the last one should be a key."""
    spark = df.sparkSession
    keys = [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in order]
    path = scratch_path(spark, "ranked")
    (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
       .withColumn(_ID, F.monotonically_increasing_id()).write.parquet(path))
    rows = spark.read.parquet(path).withColumn(_PART, F.shiftright(F.col(_ID), _PLACES))
    sizes = rows.groupBy(_PART).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)   # one row a partition
    before = sizes.select(_PART, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.col(_ID) - F.shiftleft(F.col(_PART), _PLACES)
    # bounded: one row for each of the sort's partitions
    return (rows.join(F.broadcast(before), _PART)
            .select(*df.columns, (F.col("_before") + place + 1).alias(rank)))
