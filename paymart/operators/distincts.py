"""Several distinct counts in one aggregate without multiplying the rows.

``count(distinct a), count(distinct b)`` beside other aggregates makes Spark
expand every row into one copy per distinct column.  Here each id has a branch
of its own that is combined inside the map tasks:

* the first id's branch aggregates by (group, id) and then by group, and
  carries every other aggregate along;
* each further id's branch reads two columns: the distinct (group, id) pairs,
  then their number by group.

The branches have a row a group and are put together by an aggregate that
takes the one value there is of each column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_distinct_counts(df: DataFrame, by: list[str], ids: dict[str, str], partial: dict[str, Column],
                         final: dict[str, Column]) -> DataFrame:
    """``by`` columns, ``final`` aggregates (over ``partial`` ones by name) and, for each name in ``ids``, the number
    of distinct values of its column; NULL is no value."""
    (first_name, first_id), *others = ids.items()
    carried = (df.groupBy(*by, first_id).agg(*[c.alias(n) for n, c in partial.items()])
               .groupBy(*by).agg(*[c.alias(n) for n, c in final.items()], F.count(first_id).alias(first_name)))
    branches = [carried]
    for name, column in others:
        pairs = df.select(*by, column).distinct()
        branches.append(pairs.groupBy(*by).agg(F.count(column).alias(name)))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)
    return both.groupBy(*by).agg(*[F.max(c).alias(c) for c in both.columns if c not in by])
