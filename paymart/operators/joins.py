"""Dimension joins: broadcast only behind a measured size.

Spark's own broadcast choice relies on size estimates, and estimates of a
joined or derived dimension are unreliable (an inner join's estimate is the
product of its inputs).  ``broadcast_if_small`` measures the narrow side
instead - one count over the projected columns - and hints a broadcast only
when it holds at most ``max_rows`` rows.  Above that bound the plain join
stays: a sort-merge join whose skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# at most this many (key, attributes) rows are shipped to every executor
DEFAULT_MAX_BROADCAST_ROWS = 500_000


def broadcast_if_small(side: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    n = side.count()   # combined in every task; a limit would bring its rows to one
    return F.broadcast(side) if n <= max_rows else side
