"""Trailing velocity counts per user (1 h, 24 h) and per user x category (24 h).

Semantics: ``count(*) OVER (PARTITION BY key ORDER BY ts RANGE BETWEEN
<w> PRECEDING AND CURRENT ROW)`` - the frame includes the row itself, its
peers with the same timestamp and the row exactly ``w`` earlier.  Time is
ordered in microseconds (``unix_micros``), never seconds.

How ``velocity_counts`` spreads the work:

* A user's rows are dealt by (user, bucket), a bucket being seven of the
  longest window (a week).  Only a row within that window of its bucket's end
  is needed in the next bucket; it is generated a second time as a narrow
  *context* row (keys and time, other columns NULL), so about 1.14 rows are
  dealt a row.  All windows share that one exchange.
* A count is the difference of two running counts, ``N(<= t) - N(< t - w)``.
  Both frames start at the partition's first row and only grow, so a bucket of
  n rows costs n steps; a sliding frame is worked out anew for every row.
* Users with more than ``RiskConfig.window_bucket_row_limit`` rows in one
  bucket are counted by the *tiered* windows below, whose partitions are
  bounded by time units and not by rows.  There are at most rows / limit such
  users: a narrow aggregate lists them, and the list is broadcast.  Every row
  takes the way of its user; without such users all take the bucketed one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paymart.config import DEFAULT, RiskConfig
from paymart.functions.rounding import idiv
from paymart.session import scratch_path

_US = "_ts_us"
_BUCKET = "_bucket"
_CTX = "_is_context"
WINDOWS_A_BUCKET = 7


def _bucket_start(us: F.Column, width: int) -> F.Column:
    return us - F.pmod(us, F.lit(width))


def with_context(stg: DataFrame, reach: int, width: int, ts: str, keys: set[str]) -> DataFrame:
    """Every row in its bucket and, if later rows of the next bucket can look
    back at it, once more there as a context row without its other columns.

    One scan: ``explode`` makes the second row.  A row without a time has no
    next bucket; its peers are the rows of its user without one."""
    us = F.col(_US)
    late = F.pmod(us, F.lit(width)) >= width - reach          # NULL: not late
    rows = stg.withColumn(_US, F.unix_micros(F.col(ts))).withColumn(
        _CTX, F.explode(F.when(late, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    ctx = F.col(_CTX)
    return rows.select(
        *[F.col(c) if c in keys else F.when(~ctx, F.col(c)).alias(c) for c in stg.columns], _US, ctx,
        (_bucket_start(us, width) + F.when(ctx, width).otherwise(0)).alias(_BUCKET))


def _trailing(keys: list[str], w: int) -> F.Column:
    """Rows of the partition in [t - w, t], from two growing frames."""
    by = Window.partitionBy(*keys).orderBy(_US)
    one = F.lit(1)
    to_here = F.count(one).over(by.rangeBetween(Window.unboundedPreceding, 0))
    before = F.count(one).over(by.rangeBetween(Window.unboundedPreceding, -(w + 1)))
    return F.when(F.col(_US).isNull(), to_here).otherwise(to_here - before)


def add_velocity_counts(stg: DataFrame, cfg: RiskConfig = DEFAULT, ts: str = "transaction_ts",
                        user: str = "user_id", category: str = "merchant_category") -> DataFrame:
    """Counts from (user, bucket) windows; right for any data, with a task
    for each bucket."""
    reach = max(cfg.window_1h_us, cfg.window_24h_us)
    rows = with_context(stg, reach, reach * WINDOWS_A_BUCKET, ts, {user, category})
    counted = rows.select(
        "*",
        _trailing([user, _BUCKET], cfg.window_1h_us).alias("tx_count_1h"),
        _trailing([user, _BUCKET], cfg.window_24h_us).alias("tx_count_24h"),
        _trailing([user, _BUCKET, category], cfg.window_24h_us).alias("tx_same_category_24h"),
    )
    return counted.where(~F.col(_CTX)).drop(_US, _BUCKET, _CTX)


def add_velocity_counts_unsplit(stg: DataFrame, cfg: RiskConfig = DEFAULT, ts: str = "transaction_ts",
                                user: str = "user_id", category: str = "merchant_category") -> DataFrame:
    """Unsplit formulation (one window partition per user); used by tests."""
    us = F.unix_micros(F.col(ts))
    by_user = Window.partitionBy(user).orderBy(us)
    by_user_cat = Window.partitionBy(user, category).orderBy(us)
    return stg.select(
        "*",
        F.count(F.lit(1)).over(by_user.rangeBetween(-cfg.window_1h_us, 0)).alias("tx_count_1h"),
        F.count(F.lit(1)).over(by_user.rangeBetween(-cfg.window_24h_us, 0)).alias("tx_count_24h"),
        F.count(F.lit(1)).over(by_user_cat.rangeBetween(-cfg.window_24h_us, 0)).alias("tx_same_category_24h"),
    )


# --------------------------------------------------------------------------- tiered
_M = "_minute"
_KIND = "_kind"          # 0 = probe (sorts first at equal time), 1 = data
_N = "_n"


def _eq_keys(left: DataFrame, right: DataFrame, cols):
    return [left[c].eqNullSafe(right[c]) for c in cols]


def _tiered_counts(rows: DataFrame, keys: list[str], windows: dict[str, tuple[int, int | None]],
                   fine_us: int, set_col: str | None = None) -> DataFrame:
    """Exact trailing counts per distinct (keys, time) without a per-key sort.

    ``count(t, w) = N(<= t) - N(< t - w)`` where ``N`` is the key's cumulative
    count.  ``N`` is assembled from two levels, each a window over
    *aggregated* rows whose partition size is bounded by time units, not by
    row counts:

    * fine: per (key, minute), running sum over the distinct timestamps of
      that minute (ties are collapsed by the first aggregate) - at most the
      number of microseconds in a minute, plus probes;
    * coarse: per key, running sum over minute totals - at most the number of
      minutes the key spans, plus probe minutes.

    A probe row at ``t - w`` (weight 0, ordered before data at equal time)
    reads ``N(< t - w)`` out of the same running sums.

    Several key sets can share one pass: ``set_col`` (part of ``keys``)
    tells them apart, and a window ``(w, set_id)`` gets probes only for rows
    of that set.
    """
    us = F.col(_US)
    t = rows.groupBy(*keys, _US).agg(F.count(F.lit(1)).alias(_N))          # ties collapse map-side
    minute = idiv(us, F.lit(fine_us))
    data = t.select(*keys, _US, minute.alias(_M), _N, F.lit(1).alias(_KIND),
                    F.lit(None).cast("long").alias("_ref"), F.lit(None).cast("string").alias("_w"))
    probes = []
    for name, (w, set_id) in windows.items():
        src = t if set_id is None else t.where(F.col(set_col) == set_id)
        probes.append(src.select(*keys, (us - w).alias(_US), idiv(us - w, F.lit(fine_us)).alias(_M),
                                 F.lit(0).cast("long").alias(_N), F.lit(0).alias(_KIND), us.alias("_ref"),
                                 F.lit(name).alias("_w")))
    pts = data
    for p in probes:
        pts = pts.unionByName(p)
    fine = Window.partitionBy(*keys, _M).orderBy(_US, _KIND).rowsBetween(Window.unboundedPreceding, 0)
    pts = pts.withColumn("_cum", F.sum(_N).over(fine))

    minutes = t.groupBy(*keys, minute.alias(_M)).agg(F.sum(_N).alias("_tot"))
    probe_minutes = pts.where(F.col(_KIND) == 0).select(*keys, _M).distinct()
    coarse = (minutes.select(*keys, _M, "_tot", F.lit(1).alias(_KIND))
              .unionByName(probe_minutes.select(*keys, _M, F.lit(0).cast("long").alias("_tot"), F.lit(0).alias(_KIND))))
    by_key = Window.partitionBy(*keys).orderBy(_M, _KIND).rowsBetween(Window.unboundedPreceding, 0)
    coarse = coarse.withColumn("_pre", F.sum("_tot").over(by_key) - F.col("_tot"))   # strictly earlier minutes

    def attach(kind: int) -> DataFrame:
        left = pts.where(F.col(_KIND) == kind).alias("l")
        right = coarse.where(F.col(_KIND) == kind).select(*keys, _M, "_pre").alias("r")
        j = left.join(right, _eq_keys(left, right, keys + [_M]), "inner")
        return j.select(*[F.col(f"l.{c}").alias(c) for c in keys], F.col(f"l.{_US}").alias(_US),
                        F.col("l._ref").alias("_ref"), F.col("l._w").alias("_w"),
                        (F.col("r._pre") + F.col("l._cum")).alias("_N"))

    le = attach(1).select(*keys, _US, F.col("_N").alias("_le"))
    lt = (attach(0).groupBy(*keys, F.col("_ref").alias(_US)).pivot("_w", list(windows)).agg(F.first("_N")))
    l, r = le.alias("l"), lt.alias("r")
    j = l.join(r, _eq_keys(l, r, keys + [_US]), "inner")
    return j.select(*[F.col(f"l.{c}").alias(c) for c in keys], F.col(f"l.{_US}").alias(_US),
                    *[(F.col("l._le") - F.coalesce(F.col(f"r.{name}"), F.lit(0))).alias(name) for name in windows])


def add_velocity_counts_tiered(stg: DataFrame, cfg: RiskConfig = DEFAULT, ts: str = "transaction_ts",
                               user: str = "user_id", category: str = "merchant_category",
                               fine_us: int = 60_000_000) -> DataFrame:
    """Skew-proof formulation: exact counts for any concentration of rows on
    one user, one day or one timestamp.

    Counts are computed per distinct (user, time) and (user, category, time)
    in one ``_tiered_counts`` pass over both key sets, the two count tables
    are joined (aggregated data), and the result is joined back to the rows
    once on (user, category, time).  A tie group of many rows on one key is a many-to-one
    join that AQE's skew-join split handles."""
    rows = stg.withColumn(_US, F.unix_micros(F.col(ts)))
    # both key sets in one pass: set 0 = (user), set 1 = (user, category)
    keyed = (rows.select(F.lit(0).alias("_set"), user, F.lit(None).cast("string").alias("_cat"), _US)
             .unionByName(rows.select(F.lit(1).alias("_set"), user, F.col(category).cast("string").alias("_cat"),
                                      _US)))
    both = _tiered_counts(keyed, ["_set", user, "_cat"],
                          {"tx_count_1h": (cfg.window_1h_us, 0), "tx_count_24h": (cfg.window_24h_us, 0),
                           "tx_same_category_24h": (cfg.window_24h_us, 1)}, fine_us, set_col="_set")
    per_user = both.where(F.col("_set") == 0).select(user, _US, "tx_count_1h", "tx_count_24h")
    per_cat = both.where(F.col("_set") == 1).select(user, F.col("_cat").alias(category), _US,
                                                    "tx_same_category_24h")
    a, b = per_cat.alias("a"), per_user.alias("b")
    counts = a.join(b, _eq_keys(a, b, [user, _US]), "inner").select(
        F.col(f"a.{user}").alias(user), F.col(f"a.{category}").alias(category), F.col(f"a.{_US}").alias(_US),
        "b.tx_count_1h", "b.tx_count_24h", "a.tx_same_category_24h")
    x, c = rows.alias("x"), counts.alias("c")
    out = x.join(c, _eq_keys(x, c, [user, category, _US]), "inner")
    return out.select(*[F.col(f"x.{col}").alias(col) for col in stg.columns],
                      F.col("c.tx_count_1h").cast("long").alias("tx_count_1h"),
                      F.col("c.tx_count_24h").cast("long").alias("tx_count_24h"),
                      F.col("c.tx_same_category_24h").cast("long").alias("tx_same_category_24h"))


def hot_users(stg: DataFrame, cfg: RiskConfig = DEFAULT, ts: str = "transaction_ts",
              user: str = "user_id") -> DataFrame:
    """Users with more than the limit's rows in one bucket (with a bucket of
    rows without a time): at most rows / limit of them."""
    width = max(cfg.window_1h_us, cfg.window_24h_us) * WINDOWS_A_BUCKET
    bucket = _bucket_start(F.unix_micros(F.col(ts)), width)
    busy = stg.groupBy(F.col(user).alias("_hot"), bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    return busy.where(F.col("_n") > cfg.window_bucket_row_limit).select("_hot").distinct()


def velocity_counts(stg: DataFrame, cfg: RiskConfig = DEFAULT, ts: str = "transaction_ts",
                    user: str = "user_id", category: str = "merchant_category") -> DataFrame:
    """Bucketed windows, and tiered ones for the users whose buckets are
    too large for a task.  The list of those users is written first, as every
    branch reads it; if it is empty, there are no rows for the tiered windows
    and they are left out of the plan."""
    path = scratch_path(stg.sparkSession, "busy_users")
    hot_users(stg, cfg, ts, user).write.parquet(path)
    hot = stg.sparkSession.read.parquet(path)
    if hot.isEmpty():
        return add_velocity_counts(stg, cfg, ts, user, category)
    is_hot = F.col(user).eqNullSafe(F.col("_hot"))
    hot = F.broadcast(hot)                                    # at most rows / limit of them
    usual = add_velocity_counts(stg.join(hot, is_hot, "left_anti"), cfg, ts, user, category)
    busy = add_velocity_counts_tiered(stg.join(hot, is_hot, "left_semi"), cfg, ts, user, category)
    return usual.unionByName(busy)
