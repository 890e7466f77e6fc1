"""Incremental ingestion into the raw layer (IO3-IO12).

Load order: users upsert, merchants upsert, transactions incremental
insert-if-absent guarded by a high-water mark on ``transaction_ts``.

* Mark filter: keep rows strictly newer than the mark; a row at or before
  the mark is skipped silently - the number skipped is reported.
* Insert-if-absent: stored rows win; within a batch one row per key is kept
  (lowest ``transaction_ts``, then ``created_at``, then a row hash - Spark
  keeps no input order).  The per-key pick is an aggregate (``min_by``), so
  a key repeated many times is combined map-side, not gathered in one task.
* Upsert: incoming rows replace stored rows; columns missing from the batch
  keep their stored values.  A key twice in one batch is rejected.
* The mark advances only after a non-empty load: max timestamp of the
  filtered batch and its row count.

Storage (``table_log``): the transactions table is append-only - each load
writes only the rows it adds into a new folder, sorted by key and with the key
range of every file, so that the next load opens only files that can hold one
of its keys; dimensions and the state table are small and written as whole new
versions.  A folder counts once the table's log names it.  Data is written
first and the mark last, so a job that stops anywhere leaves the previous
tables and mark in place, and the next load repeats its rows.
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paymart.config import TRANSACTIONS_TABLE
from paymart.operators.joins import broadcast_if_small
from paymart.operators.table_log import EMPTY, TableLog, UnpublishedDataError, key_ranges, new_version  # noqa: F401
from paymart.session import scratch_path
from paymart.sources import raw as rawsrc
from paymart.sources import schemas


class DuplicateKeyError(ValueError):
    pass


# A load compares keys in a dozen joins.  What is broadcast passes through the driver, so only short key lists are; left to
# itself, Spark judges by compressed shuffle files and broadcasts lists of a million keys.
MAX_BROADCAST_KEYS = 50_000


def _short(keys: DataFrame) -> DataFrame:
    found = broadcast_if_small(keys, MAX_BROADCAST_KEYS)
    return keys.hint("merge") if found is keys else found


# ------------------------------------------------------------------ pieces
def filter_new(batch: DataFrame, mark: dt.datetime | None, ts: str = "transaction_ts") -> DataFrame:
    """IO4: rows strictly after the mark (all rows when there is no mark)."""
    return batch if mark is None else batch.where(F.col(ts) > F.lit(mark).cast("timestamp"))


def filter_new_by_state(batch: DataFrame, state: DataFrame, table: str = TRANSACTIONS_TABLE,
                        ts: str = "transaction_ts") -> DataFrame:
    """IO4 with the mark read inside the plan (scalar subquery on the state
    table), so nothing passes through the driver."""
    mark = state.where(F.col("table_name") == table).agg(F.max("last_loaded_ts")).scalar()
    return batch.where(mark.isNull() | (F.col(ts) > mark))


def first_per_key(batch: DataFrame, key: str, order: tuple[str, ...] = ("transaction_ts", "created_at")) -> DataFrame:
    """One row per key: the smallest (order..., row hash)."""
    cols = batch.columns
    rank = F.struct(*[F.col(c) for c in order if c in cols], F.xxhash64(*[F.col(c) for c in cols]).alias("_h"))
    picked = batch.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), rank).alias("_r"))
    return picked.select("_r.*")


def one_per_key(batch: DataFrame, key: str) -> DataFrame:
    """``first_per_key``, in which only rows of repeated keys are compared: a narrow count finds those keys, normally
    few, and all other rows stay where they are.  Reads the batch three times."""
    often = _keep(batch.groupBy(F.col(key).alias("_often")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_often"),
                  "repeated_keys")
    again, same = _short(often), F.col(key).eqNullSafe(F.col("_often"))
    once = batch.join(again, same, "left_anti")
    return once.unionByName(first_per_key(batch.join(again, same, "left_semi"), key).select(*batch.columns))


def new_rows(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The rows an insert-if-absent adds: one per key, keys not stored yet.

    The stored table is only scanned, not shuffled: the batch keys (bounded
    by the batch, broadcast behind a measured bound) pick out the stored keys
    that clash - normally few - and the batch is anti-joined with those."""
    picked = first_per_key(batch, key)
    clashes = target.select(key).join(_short(picked.select(key)), key, "left_semi")
    return picked.join(clashes, key, "left_anti").select(*target.columns)


def insert_new(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """IO5 (``ON CONFLICT DO NOTHING``): existing rows win."""
    return target.unionByName(new_rows(target, batch, key))


def assert_unique_keys(batch: DataFrame, key: str) -> None:
    dup = batch.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"key {key}={dup[0][key]!r} appears {dup[0]['n']} times in one batch")


def filled(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The batch with all columns of the target: columns absent from it hold the stored value of its key."""
    missing = [c for c in target.columns if c not in batch.columns]
    if not missing:
        return batch.select(*target.columns)
    # the batch keys (bounded by the batch) are broadcast behind a measured
    # bound, so the stored table is filtered in place instead of shuffled
    stored = target.join(_short(batch.select(key)), key, "left_semi").select(
        key, *[F.col(c).alias(f"_old_{c}") for c in missing])
    return batch.join(stored, key, "left").select(
        *[F.col(f"_old_{c}").alias(c) if c in missing else F.col(c) for c in target.columns])


def upsert(target: DataFrame, batch: DataFrame, key: str, check_duplicates: bool = True) -> DataFrame:
    """IO6 (``ON CONFLICT DO UPDATE``): incoming rows replace stored rows;
    columns absent from the batch keep the stored value."""
    if check_duplicates:
        assert_unique_keys(batch, key)
    kept = target.join(_short(batch.select(key)), key, "left_anti")
    return kept.unionByName(filled(target, batch, key))


def append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """IO7: plain append without a conflict clause."""
    return target.unionByName(batch.select(*target.columns))


def get_watermark(state: DataFrame, table: str = TRANSACTIONS_TABLE) -> dt.datetime | None:
    """IO8: the last loaded timestamp for a table, or None (one tiny row)."""
    row = state.where(F.col("table_name") == table).select("last_loaded_ts").head(1)
    return row[0][0] if row else None


def watermark_row(batch: DataFrame, table: str = TRANSACTIONS_TABLE, as_of=None,
                  ts: str = "transaction_ts") -> DataFrame:
    """IO9: the state row a non-empty load writes (max timestamp and size of
    the *filtered* batch, not the rows actually inserted)."""
    a = batch.agg(F.max(ts).alias("last_loaded_ts"), F.count(F.lit(1)).alias("rows_loaded"))
    cols = [F.lit(table).alias("table_name"), "last_loaded_ts", "rows_loaded"]
    cols.append((F.lit(as_of) if as_of is not None else F.current_timestamp()).cast("timestamp").alias("updated_at"))
    return a.select(*cols)


def advance_watermark(state: DataFrame, batch: DataFrame, table: str = TRANSACTIONS_TABLE, as_of=None) -> DataFrame:
    return upsert(state, watermark_row(batch, table, as_of), "table_name", check_duplicates=False)


# ------------------------------------------------------------------ jobs
@dataclass
class LoadReport:
    table: str
    rows_in_file: int
    rows_after_mark: int
    rows_skipped_late: int
    path: str
    rows_rejected: int = 0


MERGE_FANOUT = 32      # so many folders of about one size become one


def raw_table(spark: SparkSession, root: str, name: str) -> TableLog:
    return TableLog(spark, f"{root.rstrip('/')}/raw/{name}")


def _write_version(df: DataFrame, root: str, name: str, version: str) -> str:
    path = f"{root.rstrip('/')}/raw/{name}/v={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def _current(table: TableLog, name: str) -> DataFrame:
    rows = table.read(schemas.RAW[name])
    return rawsrc.empty(table.spark, name) if rows is None else rows


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """IO13 for the raw layer: the published rows of a table."""
    return _current(raw_table(spark, root, name), name)


def _keep(df: DataFrame, name: str) -> DataFrame:
    """Compute once: written to the session's scratch folder and read from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def compact_transactions(spark: SparkSession, root: str) -> str:
    """Write all committed loads as one new folder."""
    table, version = raw_table(spark, root, "transactions"), new_version()
    rows = table.write_sorted(_current(table, "transactions"), version, schemas.KEYS["transactions"])
    if table.live():
        table.merge(table.live(), version, rows)
    return f"{table.path}/v={version}"


def merge_small_folders(table: TableLog, name: str, fanout: int = MERGE_FANOUT) -> int:
    """Merge ``fanout`` or more folders of about one size (one power of ``fanout`` in rows) into one, smallest first.

    Every row is written anew about log(rows) times in its life, and a table has some ``fanout`` folders for each
    size, so that neither readers' listings nor the log grow with the number of loads.  Returns the merges made."""
    merges = 0
    while True:
        sizes: dict[int, list] = {}
        for e in table.live():
            sizes.setdefault(math.floor(math.log(max(e.rows, 1), fanout)), []).append(e)
        due = min((k for k, v in sizes.items() if len(v) >= fanout), default=None)
        if due is None:
            return merges
        version = new_version()
        rows = table.spark.read.schema(schemas.RAW[name]).parquet(*[table.folder(e) for e in sizes[due]])
        table.merge(sizes[due], version, table.write_sorted(rows, version, schemas.KEYS[name]))
        merges += 1


def reset_raw(spark: SparkSession, root: str) -> None:
    """IO11: empty all raw tables and the load state."""
    for name in ("transactions", "watermark", "users", "merchants"):
        raw_table(spark, root, name).commit(EMPTY)


def _required(name: str, present) -> list[F.Column]:
    """Reasons for the required columns of a table that hold no value."""
    return [F.when(F.col(f.name).isNull(), F.lit(f"{f.name} is null"))
            for f in schemas.RAW[name] if not f.nullable and f.name in present]


def _reason(checks: list[F.Column]) -> F.Column:
    reason = F.concat_ws(", ", *checks)
    return F.when(reason != "", reason).alias("reject_reason")


def load_dimension(spark: SparkSession, batch: DataFrame, root: str, name: str, as_of=None) -> str:
    """Upsert users or merchants.  A row that, with its stored values filled in, has no value in a required column
    goes to ``raw/rejected_<name>`` with the reason, and the stored row stays."""
    key, table, version = schemas.KEYS[name], raw_table(spark, root, name), new_version(as_of)
    table.begin()
    assert_unique_keys(batch.where(F.col(key).isNotNull()), key)
    stored = _current(table, name)
    checked = _keep(filled(stored, batch, key).withColumn("reject_reason", _reason(_required(name, stored.columns))),
                    f"checked_{name}")
    bad = checked.where(F.col("reject_reason").isNotNull())
    if not bad.isEmpty():
        _write_version(bad, root, f"rejected_{name}", version)
    good = checked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    path = _write_version(upsert(stored, good, key, check_duplicates=False), root, name, version)
    table.commit(version)
    return path


def with_reject_reason(batch: DataFrame, users: DataFrame | None = None,
                       merchants: DataFrame | None = None) -> DataFrame:
    """``reject_reason``: which load rules a transaction breaks (NULL if none): required columns hold a value,
    and user and merchant are stored, where those tables are given."""
    checks = _required("transactions", batch.columns)
    out = batch
    for key, table in (("user_id", users), ("merchant_id", merchants)):
        if table is not None:
            known = _short(table.select(key, F.lit(True).alias(f"_known_{key}")))
            out = out.join(known, key, "left")
            checks.append(F.when(F.col(key).isNotNull() & F.col(f"_known_{key}").isNull(), F.lit(f"unknown {key}")))
    return out.select(*batch.columns, _reason(checks))


STORED_MARK = object()


def _insert(table: TableLog, fresh: DataFrame, version: str, key: str) -> tuple[str, int]:
    """Write the rows of a batch that the table doesn't have, opening only files whose key range meets the batch's."""
    picked = _keep(one_per_key(fresh, key), "picked")
    files = table.files_with(key_ranges(picked, key))
    if files:
        held = table.spark.read.schema(fresh.schema).parquet(*files)
        clashes = held.select(key).join(_short(picked.select(key)), key, "left_semi")
        picked = picked.join(clashes, key, "left_anti").select(*fresh.columns)
    return f"{table.path}/v={version}", table.write_sorted(picked, version, key)


def load_transactions(spark: SparkSession, batch: DataFrame, root: str, as_of: dt.datetime | None = None,
                      references: bool = False, mark=STORED_MARK) -> LoadReport:
    """Incremental insert-if-absent guarded by the high-water mark.

    Rows that break a load rule (``with_reject_reason``; ``references`` adds the stored users and merchants)
    go to ``raw/rejected_transactions`` with the reason and are counted in the report.  ``mark`` replaces the
    stored mark as the limit below which rows are late (None: no row is late); the stored mark never moves
    back.  The batch is computed once, into the session's scratch folder; each log is read once."""
    rawsrc.require_columns(batch, ["transaction_ts"], TRANSACTIONS_TABLE)
    table, marks = (raw_table(spark, root, n) for n in ("transactions", "watermark"))
    for log in (marks, table):
        log.begin()
    state = _current(marks, "watermark")
    stored = get_watermark(state)
    mark = stored if mark is STORED_MARK else mark
    checked = _keep(with_reject_reason(batch, *([read_current(spark, root, n) for n in ("users", "merchants")]
                                                if references else [])), "checked_transactions")
    good = F.col("reject_reason").isNull()
    fresh = filter_new(checked.where(good), mark).drop("reject_reason")
    late = good & (F.col("transaction_ts") <= F.lit(mark).cast("timestamp"))
    n_in, n_bad, n_late = checked.agg(F.count(F.lit(1)), F.count_if(~good), F.count_if(late)).first()
    version = new_version(as_of)
    if n_bad:
        _write_version(checked.where(~good), root, "rejected_transactions", version)
    n_new = n_in - n_bad - n_late
    if n_new == 0:
        return LoadReport(TRANSACTIONS_TABLE, n_in, 0, n_late, "", n_bad)
    # append-only: write just the rows this load adds, then commit the folder
    path, n_added = _insert(table, fresh, version, schemas.KEYS["transactions"])
    row = watermark_row(fresh, TRANSACTIONS_TABLE, as_of)
    if stored is not None:
        row = row.withColumn("last_loaded_ts", F.greatest("last_loaded_ts", F.lit(stored).cast("timestamp")))
    _write_version(upsert(state, row, "table_name", check_duplicates=False), root, "watermark", version)
    table.commit(version, "add", rows=n_added)
    marks.commit(version)   # the mark moves last
    merge_small_folders(table, "transactions")
    return LoadReport(TRANSACTIONS_TABLE, n_in, n_new, n_late, path, n_bad)


def ingest(spark: SparkSession, src: dict[str, str], root: str, as_of: dt.datetime | None = None) -> LoadReport:
    """IO12: users upsert, merchants upsert, then transactions incrementally.
    ``src`` maps table name -> CSV path."""
    as_of = as_of or dt.datetime.now()
    for name in ("users", "merchants"):
        df = rawsrc.conform(rawsrc.read_raw(spark, src[name], name), name)
        load_dimension(spark, df, root, name, as_of)
    tx = rawsrc.read_raw(spark, src["transactions"], "transactions")
    rawsrc.require_columns(tx, ["transaction_ts"], TRANSACTIONS_TABLE)
    return load_transactions(spark, rawsrc.conform(tx, "transactions", as_of), root, as_of, references=True)
