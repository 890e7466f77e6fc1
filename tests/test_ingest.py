"""Incremental loading: mark filter, insert-if-absent, upsert, watermark."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paymart.operators import ingest
from paymart.operators.table_log import EMPTY, Entry, TableLog, key_ranges
from paymart.sources import raw as rawsrc
from paymart.sources import schemas

MARK = dt.datetime(2024, 3, 1, 12)


def tx(tid, ts, created=dt.datetime(2025, 7, 1), status="success"):
    return (tid, "USR_00000001", "MER_000001", "Retail", "UPI", Decimal("10.00"), "INR", status, False, "mobile",
            None, None, ts, created)


def test_mark_is_strict_and_late_rows_skipped(spark):
    batch = spark.createDataFrame([tx("late", MARK - dt.timedelta(days=1)), tx("equal", MARK),
                                   tx("new", MARK + dt.timedelta(microseconds=1))], schemas.TRANSACTIONS)
    assert [r.transaction_id for r in ingest.filter_new(batch, MARK).collect()] == ["new"]
    assert ingest.filter_new(batch, None).count() == 3


def test_insert_if_absent_existing_and_first_in_batch_win(spark):
    target = spark.createDataFrame([tx("A", MARK, status="success")], schemas.TRANSACTIONS)
    batch = spark.createDataFrame([tx("A", MARK + dt.timedelta(hours=1), status="failed"),
                                   tx("B", MARK + dt.timedelta(hours=2), status="declined"),
                                   tx("B", MARK + dt.timedelta(hours=1), status="disputed")], schemas.TRANSACTIONS)
    got = {r.transaction_id: r.status for r in ingest.insert_new(target, batch, "transaction_id").collect()}
    assert got == {"A": "success", "B": "disputed"}


def test_upsert_last_wins_and_missing_columns_keep_value(spark):
    target = spark.createDataFrame([("U1", "18-25", "savings", dt.date(2024, 1, 1), "Pune", "MH"),
                                    ("U2", "26-35", "current", dt.date(2024, 1, 2), "Delhi", "DL")], schemas.USERS)
    batch = spark.createDataFrame([("U1", "Mumbai"), ("U3", "Chennai")], "user_id string, city string")
    got = {r.user_id: (r.city, r.state, r.age_group) for r in ingest.upsert(target, batch, "user_id").collect()}
    assert got == {"U1": ("Mumbai", "MH", "18-25"), "U2": ("Delhi", "DL", "26-35"), "U3": ("Chennai", None, None)}
    dup = spark.createDataFrame([("U1", "A"), ("U1", "B")], "user_id string, city string")
    with pytest.raises(ingest.DuplicateKeyError):
        ingest.upsert(target, dup, "user_id")


def test_missing_ts_column_is_an_error(spark, tmp_root):
    path = f"{tmp_root}/bad.csv"
    with open(path, "w") as fh:
        fh.write("user_id,amount\nUSR_00000001,100.00\n")
    df = rawsrc.read_raw(spark, path, "transactions")
    with pytest.raises(ValueError, match="transaction_ts"):
        ingest.load_transactions(spark, df, tmp_root)


def _write_csv(path, rows, header):
    with open(path, "w") as fh:
        fh.write(",".join(header) + "\n")
        for r in rows:
            fh.write(",".join("" if v is None else str(v) for v in r) + "\n")


def test_full_ingest_twice_and_watermark(spark, tmp_root):
    users = [("USR_00000001", "18-25", "savings", "2024-01-01", "Pune", "MH")]
    merchants = [("MER_000001", "Shop", "Retail", "Pune", "MH", "2023-01-01")]
    tx_header = [f.name for f in schemas.TRANSACTIONS if f.name != "created_at"]
    rows1 = [(f"T{i}", "USR_00000001", "MER_000001", "Retail", "UPI", "10.00", "INR", "success", "false", "mobile",
              "", "", f"2024-03-0{i} 10:00:00") for i in range(1, 4)]
    src = {}
    for name, data, header in (("users", users, [f.name for f in schemas.USERS]),
                               ("merchants", merchants, [f.name for f in schemas.MERCHANTS]),
                               ("transactions", rows1, tx_header)):
        src[name] = f"{tmp_root}/{name}.csv"
        _write_csv(src[name], data, header)
    root = f"{tmp_root}/wh"
    rep = ingest.ingest(spark, src, root, as_of=dt.datetime(2025, 7, 1))
    assert (rep.rows_in_file, rep.rows_after_mark, rep.rows_skipped_late) == (3, 3, 0)
    state = ingest.read_current(spark, root, "watermark").collect()
    assert len(state) == 1 and state[0].rows_loaded == 3 and state[0].last_loaded_ts == dt.datetime(2024, 3, 3, 10)
    # second delivery: one late row, one at the mark, two new
    rows2 = rows1[:1] + rows1[2:] + [(f"T{i}", *rows1[0][1:12], f"2024-03-0{i} 10:00:00") for i in (4, 5)]
    _write_csv(src["transactions"], rows2, tx_header)
    rep2 = ingest.ingest(spark, src, root, as_of=dt.datetime(2025, 7, 2))
    assert (rep2.rows_after_mark, rep2.rows_skipped_late) == (2, 2)
    txs = ingest.read_current(spark, root, "transactions")
    assert txs.count() == 5 and txs.where(F.col("currency") == "INR").count() == 5
    assert ingest.read_current(spark, root, "watermark").first().rows_loaded == 2
    ingest.reset_raw(spark, root)
    assert ingest.read_current(spark, root, "transactions").count() == 0


def _tx_frame(spark, rows):
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schemas.TRANSACTIONS])
    return spark.createDataFrame(rows, loose)


def _users(spark, *ids):
    return spark.createDataFrame([(i, "18-25", "savings", dt.date(2024, 1, 1), "Pune", "MH") for i in ids], schemas.USERS)


def test_lost_log_is_an_error_and_not_an_empty_table(spark, tmp_root):
    ingest._write_version(_users(spark, "U1", "U2"), tmp_root, "users", "1")
    with pytest.raises(ingest.UnpublishedDataError):
        ingest.read_current(spark, tmp_root, "users")
    with pytest.raises(ingest.UnpublishedDataError):
        ingest.load_dimension(spark, _users(spark, "U3"), tmp_root, "users")


@pytest.mark.parametrize("stop_at", range(4))
def test_a_load_that_stops_before_any_commit_loses_nothing(spark, tmp_root, monkeypatch, stop_at):
    first = _tx_frame(spark, [tx("A", MARK), tx("B", MARK + dt.timedelta(hours=1))])
    second = _tx_frame(spark, [tx("B", MARK + dt.timedelta(hours=3)), tx("C", MARK + dt.timedelta(hours=2))])
    ingest.load_transactions(spark, first, tmp_root)
    steps = [0]

    def stops(real):
        def run(*args, **kw):
            if steps[0] == stop_at:
                raise KeyboardInterrupt
            steps[0] += 1
            return real(*args, **kw)
        return run

    with monkeypatch.context() as m:
        m.setattr(ingest, "_write_version", stops(ingest._write_version))
        m.setattr(TableLog, "write_sorted", stops(TableLog.write_sorted))
        m.setattr(TableLog, "_write", stops(TableLog._write))
        with pytest.raises(KeyboardInterrupt):
            ingest.load_transactions(spark, second, tmp_root)
    seen = {r.transaction_id for r in ingest.read_current(spark, tmp_root, "transactions").collect()}
    assert seen in ({"A", "B"}, {"A", "B", "C"})
    assert ingest.read_current(spark, tmp_root, "watermark").first().last_loaded_ts == MARK + dt.timedelta(hours=1)
    ingest.load_transactions(spark, second, tmp_root)
    got = sorted((r.transaction_id, r.transaction_ts) for r in ingest.read_current(spark, tmp_root, "transactions").collect())
    assert got == [("A", MARK), ("B", MARK + dt.timedelta(hours=1)), ("C", MARK + dt.timedelta(hours=2))]
    assert ingest.read_current(spark, tmp_root, "watermark").first().last_loaded_ts == MARK + dt.timedelta(hours=3)


def test_compaction_keeps_rows_and_shortens_the_listing(spark, tmp_root):
    for k in range(3):
        ingest.load_transactions(spark, _tx_frame(spark, [tx(f"T{k}", MARK + dt.timedelta(hours=k))]), tmp_root)
    before = sorted(map(tuple, ingest.read_current(spark, tmp_root, "transactions").collect()))
    ingest.compact_transactions(spark, tmp_root)
    table = ingest.read_current(spark, tmp_root, "transactions")
    assert sorted(map(tuple, table.collect())) == before and len({f.rpartition("/")[0] for f in table.inputFiles()}) == 1
    ingest.load_transactions(spark, _tx_frame(spark, [tx("T9", MARK + dt.timedelta(hours=9))]), tmp_root)
    assert ingest.read_current(spark, tmp_root, "transactions").count() == 4


def test_load_rules_reject_with_reason(spark, tmp_root):
    ingest.load_dimension(spark, _users(spark, "USR_00000001"), tmp_root, "users")
    merchant = spark.createDataFrame([("MER_000001", "Shop", "Retail", "Pune", "MH", dt.date(2023, 1, 1))], schemas.MERCHANTS)
    ingest.load_dimension(spark, merchant, tmp_root, "merchants")
    stranger = ("S", "USR_9", *tx("S", MARK)[2:])
    batch = _tx_frame(spark, [tx("A", MARK), tx("N", None), tx(None, MARK), stranger])
    rep = ingest.load_transactions(spark, batch, tmp_root, references=True)
    assert (rep.rows_in_file, rep.rows_after_mark, rep.rows_skipped_late, rep.rows_rejected) == (4, 1, 0, 3)
    assert [r.transaction_id for r in ingest.read_current(spark, tmp_root, "transactions").collect()] == ["A"]
    rejected = spark.read.parquet(f"{tmp_root}/raw/rejected_transactions")
    assert sorted(r.reject_reason for r in rejected.collect()) == [
        "transaction_id is null", "transaction_ts is null", "unknown user_id"]


def test_streamed_rows_keep_the_reference_rule(spark, tmp_root):
    from paymart.streaming.incremental import stream_transactions
    ingest.load_dimension(spark, _users(spark, "USR_00000001"), tmp_root, "users")
    merchant = spark.createDataFrame([("MER_000001", "Shop", "Retail", "Pune", "MH", dt.date(2023, 1, 1))], schemas.MERCHANTS)
    ingest.load_dimension(spark, merchant, tmp_root, "merchants")
    rows = _tx_frame(spark, [tx("A", MARK), ("S", "USR_9", *tx("S", MARK)[2:])]).drop("created_at")
    rows.coalesce(1).write.csv(f"{tmp_root}/landing", header=True, timestampFormat="yyyy-MM-dd HH:mm:ss")
    query, reports = stream_transactions(spark, f"{tmp_root}/landing", tmp_root, dt.datetime(2025, 7, 1), f"{tmp_root}/ckpt")
    query.awaitTermination(120)
    assert [r.transaction_id for r in ingest.read_current(spark, tmp_root, "transactions").collect()] == ["A"]
    assert sum(r.rows_rejected for r in reports) == 1
    assert [r.reject_reason for r in spark.read.parquet(f"{tmp_root}/raw/rejected_transactions").collect()] == ["unknown user_id"]


def test_rows_loaded_holds_more_than_an_int(spark):
    assert dict(ingest.watermark_row(_tx_frame(spark, [tx("A", MARK)])).dtypes)["rows_loaded"] == "bigint"


def test_only_folders_that_can_hold_a_key_are_opened(spark, tmp_root):
    """Loads of neighbouring keys: a delivery that overlaps one of them reads that one's files only, and its own batch once."""
    for k in range(4):
        rows = [tx(f"T{k}{i:03d}", MARK + dt.timedelta(hours=24 * k, minutes=i)) for i in range(50)]
        ingest.load_transactions(spark, _tx_frame(spark, rows), tmp_root, references=False)
    table = ingest.raw_table(spark, tmp_root, "transactions")
    again = [tx(f"T3{i:03d}", MARK + dt.timedelta(days=30, minutes=i), status="failed") for i in range(40, 60)]
    batch = _tx_frame(spark, again)
    files = table.files_with(key_ranges(batch, "transaction_id"))
    newest = table.live()[-1].version
    assert files and all(f"/v={newest}/" in f for f in files)
    assert len(files) < len(ingest.read_current(spark, tmp_root, "transactions").inputFiles())
    # files of the other loads are unreadable now: the load must not open them
    import glob
    import os
    for f in glob.glob(f"{tmp_root}/raw/transactions/v=*/part-*"):
        if newest not in f:
            os.truncate(f, 1)
    for crc in glob.glob(f"{tmp_root}/raw/transactions/v=*/.part-*.crc"):
        os.unlink(crc)
    evaluated = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            evaluated.add(b.num_rows)
            yield b

    counted = batch.mapInArrow(seen, batch.schema)
    rep = ingest.load_transactions(spark, counted, tmp_root)
    assert rep.rows_after_mark == 20 and evaluated.value == 20
    live = ingest.raw_table(spark, tmp_root, "transactions").live()
    assert [e.rows for e in live] == [50, 50, 50, 50, 10]


def test_log_epochs_and_merged_folders(spark, tmp_root):
    state = TableLog(spark, f"{tmp_root}/s", epoch_lines=3)
    for k in range(12):
        state.commit(f"v{k}")
        assert [e.version for e in TableLog(spark, f"{tmp_root}/s", epoch_lines=3).live()] == [f"v{k}"]
    assert state._epoch > 2 and len(state.lines()) < 6
    path = f"{tmp_root}/t"
    log = TableLog(spark, path)
    log.begin()
    for k in range(6):
        spark.range(k, k + 1).write.parquet(f"{path}/v=v{k}")
        log.commit(f"v{k}", "add", rows=1)
    spark.range(4).write.parquet(f"{path}/v=m")
    log.merge([e for e in log.live() if e.version in {f"v{j}" for j in range(4)}], "m", 4)
    again = TableLog(spark, path)
    assert [(e.version, e.seq) for e in again.live()] == [("m", 4), ("v4", 5), ("v5", 6)]
    assert sorted(r.id for r in again.read().collect()) == list(range(6))
    again.commit("v5b", "add")
    assert TableLog(spark, path).live()[-1].seq == 7
    again.commit(EMPTY)
    assert TableLog(spark, path).live() == []
    entry = Entry(3, "part", "v", "2024-05 x/y", 7)
    assert Entry.read(entry.line()) == entry


def test_partitions_are_replaced_alone(spark, tmp_root):
    path = f"{tmp_root}/p"
    log = TableLog(spark, path)
    log.begin()
    for version, months in (("a", {"2024-01": 1, "2024-02": 1}), ("b", {"2024-02": 2}), ("c", {"2024-01": 0})):
        if any(months.values()):
            rows = [(m, i) for m, n in months.items() for i in range(n)]
            spark.createDataFrame(rows, "part string, x int").write.partitionBy("part").parquet(f"{path}/v={version}")
        log.commit(version, "part", months)
    live = TableLog(spark, path)
    assert [(e.part, e.version) for e in live.live()] == [("2024-02", "b")]
    assert live.read().count() == 2 and live.read(parts={"2024-01"}) is None


def test_many_loads_stay_few_folders(spark, tmp_root):
    table = ingest.raw_table(spark, tmp_root, "transactions")
    table.begin()
    for k in range(7):
        version = f"x{k}"
        n = table.write_sorted(_tx_frame(spark, [tx(f"T{k}", MARK + dt.timedelta(hours=k))]), version, "transaction_id")
        table.commit(version, "add", rows=n)
        ingest.merge_small_folders(table, "transactions", fanout=3)
    live = ingest.raw_table(spark, tmp_root, "transactions").live()
    assert sorted(e.rows for e in live) == [1, 3, 3]
    assert sorted(r.transaction_id for r in ingest.read_current(spark, tmp_root, "transactions").collect()) == [f"T{k}" for k in range(7)]


def test_dimension_rules(spark, tmp_root):
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schemas.USERS])
    good = ("U1", "18-25", "savings", dt.date(2024, 1, 1), "Pune", "MH")
    ingest.load_dimension(spark, spark.createDataFrame([good], loose), tmp_root, "users")
    bad = [("U1", None, "current", dt.date(2024, 1, 1), "Goa", "GA"), (None, "18-25", "savings", None, None, None),
           ("U2", "26-35", "savings", dt.date(2024, 1, 1), None, None)]
    ingest.load_dimension(spark, spark.createDataFrame(bad, loose), tmp_root, "users")
    got = {r.user_id: r.city for r in ingest.read_current(spark, tmp_root, "users").collect()}
    assert got == {"U1": "Pune", "U2": None}
    reasons = sorted(r.reject_reason for r in spark.read.parquet(f"{tmp_root}/raw/rejected_users").collect())
    assert len(reasons) == 2 and reasons[0].startswith("age_group is null")
    # a batch without a required column: known keys keep their value, new ones have none
    part = spark.createDataFrame([("U1", "Delhi"), ("U3", "Agra")], "user_id string, city string")
    ingest.load_dimension(spark, part, tmp_root, "users")
    assert {r.user_id: r.city for r in ingest.read_current(spark, tmp_root, "users").collect()} == {"U1": "Delhi", "U2": None}


def test_only_rows_of_repeated_keys_are_compared(spark):
    rows = [("a", 1, "x"), ("a", 1, "y"), ("b", 5, "z"), (None, 3, "p"), (None, 2, "q"), ("c", 9, "r"), ("a", 0, "w")]
    batch = spark.createDataFrame(rows, "k string, transaction_ts int, v string")
    got, wanted = ingest.one_per_key(batch, "k"), ingest.first_per_key(batch, "k")
    assert got.columns == batch.columns and sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))


def test_long_key_lists_of_a_load_are_not_broadcast(spark, monkeypatch):
    """Left to itself, Spark broadcasts them by their compressed size, through the driver."""
    monkeypatch.setattr(ingest, "MAX_BROADCAST_KEYS", 1)
    rows = [(f"k{i}", i) for i in range(5)]
    target, batch = (spark.createDataFrame(rows[k:], "k string, v int") for k in (0, 3))
    plan = ingest._short(batch.select("k"))
    joined = target.join(plan, "k", "left_semi")
    joined.collect()
    tree = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in tree and "BroadcastHashJoin" not in tree
    assert sorted(map(tuple, ingest.upsert(target, batch.limit(2).withColumn("v", F.lit(7)), "k").collect())) == [("k0", 0), ("k1", 1), ("k2", 2), ("k3", 7), ("k4", 7)]
