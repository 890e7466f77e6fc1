"""Data-quality checks report planted defects."""

import datetime as dt
from decimal import Decimal

from paymart.operators import quality as Q
from paymart.sources import schemas


def test_checks_find_planted_defects(spark):
    ts = dt.datetime(2024, 2, 1, 10)
    good = ("T1", "USR_00000001", "MER_000001", "Retail", "UPI", Decimal("5.00"), "INR", "success", False, "mobile",
            None, None, ts, None)
    rows = [good,
            ("T1", "USR_00000001", "MER_000001", "Retail", "UPI", Decimal("5.00"), "INR", "success", False, "mobile",
             None, None, ts, None),                                                  # duplicate id
            ("T2", "USR_00000002", "MER_999999", "Toys", "Cash", None, "USD", None, None, "tv", None, None, ts, None)]
    tx = spark.createDataFrame(rows, schemas.TRANSACTIONS)
    users = spark.createDataFrame([("USR_00000001", "18-25", "savings", None, None, None),
                                   ("user-2", "18-25", "savings", None, None, None)], schemas.USERS)
    merchants = spark.createDataFrame([("MER_000001", "A", "Retail", None, None, None)], schemas.MERCHANTS)
    models = {"raw.transactions": tx, "raw.users": users, "raw.merchants": merchants}

    nn = {(r.model, r.column_name): r.failing_rows for r in Q.dq_not_null(models).collect()}
    assert nn[("raw.transactions", "amount")] == 1 and nn[("raw.transactions", "status")] == 1
    uq = {(r.model, r.column_name): r.duplicate_keys for r in Q.dq_unique(models).collect()}
    assert uq[("raw.transactions", "transaction_id")] == 1 and uq[("raw.users", "user_id")] == 0
    av = {(r.model, r.column_name): r.failing_rows for r in Q.dq_accepted_values(models).collect()}
    assert av[("raw.transactions", "merchant_category")] == 1 and av[("raw.transactions", "status")] == 0  # NULL passes
    assert av[("raw.transactions", "currency")] == 1 and av[("raw.transactions", "device_type")] == 1
    orph = Q.dq_orphans(tx, users, merchants).first()
    assert (orph.orphan_users, orph.orphan_merchants) == (1, 1)
    kf = {r.model: r.failing_rows for r in Q.dq_key_format(users, merchants).collect()}
    assert kf == {"raw.users": 1, "raw.merchants": 0}
    assert [r.status for r in Q.dq_status(tx).collect()] == [None]                   # NULL is a failure here
    assert Q.dq_null_keys(tx).first().null_key_rows == 0


def test_replayed_deliveries_show_their_faults(spark, wh_small):
    from paymart.plans.replay import replay_of
    replay = replay_of(wh_small)
    first, second, third = replay.reports
    assert first.rows_rejected == first.rows_skipped_late == 0
    assert second.rows_rejected > 0 and second.rows_skipped_late > 0 and third.rows_rejected == 0
    counts = {r.table_name: r.matches_expected for r in replay.row_counts().collect()}
    assert counts == {"users": True, "merchants": True, "transactions": False}
    mark = replay.watermark().first()
    assert mark.row_exists and not mark.rows_match and not mark.mark_matches_max
    assert {r.reject_reason for r in replay.rejected().collect()} >= {"merchant_id is null", "unknown user_id"}


def test_text_values_that_do_not_parse_are_kept_beside_the_row(spark):
    from paymart.sources import text
    rows = spark.createDataFrame([("T1", "n/a", "2024-01-01 00:00:00"), ("T2", " 12.50 ", None), ("T3", "", "soon"), ("T4", None, "x")],
                                 "transaction_id string, amount string, transaction_ts string")
    got = {r.transaction_id: (r.amount, [tuple(v) for v in r.rejected_values]) for r in text.typed(rows, "transactions").collect()}
    from decimal import Decimal
    assert got == {"T1": (None, [("amount", "n/a")]), "T2": (Decimal("12.50"), []), "T3": (None, [("transaction_ts", "soon")]),
                   "T4": (None, [("transaction_ts", "x")])}
    counts = {r.column: (r.rejected, r.example) for r in text.rejected_counts(text.typed(rows, "transactions")).collect()}
    assert counts == {"amount": (1, "n/a"), "transaction_ts": (2, "soon")}
