"""Deliveries replayed through the real loader, with planted faults (IO12, Q7, Q13).

The raw transactions are delivered in three parts to an empty root, as a source
system would send them:

1. everything before FIRST_END;
2. the whole of SECOND (which reaches back before FIRST_END: late rows), in
   which some rows lack a required value and some name an unknown user;
3. the rest, with some of the second delivery's transactions sent again under
   their ids with another status and a later time (the stored ones win).

``loads`` is what the loader reported, ``rejected`` why rows were left out;
``row_counts`` and ``watermark`` are the quality checks on the loaded tables,
and show the planted faults.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.operators import ingest as I
from paymart.operators import quality as Q
from paymart.plans.warehouse import Warehouse
from paymart.session import scratch_path

# Fixed parameters of the replay.
FIRST_END = dt.datetime(2024, 5, 1)
SECOND = (dt.datetime(2024, 4, 1), dt.datetime(2024, 9, 1))
LOADED_AT = (dt.datetime(2025, 7, 1), dt.datetime(2025, 7, 2), dt.datetime(2025, 7, 3))
EVERY_NO_MERCHANT, EVERY_STRANGER, EVERY_AGAIN = 97, 89, 53   # by the number in transaction_id
STRANGER = "USR_99999999"
AGAIN_STATUS = "disputed"

_LOADS = "delivery int, rows_in_file long, rows_after_mark long, rows_skipped_late long, rows_rejected long"


def _number() -> F.Column:
    return F.substring("transaction_id", 5, 10).cast("bigint")


def deliveries(tx: DataFrame) -> list[DataFrame]:
    ts, n = F.col("transaction_ts"), _number()
    first = tx.where(ts < F.lit(FIRST_END))
    second = (tx.where((ts >= F.lit(SECOND[0])) & (ts < F.lit(SECOND[1])))
              .withColumn("merchant_id", F.when(n % EVERY_NO_MERCHANT != 0, F.col("merchant_id")))
              .withColumn("user_id", F.when(n % EVERY_STRANGER == 0, F.lit(STRANGER)).otherwise(F.col("user_id"))))
    again = (tx.where((ts >= F.lit(FIRST_END)) & (ts < F.lit(SECOND[1])) & (n % EVERY_AGAIN == 0))
             .withColumn("status", F.lit(AGAIN_STATUS))
             .withColumn("transaction_ts", ts + F.expr("interval 1 year")))
    return [first, second, tx.where(ts >= F.lit(SECOND[1])).unionByName(again)]


class Replay:
    def __init__(self, wh: Warehouse):
        self.spark, self.raw = wh.spark, wh.raw
        self.root = scratch_path(wh.spark, "replay")
        for name in ("users", "merchants"):
            I.load_dimension(self.spark, self.raw[name], self.root, name, LOADED_AT[0])
        self.reports = [I.load_transactions(self.spark, batch, self.root, at, references=True)
                        for batch, at in zip(deliveries(self.raw["transactions"]), LOADED_AT)]

    def table(self, name: str) -> DataFrame:
        return I.read_current(self.spark, self.root, name)

    def loads(self) -> DataFrame:
        return self.spark.createDataFrame(
            [(k, r.rows_in_file, r.rows_after_mark, r.rows_skipped_late, r.rows_rejected)
             for k, r in enumerate(self.reports, 1)], _LOADS)

    def rejected(self) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.root}/raw/rejected_transactions")
        return rows.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows"))

    def row_counts(self) -> DataFrame:
        """Q7 against the source's own counts."""
        wanted = {n: self.raw[n].count() for n in ("users", "merchants", "transactions")}
        return Q.dq_row_counts({n: self.table(n) for n in wanted}, wanted)

    def watermark(self) -> DataFrame:
        """Q13 on the state that three loads left: its count is the last load's, and its mark is that of a transaction
        sent again, which the table holds under its first time."""
        return Q.dq_watermark(self.table("watermark"), self.table("transactions"))


_REPLAYS: dict[int, tuple[Warehouse, Replay]] = {}


def replay_of(wh: Warehouse) -> Replay:
    """One replay per warehouse (the queries below share it)."""
    if id(wh) not in _REPLAYS:
        _REPLAYS[id(wh)] = (wh, Replay(wh))
    return _REPLAYS[id(wh)][1]
