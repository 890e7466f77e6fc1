"""Incremental transaction loading as a Structured Streaming job.

The batch loader (``paymart.operators.ingest``) loads one file per call and
guards re-delivery with a high-water mark.  Here new CSV files landing in a
folder are picked up by the file source, whose checkpoint remembers which
files were processed (so a restarted or failed job neither skips nor
re-reads a file), and every micro-batch goes through the same rules:

  conform -> load rules -> keep rows newer than the mark -> insert-if-absent -> advance mark

The mark is the one stored when the stream starts, so what is kept does not
depend on how the files of a run fall into micro-batches.  ``keep_late``
compares with no mark at all: then it does not depend on restarts either.

The load rules include the references, as in the batch loader: a row whose user or merchant is not stored is
rejected.  Only a root that holds no dimension rows at all has nothing to compare with; there, unless
``references=True``, rows are stored without this rule.

``trigger(availableNow=True)`` processes everything that has landed and
stops, which is how a scheduled load runs; a continuous trigger gives a
long-running loader with the same semantics.  The checkpoint lives under
the session's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import datetime as dt
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paymart.operators import ingest
from paymart.session import checkpoint_root
from paymart.sources import raw as rawsrc
from paymart.sources import schemas


def _apply_batch(spark: SparkSession, root: str, as_of: dt.datetime | None, reports: deque,
                 mark: dt.datetime | None, references: bool | None):
    def run(batch: DataFrame, epoch_id: int) -> None:
        check = references
        if check is None:
            check = any(not ingest.read_current(spark, root, n).isEmpty() for n in ("users", "merchants"))
        conformed = rawsrc.conform(batch, "transactions", as_of or dt.datetime.now())
        reports.append(ingest.load_transactions(spark, conformed, root, as_of, references=check, mark=mark))
    return run


def stream_transactions(spark: SparkSession, landing_dir: str, root: str, as_of: dt.datetime | None = None,
                        checkpoint: str | None = None, available_now: bool = True, keep_late: bool = False,
                        references: bool | None = None):
    """Start the loader; returns (StreamingQuery, the newest 1,000 per-batch LoadReports)."""
    declared = [f for f in schemas.TRANSACTIONS if f.name != "created_at"]
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in declared])
    stream = (spark.readStream.schema(schema).option("header", True).option("mode", "FAILFAST")
              .option("timestampFormat", "yyyy-MM-dd[ ]['T']HH:mm:ss[.SSSSSS]").csv(landing_dir))
    checkpoint = checkpoint or f"{checkpoint_root(spark).rstrip('/')}/paymart/stream-transactions"
    reports: deque = deque(maxlen=1000)
    mark = None if keep_late else ingest.get_watermark(ingest.read_current(spark, root, "watermark"))
    writer = (stream.writeStream.foreachBatch(_apply_batch(spark, root, as_of, reports, mark, references))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(), reports


def late_rows(batch: DataFrame, state: DataFrame) -> DataFrame:
    """Rows of a batch at or before the mark: the loader skips them silently;
    this makes them visible."""
    mark = state.where(F.col("table_name") == "raw.transactions").agg(F.max("last_loaded_ts")).scalar()
    return batch.where(mark.isNotNull() & (F.col("transaction_ts") <= mark))
