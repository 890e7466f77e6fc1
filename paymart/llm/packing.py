"""Operator 9, best-fit packing by best-two-fit, planned on the counts of each length.

Every document becomes its token ids and an end id; one longer than the capacity is cut into full pieces and a rest. Only
the number of pieces of each length matters for a plan, and lengths go from 1 to the capacity, so the driver plans on at
most that many numbers, whatever the size of the corpus. The plan fills a sequence greedily, largest length first, then
the largest that still fits; while a gap is left, it replaces the smallest piece by the two unpacked lengths that fill the
widened gap best, if they fill more. The resulting pattern is repeated as often as the counts allow. A pattern uses up one
of its lengths to below its own use, so there are at most capacity + sum(capacity / length) patterns (18,000 for 2048):
the plan is of bounded size and is broadcast.

Pieces find their place by their rank among the pieces of their length. Ranks are counted in salted groups whose number
grows with the input, so a length that a third of all documents share is spread over many tasks.

Null and empty texts have just the end id. Repeated rows are packed once each; ranks among equal rows may swap, which
changes nothing but which copy is where. An empty table gives no sequences. Other columns, whatever their names, aren't
read. A task holds one document's ids at a time."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paymart.llm.common import cut, runs, workers_can_import
from paymart.llm.token_cache import library_encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
GROUP_ROWS = 50_000


def token_pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """PIECES of every document, and their ids (little-endian unsigned 32-bit) if asked for."""
    workers_can_import(docs.sparkSession)
    schema = PIECES + (", token_ids binary" if with_ids else "")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(path)
        for batch in runs(batches, "t", 1 << 20, "tokens"):
            rows = []
            ids = encoder.encode(batch.column("t"))
            for doc_id, raw in zip(batch.column("i").to_pylist(), ids):
                raw += end
                for k in range(0, len(raw), 4 * capacity):
                    part = raw[k : k + 4 * capacity]
                    rows.append((doc_id, k // (4 * capacity), k // 4, len(part) // 4, zlib.crc32(part), part))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 5 + with_ids]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [f.split()[0] for f in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("i"), F.col("text").alias("t")).mapInArrow(run, schema)


def plan_patterns(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(times, lengths of a sequence) of all sequences, by best-two-fit."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    patterns = []
    while left.any():
        left_now = left.copy()
        pattern, gap = [], capacity
        while gap and len(fits := np.flatnonzero(left_now[: gap + 1])):
            pattern.append(int(fits[-1]))
            left_now[pattern[-1]] -= 1
            gap -= pattern[-1]
        while gap and len(pattern) > 1:
            smallest = pattern[-1]
            wide = gap + smallest
            a = np.flatnonzero(left_now[: wide + 1])
            if not len(a):
                break
            below = np.zeros(wide + 1, np.int64)  # the largest unpacked length up to each number
            below[a] = a
            below = np.maximum.accumulate(below)
            b = below[np.minimum(a, wide - a)]
            single = (b == a) & (left_now[a] < 2)
            b[single] = below[a[single] - 1]
            fill = np.where(b > 0, a + b, 0)
            k = int(fill.argmax())
            if fill[k] <= smallest:
                break
            pattern[-1:] = [int(a[k]), int(b[k])]
            left_now[smallest] += 1
            left_now[a[k]] -= 1
            left_now[b[k]] -= 1
            gap = wide - int(fill[k])
            pattern.sort(reverse=True)
        lengths, uses = np.unique(pattern, return_counts=True)
        times = int((left[lengths] // uses).min())
        left[lengths] -= times * uses
        patterns.append((times, pattern))
    return patterns


def slots(patterns: list[tuple[int, list[int]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: where the pieces of a length go, by rank."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for times, pattern in patterns:
        offset = 0
        for length in pattern:
            first = used.get(length, 0)
            rows.append((length, first, sequence, offset))
            used[length] = first + times
            offset += length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """`pieces` with sequence_id and offset. `pieces` must be cut off from its lineage, as it is read several times."""
    spark = pieces.sparkSession
    workers_can_import(spark)
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    table = spark.sparkContext.broadcast(slots(plan_patterns(counts, capacity)))
    groups = -(-sum(counts.values()) // GROUP_ROWS) or 1
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(groups)))
    sizes = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = salted.withColumn("row", F.row_number().over(inside)).join(bases, ["length", "salt"])
    ranked = ranked.select(*pieces.columns, (F.col("base") + F.col("row") - 1).alias("rank"))
    out = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = table.value
        keys = rows[:, 0] * (1 << 48) + rows[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            at = np.searchsorted(keys, length * (1 << 48) + rank, "right") - 1
            sequence = rows[at, 2] + rank - rows[at, 1]
            kept = [batch.column(c) for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(rows[at, 3])], [*(c for c in batch.schema.names if c != "rank"), "sequence_id", "offset"])

    return ranked.mapInArrow(place, out)


def op9_best_two_fit(docs: DataFrame, path: str, capacity: int = 2048) -> DataFrame:
    return pack(cut(token_pieces(docs, path, capacity)), capacity)
