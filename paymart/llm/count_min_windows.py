"""Operator 12, substring deduplication: a count-min prefilter picks the word windows that an exact pass groups.

A window is `width` consecutive words of one document, known by 128 bits of hash over its words. Texts are gathered into
chunks of about CHUNK bytes, a row each, so that every pass sees the same windows.

Pass one: a chunk makes a sparse count-min sketch of its windows, two rows of cells with counts up to two, and sends each
stretch of cells (a shard, picked by the hash) to the task that merges it. Counts only ever add up, so that a merged cell
never holds less than the windows in it; the shard answers each chunk with a bit a cell: estimated to repeat or not. There
are CELLS cells a window and row, so the sketch grows with the corpus while a task holds one shard of it.

Pass two: a window both of whose cells are estimated to repeat goes on, and no repeated window is lost. A chunk sends each
of these once, with the smallest id that has it, to the task of its hash range, which groups them exactly and answers with
a bit: a smaller id has it in another chunk. A window that very many documents share is a row a chunk there, not a row an
occurrence. What repeats within a chunk or a document needs no answer and is seen when the words are cut.

A window's word goes if the same words also start earlier: in a smaller id, or before it in its own row. A null id counts
as the largest long. Rows that share an id are none earlier than the other, so equal rows with one id stay alike. Null and
empty texts have no words; words are split at blanks and the characters 9 to 13 alone; separators don't count. Texts of any
length are scanned whole. An empty table gives an empty one. Other columns, whatever their names, are not read."""

from __future__ import annotations

import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.common import cut, runs, workers_can_import

WIDTH, CELLS, SHARD, CHUNK, GROUP = 20, 4, 1 << 23, 4 << 20, 1 << 21
CHUNKS = "chunk long, windows long, ids array<long>, sizes array<long>, body binary"
SKETCHES = "shard long, chunk long, one binary, two binary"
GROUPS = "shard long, chunk long, hashes binary, ids binary"
ANSWERS = "chunk long, kind long, shard long, one binary, two binary"
KEPT = "doc_id long, n_words long, n_removed long, kept binary"
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASES = (0x5851F42D4C957F2D, 0x14057B7EF767814F)
_HEAD = struct.Struct("<IB")
_LAST = (1 << 63) - 1
_ARROW = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
_POWERS: dict[int, np.ndarray] = {}


def _filled(schema: str, rows: list[tuple] | None = None) -> pa.Table:
    fields = [f.split(" ") for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.table([pa.array(c, _ARROW[kind]) for (_, kind), c in zip(fields, columns)], [name for name, _ in fields])


def _powers(base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(base, ())) < n:
        steps = np.full(max(n, 1 << 20), base, np.uint64)
        steps[0] = 1
        _POWERS[base] = np.cumprod(steps)
    return _POWERS[base]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _zstd() -> pa.Codec:
    return pa.Codec("zstd", 1)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(is space, starts, ends) of the words of texts that a line feed ends."""
    space = _SPACE[data]
    after = np.concatenate([[True], space[:-1]]) if len(space) else space
    return space, np.flatnonzero(after & ~space), np.flatnonzero(space & ~after)


def chunks(docs: DataFrame, width: int, size: int) -> DataFrame:
    """CHUNKS of (i, t): t is the text in UTF-8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = itertools.count(TaskContext.get().partitionId() << 32)
        for batch in runs(batches, "t", size):
            texts = [(t or b"") + b"\n" for t in batch.column("t").to_pylist()]
            raw, sizes = b"".join(texts), np.array([len(t) for t in texts])
            _, starts, _ = word_bounds(np.frombuffer(raw, np.uint8))
            words = np.bincount(np.searchsorted(np.cumsum(sizes), starts, "right"), minlength=len(sizes))
            row = (next(number), int(np.maximum(words - width + 1, 0).sum()), batch.column("i").to_pylist(), sizes.tolist(), _zstd().compress(raw, asbytes=True))
            yield from _filled(CHUNKS, [row]).to_batches()

    return cut(docs.mapInArrow(run, CHUNKS))


class Chunk:
    """The words and windows of a row of CHUNKS."""

    def __init__(self, row: dict, width: int):
        self.number, self.ids, self.width = row["chunk"], row["ids"], width
        sizes = np.array(row["sizes"], np.int64)
        self.data = np.frombuffer(_zstd().decompress(row["body"], int(sizes.sum())), np.uint8)
        self.space, self.starts, self.ends = word_bounds(self.data)
        self.row = np.searchsorted(np.cumsum(sizes), self.starts, "right")  # of each word
        lanes = self._word_hashes()
        n = max(0, len(self.starts) - width + 1)
        self.at = np.flatnonzero(self.row[:n] == self.row[width - 1 :]) if n else np.zeros(0, np.int64)  # first words of windows
        self.h1, self.h2 = (self._windows(lanes[:, k], base) for k, base in enumerate(_BASES))
        order = np.array([_LAST if i is None else i for i in self.ids], np.int64)
        self.id = order[self.row[self.at]]

    def _word_hashes(self) -> np.ndarray:
        lengths = self.ends - self.starts
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.data[~self.space])])
        coded = words.dictionary_encode()
        each = b"".join(xxhash.xxh3_128_digest(w) for w in coded.dictionary.to_pylist())
        return np.frombuffer(each, "<u8").reshape(-1, 2)[coded.indices.to_numpy()]

    def _windows(self, words: np.ndarray, base: int) -> np.ndarray:
        up, down = _powers(base, len(words) + 1), _powers(pow(base, -1, 1 << 64), len(words) + 1)
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[: len(words)], out=sums[1:])
        return _mix((sums[self.at + self.width] - sums[self.at]) * down[self.at])

    def cells(self, shards: int, shard: int) -> list[np.ndarray]:
        """Places of the windows in the two rows of the whole sketch; both in the shard of the first hash."""
        first = _scaled(self.h1, shards) * shard
        return [first + (h & np.uint64(shard - 1)).astype(np.int64) for h in (self.h1, self.h2)]

    def cut(self, gone: np.ndarray) -> list[tuple]:
        """KEPT of the chunk's rows, without the words of the windows that `gone` marks."""
        steps = np.zeros(len(self.starts) + 1, np.int32)
        steps[self.at[gone]] += 1  # no two windows have one start
        steps[self.at[gone] + self.width] -= 1
        keep = np.cumsum(steps)[:-1] == 0
        mark = ~self.space
        mark[self.ends] = True  # a word and one separator
        each = self.data[mark].copy()
        lengths = self.ends - self.starts + 1
        each[np.cumsum(lengths) - 1] = 32
        kept = each[np.repeat(keep, lengths)].tobytes()
        n = len(self.ids)
        words, left = np.bincount(self.row, minlength=n), np.bincount(self.row[keep], minlength=n)
        ends = np.cumsum(np.bincount(self.row[keep], weights=lengths[keep], minlength=n)).astype(np.int64).tolist()
        return [(i, w, w - k, kept[a : max(a, b - 1)]) for i, w, k, a, b in zip(self.ids, words.tolist(), left.tolist(), [0, *ends], ends)]


def _scaled(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def encode_cells(cells: np.ndarray, twice: np.ndarray) -> bytes:
    """Ascending cells as differences, their bytes sorted by weight, and a bit each: counted twice or more."""
    steps = np.diff(cells, prepend=0)
    kind = 2 if not len(steps) or steps.max() < 1 << 16 else 4
    planes = steps.astype(f"<u{kind}").view(np.uint8).reshape(-1, kind).T
    return _HEAD.pack(len(cells), kind) + _zstd().compress(planes.tobytes() + np.packbits(twice).tobytes(), asbytes=True)


def decode_cells(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, kind = _HEAD.unpack_from(data)
    raw = np.frombuffer(_zstd().decompress(data[_HEAD.size :], kind * n + -(-n // 8)), np.uint8)
    steps = np.ascontiguousarray(raw[: kind * n].reshape(kind, n).T).view(f"<u{kind}").ravel()
    return np.cumsum(steps, dtype=np.int64), np.unpackbits(raw[kind * n :], count=n)


def _slices(shards: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(shard, start, end) of ascending shard numbers."""
    starts = np.flatnonzero(np.diff(shards, prepend=-1))
    for s, a, b in zip(shards[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(shards)]):
        yield s, a, b


def _bits(answers: list[tuple[int, bytes]], shards: np.ndarray) -> np.ndarray:
    """Answered bits of ascending items, from (shard, bits)."""
    by_shard = dict(answers)
    return np.concatenate([np.zeros(0, np.uint8), *(np.unpackbits(np.frombuffer(by_shard[s], np.uint8), count=b - a) for s, a, b in _slices(shards))]).astype(bool)


def _read(rows: pa.Table, width: int) -> Chunk:
    return Chunk(rows.to_pylist()[0], width)


def sketches(table: DataFrame, width: int, shards: int, shard: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk, rows = Chunk(row, width), {}
                for places in chunk.cells(shards, shard):
                    cells, n = np.unique(places, return_counts=True)
                    for s, a, b in _slices(cells // shard):
                        rows.setdefault(s, []).append(encode_cells(cells[a:b] - s * shard, n[a:b] > 1))
                yield from _filled(SKETCHES, [(s, chunk.number, *two) for s, two in rows.items()]).to_batches()

    return table.mapInArrow(run, SKETCHES)


def merged(parts: DataFrame, shard: int) -> DataFrame:
    """ANSWERS of kind 1: which cells of each chunk hold two windows or more in the merged sketch."""

    def merge(rows: pa.Table) -> pa.Table:
        bits = []
        for name in ("one", "two"):
            counts = np.zeros(shard, np.uint8)
            column = rows.column(name).to_pylist()
            for data in column:
                cells, twice = decode_cells(data)
                counts[cells] = np.minimum(counts[cells] + 1 + twice, 2)
            bits.append([np.packbits(counts[decode_cells(data)[0]] > 1).tobytes() for data in column])
        return _filled(ANSWERS, [(c, 1, s, *two) for c, s, *two in zip(rows.column("chunk").to_pylist(), rows.column("shard").to_pylist(), *bits)])

    return parts.groupBy("shard").applyInArrow(merge, ANSWERS)


class Candidates:
    """A chunk's windows that the sketch takes for repeated: `at` their numbers, `entry` the distinct window of each."""

    def __init__(self, chunk: Chunk, answers: list[dict], shards: int, shard: int, groups: int):
        good = np.ones(len(chunk.at), bool)
        for places, name in zip(chunk.cells(shards, shard), ("one", "two")):
            cells, own = np.unique(places, return_inverse=True)
            good &= _bits([(a["shard"], a[name]) for a in answers if a["kind"] == 1], cells // shard)[own]
        self.at = np.flatnonzero(good)
        h1, h2, ids = chunk.h1[self.at], chunk.h2[self.at], chunk.id[self.at]
        order = np.lexsort((self.at, h2, h1))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0)
        first = np.flatnonzero(new)
        self.order, self.entry = order, np.cumsum(new) - 1  # of the candidates in this order
        self.h1, self.h2 = h1[order][first], h2[order][first]
        self.least = np.minimum.reduceat(ids[order], first) if len(first) else ids
        self.group = _scaled(self.h1, groups)

    def gone(self, chunk: Chunk, earlier: np.ndarray) -> np.ndarray:
        """Marks windows whose words start earlier; `earlier`: the distinct windows that a smaller id of another chunk has."""
        at = self.at[self.order]
        ids, rows = chunk.id[at], chunk.row[chunk.at[at]]
        again = np.zeros(len(at), bool)
        again[1:] = (np.diff(self.entry) == 0) & (np.diff(rows) == 0)
        marks = np.zeros(len(chunk.at), bool)
        marks[at[earlier[self.entry] | (ids > self.least[self.entry]) | again]] = True
        return marks


def grouped(parts: DataFrame) -> DataFrame:
    """ANSWERS of kind 2: which distinct windows of each chunk a smaller id has."""

    def group(rows: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(h, "<u8").reshape(2, -1) for h in rows.column("hashes").to_pylist()]
        ids = np.concatenate([np.frombuffer(i, "<i8") for i in rows.column("ids").to_pylist()])
        h1, h2 = np.concatenate(hashes, axis=1)
        order = np.lexsort((h2, h1))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0)
        least = np.minimum.reduceat(ids[order], np.flatnonzero(new))
        earlier = np.zeros(len(order), bool)
        earlier[order] = least[np.cumsum(new) - 1] < ids[order]
        cuts = np.cumsum([h.shape[1] for h in hashes])[:-1]
        bits = [np.packbits(x).tobytes() for x in np.split(earlier, cuts)]
        return _filled(ANSWERS, [(c, 2, s, b, None) for c, s, b in zip(rows.column("chunk").to_pylist(), rows.column("shard").to_pylist(), bits)])

    return parts.groupBy("shard").applyInArrow(group, ANSWERS)


def keep_first_windows(docs: DataFrame, width: int = WIDTH, chunk: int = CHUNK, shard: int = SHARD, group: int = GROUP, cells: int = CELLS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each row of `docs` with the words that are left, joined by a blank.

    `shard` (a power of two) cells and about `group` windows are what a task merges or groups at a time."""
    workers_can_import(docs.sparkSession)
    table = chunks(docs.select(F.col("doc_id").cast("long").alias("i"), F.col("text").cast("binary").alias("t")), width, chunk)
    windows = table.agg(F.sum("windows")).first()[0] or 0
    shards, groups = max(1, -(-windows * cells // shard)), max(1, -(-windows // group))
    first = cut(merged(sketches(table, width, shards, shard), shard))

    def candidates(body: pa.Table, answers: pa.Table) -> pa.Table:
        own = _read(body, width)
        found = Candidates(own, answers.to_pylist(), shards, shard, groups)
        rows = [(s, own.number, np.stack([found.h1[a:b], found.h2[a:b]]).tobytes(), found.least[a:b].tobytes()) for s, a, b in _slices(found.group)]
        return _filled(GROUPS, rows)

    def kept(body: pa.Table, answers: pa.Table) -> pa.Table:
        own, known = _read(body, width), answers.to_pylist()
        found = Candidates(own, known, shards, shard, groups)
        earlier = _bits([(a["shard"], a["one"]) for a in known if a["kind"] == 2], found.group)
        return _filled(KEPT, own.cut(found.gone(own, earlier)))

    parts = table.groupBy("chunk").cogroup(first.groupBy("chunk")).applyInArrow(candidates, GROUPS)
    answers = first.unionByName(grouped(parts))
    out = table.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(kept, KEPT)
    return out.withColumn("kept", F.col("kept").cast("string"))


def op12_count_min_windows(docs: DataFrame) -> DataFrame:
    return keep_first_windows(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP12_SQL = rf"""
WITH w AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM (
    SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM documents)),
windows AS (
  SELECT doc_id, i, word, CASE WHEN i + {WIDTH - 1} <= count(*) OVER (PARTITION BY doc_id)
    THEN sha256(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {WIDTH - 1} FOLLOWING)) END AS h
  FROM w),
marked AS (
  SELECT *, h IS NOT NULL AND row_number() OVER (PARTITION BY h ORDER BY doc_id, i) > 1 AS again FROM windows),
covered AS (
  SELECT *, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {WIDTH - 1} PRECEDING AND CURRENT ROW) AS gone FROM marked),
docs AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept
  FROM covered GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN docs USING (doc_id)
"""
