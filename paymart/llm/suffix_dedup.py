"""Operator 2, suffix-array deduplication: interval trees over the suffixes that can repeat.

A byte goes if a string of `length` bytes over it also starts anywhere else, in any document. All suffixes of a corpus
can't be sorted; only those at anchors are. The anchor of a window of `length` bytes is the leftmost of its GRAM-byte
strings with the smallest hash, so equal windows have equal anchors at equal places in them, and only windows whose anchor
occurs twice can repeat. An anchor's occurrence stands for the run of windows that it is the anchor of; the run's bytes
are its context, cut at the anchor into a left and a right part.

Occurrences with one and the same context repeat all its windows. Of the rest, one of each context is compared with the
others of its anchor: sorted by their right parts, they are a suffix array, whose longest common prefixes with the one
before make it an enhanced one. A stack scan turns those into the tree of common-prefix intervals. Within an interval of
prefix r, the left parts tell how far its suffixes extend to the left: sorted by them, neighbours that share l bytes with
l + r >= length are one repeat, and where the left extension is diverse the group is maximal. `repeats` gives these groups
with all occurrences; the spans to remove are the union of their occurrences.

An anchor with more than GROUP contexts, such as the edge of a passage that very many documents share, is split by its
contexts' hashes; windows that meet only across the parts are found by their hashes, one row a part and window at most.

Null text counts as empty; texts shorter than `length` lose nothing. Repeated rows remove each other's whole text, as does
every text of at least `length` bytes with an equal one. Rows are told apart by doc_id and text, so a repeated doc_id with
another text is another document. A null doc_id is an id like others. Texts of any length are scanned whole, in pieces of
CHUNK bytes. An empty table gives an empty one. Other columns, whatever their names, are kept by `remove_repeats` and
otherwise not read."""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paymart.llm.common import WORKER_CACHES, runs, shared_folder, workers_can_import

LENGTH, GRAM, GROUP, CHUNK = 200, 32, 2048, 1 << 20
_PLACE = np.uint64((1 << 24) - 1)
_BASE = 0x5851F42D4C957F2D
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: dict[str, np.ndarray] = {}
WORKER_CACHES["powers"] = _POWERS.clear

OCCURRENCES = "a long, c long, k long, at long, left short, windows short"
CONTEXTS = "a long, part int, split boolean, c long, r binary, l binary"
COVERED = "a long, c long, back short, ahead short, window long, offset short"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, CHUNK + 4096)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


def _prefix(data: np.ndarray) -> np.ndarray:
    """Sums of byte codes times powers; the hash of data[s:e] is (sums[e] - sums[s]) * down[s]."""
    up, _ = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    return sums


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def scan(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, first window, left, windows, anchor hash, context hash) of each anchor of the texts data[starts:ends].

    `data` holds less than 2**24 bytes; `first window` counts from the text's start."""
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    if len(data) < length:
        return none
    _, down = _powers(len(data) + 1)
    sums = _prefix(data)
    grams = _mix((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1])
    ranked = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_sliding_min(ranked, length - gram + 1) & _PLACE).astype(np.int64)
    text = np.repeat(np.arange(len(starts)), ends - starts)
    own = np.flatnonzero(ends[text[: len(anchor)]] - np.arange(len(anchor)) >= length)  # windows within one text
    if not len(own):
        return none
    anchor = anchor[own]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(own) != 1)]))
    windows = np.diff(np.append(first, len(own)))
    place, at = anchor[first], own[first]
    left = place - at
    ends_at = at + windows + length - 1
    context = _mix((sums[ends_at] - sums[at]) * down[at] + left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return text[at], at - starts[text[at]], left, windows, grams[place], context


def anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """OCCURRENCES of all anchors of (k, t)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "t", CHUNK, "powers"):
            raw = [t.encode("utf-8", "surrogatepass") for t in batch.column("t").to_pylist()]
            keys = batch.column("k").to_numpy()
            if sum(map(len, raw)) < 4 * CHUNK:
                pieces = [(raw, keys, 0)]
            else:  # one very long text among them: overlapping pieces, each window in one of them
                pieces = []
                for text, key in zip(raw, keys):
                    for k in range(0, max(len(text), 1), CHUNK):
                        pieces.append(([text[k : k + CHUNK + length - 1]], np.array([key]), k))
            for texts, own, before in pieces:
                ends = np.cumsum([len(t) for t in texts])
                starts = ends - [len(t) for t in texts]
                text, at, left, windows, a, c = scan(np.frombuffer(b"".join(texts), np.uint8), starts, ends, length, gram)
                cols = [a.view(np.int64), c.view(np.int64), own[text], at + before, left.astype(np.int16), windows.astype(np.int16)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], [f.split()[0] for f in OCCURRENCES.split(", ")])

    return docs.mapInArrow(run, OCCURRENCES)


def contexts(rows: DataFrame, length: int) -> DataFrame:
    """CONTEXTS of the listed occurrences of (t, places); the left part is reversed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "t", CHUNK):
            out = []
            for text, places in zip(batch.column("t").to_pylist(), batch.column("places").to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                for p in places:
                    at, mid = p["at"], p["at"] + p["left"]
                    out.append((p["a"], p["part"], p["split"], p["c"], raw[mid : at + p["windows"] + length - 1], raw[at:mid][::-1]))
            kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()]
            for k in range(0, len(out), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out[k : k + 10_000]), kinds)], [f.split()[0] for f in CONTEXTS.split(", ")])

    return rows.mapInArrow(run, CONTEXTS)


# ---- enhanced suffix array of one batch of groups


def _matrix(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of bytes + 1 (UTF-8 has no byte above 253), 0 beyond the end; their lengths."""
    sizes = np.array([len(p) for p in parts], np.int64)
    out = np.zeros((len(parts), width), np.uint8)
    flat = np.frombuffer(b"".join(parts), np.uint8) + np.uint8(1)
    out[np.repeat(np.arange(len(parts)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out, sizes


def _common(rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of rows i and j."""
    out = np.zeros(len(i), np.int64)
    for k in range(0, len(i), 20_000):
        a, b = rows[i[k : k + 20_000]], rows[j[k : k + 20_000]]
        differ = (a != b) | (a == 0)
        out[k : k + 20_000] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def interval_tree(lcp: list[int], least: int) -> list[tuple[int, int, int]]:
    """(first, last, prefix) of the intervals of common prefix `least` or more, by a stack scan.

    lcp[i] is that of suffixes i - 1 and i; a group's first has 0."""
    out, stack = [], [(0, 0)]  # (prefix, first suffix)
    for i, value in enumerate([*lcp, 0]):
        first = i - 1
        while stack[-1][0] > value:
            prefix, first = stack.pop()
            if prefix >= least:
                out.append((first, i - 1, prefix))
        if value > stack[-1][0]:
            stack.append((value, first))
    return out


def groups_of(group: np.ndarray, right: list[bytes], left: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Left-sorted neighbours of all intervals: (interval, prefix r, suffix x, suffix y, common left part l).

    `group` doesn't fall; within a group the right parts are sorted."""
    n = len(group)
    R, _ = _matrix(right, max(map(len, right)))
    L, _ = _matrix(left, max(max(map(len, left)), 1))
    lcp = np.zeros(n, np.int64)
    same = np.flatnonzero(np.diff(group) == 0) + 1
    lcp[same] = _common(R, same - 1, same)
    tree = interval_tree(lcp.tolist(), length - L.shape[1])
    if not tree:
        return (np.zeros(0, np.int64),) * 5
    first, last, prefix = np.array(tree, np.int64).T
    size = last - first + 1
    interval = np.repeat(np.arange(len(tree)), size)
    member = np.arange(len(interval)) - np.repeat(np.cumsum(size) - size, size) + first[interval]
    rank = np.empty(n, np.int64)
    rank[np.argsort(np.ascontiguousarray(L).view(f"S{L.shape[1]}").ravel(), kind="stable")] = np.arange(n)
    order = np.lexsort((rank[member], interval))
    interval, member = interval[order], member[order]
    pair = np.flatnonzero(np.diff(interval) == 0)
    x, y, interval = member[pair], member[pair + 1], interval[pair]
    return interval, prefix[interval], x, y, _common(L, x, y)


def reach(group: np.ndarray, right: list[bytes], left: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """How far the repeats through each suffix's anchor go back and ahead; 0 without one."""
    back, ahead = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64)
    _, r, x, y, l = groups_of(group, right, left, length)  # noqa: E741
    long = l + r >= length
    for suffix in (x[long], y[long]):
        np.maximum.at(back, suffix, l[long])
        np.maximum.at(ahead, suffix, r[long])
    return back, ahead


def maximal_groups(group: np.ndarray, right: list[bytes], left: list[bytes], length: int) -> list[tuple[int, int, list[int]]]:
    """(left part l, prefix r, suffixes) of each maximal repeat of `length` or more within the contexts.

    In an interval, the suffixes in left order with their common left parts are an enhanced suffix array again; its
    intervals are left-diverse by construction. A group that lies in one child of the interval has a longer prefix and is
    left to that child."""
    interval, r, x, y, l = groups_of(group, right, left, length)  # noqa: E741
    R, _ = _matrix(right, max(map(len, right), default=1))
    out = []
    for k in np.split(np.arange(len(interval)), np.flatnonzero(np.diff(interval)) + 1) if len(interval) else []:
        members, prefix = [int(x[k[0]]), *y[k].tolist()], int(r[k[0]])
        for a, b, shared in interval_tree([0, *(l[k] + 1).tolist()], length - prefix + 1):
            inside = sorted(members[a : b + 1])
            if _common(R, np.array([inside[0]]), np.array([inside[-1]]))[0] == prefix:
                out.append((shared - 1, prefix, inside))
    return out


def _whole_groups(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[dict[str, list]]:
    """Columns of `rows` rows or more, never parting rows of one (a, part); input is sorted by them."""
    held: dict[str, list] | None = None
    for batch in batches:
        got = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        held = {k: held[k] + v for k, v in got.items()} if held else got
        keys = list(zip(held["a"], held["part"]))
        if len(keys) >= rows:
            cut = len(keys) - 1
            while cut and keys[cut - 1] == keys[-1]:
                cut -= 1
            if cut:
                yield {k: v[:cut] for k, v in held.items()}
                held = {k: v[cut:] for k, v in held.items()}
    if held and held["a"]:
        yield held


def _group_numbers(rows: dict[str, list]) -> np.ndarray:
    a, part = np.array(rows["a"], np.int64), np.array(rows["part"], np.int64)
    return np.cumsum(np.concatenate([[0], (np.diff(a) != 0) | (np.diff(part) != 0)]).astype(np.int64))


def compare(sorted_contexts: DataFrame, length: int) -> DataFrame:
    """COVERED: how far each context's repeats go, and of split anchors each part's windows: with the context where it
    may still gain by a window elsewhere, else once a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.int64(), pa.int16()]
        names = [f.split()[0] for f in COVERED.split(", ")]
        for rows in _whole_groups(batches, 20_000):
            group = _group_numbers(rows)
            back, ahead = reach(group, rows["r"], rows["l"], length)
            a, c = np.array(rows["a"], np.int64), np.array(rows["c"], np.int64)
            some = np.flatnonzero(ahead)
            nulls = lambda n, kind: pa.nulls(n, kind)
            if len(some):
                cols = [a[some], c[some], back[some].astype(np.int16), ahead[some].astype(np.int16)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols), nulls(len(some), pa.int64()), nulls(len(some), pa.int16())], names)
            seen: dict[int, set] = {}
            out = []
            for i in np.flatnonzero(np.array(rows["split"])).tolist():
                left, right = rows["l"][i][::-1], rows["r"][i]
                context = np.frombuffer(left + right, np.uint8)
                sums, (_, down) = _prefix(context), _powers(len(context) + 1)
                begin = np.arange(len(context) - length + 1)
                offset = len(left) - begin
                hashes = _mix((sums[length:] - sums[:-length]) * down[: len(begin)] + offset.astype(np.uint64))
                own = seen.setdefault(int(group[i]), set())
                for h, o in zip(hashes.view(np.int64).tolist(), offset.tolist()):
                    if h not in own:
                        own.add(h)
                        open_end = o > back[i] or length - o > ahead[i]
                        out.append((int(a[i]), int(c[i]) if open_end else None, None, None, h, o))
                if len(out) >= 10_000 or i == len(group) - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), kinds)], names) if out else pa.RecordBatch.from_arrays([pa.nulls(0, k) for k in kinds], names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), kinds)], names)

    return sorted_contexts.mapInArrow(run, COVERED)


# ---- the jobs


def _written(df: DataFrame, what: str) -> DataFrame:
    """A table in the shared folder, compressed; what was shuffled for it can go."""
    spark = df.sparkSession
    folder = shared_folder(spark, what)
    df.write.parquet(folder, compression="zstd")
    return spark.read.schema(df.schema).parquet(folder)


def _free(spark: SparkSession) -> None:
    """Spark drops the shuffle files of finished jobs when the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def keyed(docs: DataFrame) -> DataFrame:
    """(k, t): what the scan reads."""
    t = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.xxhash64("doc_id", t).alias("k"), t.alias("t"))


def _repeated_occurrences(rows: DataFrame, length: int, gram: int) -> DataFrame:
    found = anchors(rows, length, gram)
    # written, so that the join below deals out both its sides itself and Spark can split the rows of a frequent anchor
    twice = _written(anchors(rows, length, gram).groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a"), "twice")
    return _written(found.join(twice, "a"), "anchors")


def _distinct_contexts(occurrences: DataFrame, group: int) -> DataFrame:
    """One occurrence of each context, how often it occurs, and the part of its anchor that it falls in."""
    each = occurrences.groupBy("a", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "at", "left", "windows")).alias("o"))
    each = _written(each.select("a", "c", "n", "o.*"), "contexts")
    kinds = each.groupBy("a").agg(F.count(F.lit(1)).alias("kinds"))
    parts = F.ceil(F.col("kinds") / group)
    return each.join(kinds, "a").withColumn("part", F.pmod("c", parts).cast("int")).withColumn("split", parts > 1)


def _sorted_contexts(rows: DataFrame, each: DataFrame, length: int) -> DataFrame:
    wanted = each.where("kinds > 1").groupBy("k").agg(F.collect_list(F.struct("a", "part", "split", "c", "at", "left", "windows")).alias("places"))
    found = contexts(rows.join(wanted, "k").select("t", "places"), length)
    return found.repartition("a", "part").sortWithinPartitions("a", "part", "r", "l")


def repeat_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """(k, spans): byte spans [start, end) through each document's repeats, not yet joined; only documents with any."""
    spark = docs.sparkSession
    workers_can_import(spark)
    rows = keyed(docs)
    occurrences = _repeated_occurrences(rows, length, gram)
    _free(spark)
    each = _distinct_contexts(occurrences, group)
    _free(spark)
    found = _written(compare(_sorted_contexts(rows, each, length), length), "covered")
    _free(spark)
    once = each.where("n = 1").select("a", "c")
    windows = found.where("window is not null")
    met = windows.groupBy("a", "window").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("a", "window")
    across = windows.where("c is not null").join(met, ["a", "window"]).select("a", "c", F.col("offset").alias("back"), (F.lit(length) - F.col("offset")).cast("short").alias("ahead"))
    partly = found.where("window is null").select("a", "c", "back", "ahead").unionByName(across)
    partly = partly.groupBy("a", "c").agg(F.max("back").alias("back"), F.max("ahead").alias("ahead")).join(once, ["a", "c"])
    whole = each.where("n > 1").select("a", "c", F.col("left").alias("back"), (F.col("windows") + F.lit(length - 1) - F.col("left")).cast("short").alias("ahead"))
    covered = occurrences.join(whole.unionByName(partly), ["a", "c"])
    middle = F.col("at") + F.col("left")
    spans = covered.select("k", (middle - F.col("back")).alias("start"), (middle + F.col("ahead")).alias("end")).distinct()
    return spans.groupBy("k").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(group_id, n_bytes, occurrences): maximal repeats of `length` bytes or more within an anchor's context, with all
    their occurrences (k, start). Longer repeats show as a chain of overlapping groups. Anchors aren't split here: this
    report is for inspection, `repeat_spans` is the scalable path."""
    workers_can_import(docs.sparkSession)
    rows = keyed(docs)
    occurrences = _repeated_occurrences(rows, length, gram)
    each = _distinct_contexts(occurrences, 1 << 31)
    # a context that stands alone can still occur often: it is compared with itself, as it were
    wanted = each.where("kinds > 1 or n > 1").groupBy("k").agg(F.collect_list(F.struct("a", "part", "split", "c", "at", "left", "windows")).alias("places"))
    ordered = contexts(rows.join(wanted, "k").select("t", "places"), length).join(each.select("a", "c", "n"), ["a", "c"])
    ordered = ordered.repartition("a", "part").sortWithinPartitions("a", "part", "r", "l")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in _whole_groups(batches, 20_000):
            often = [i for i, n in enumerate(got["n"]) for _ in range(min(n, 2))]
            two = {k: [v[i] for i in often] for k, v in got.items()}
            out = []
            for back, ahead, inside in maximal_groups(_group_numbers(two), two["r"], two["l"], length):
                cs = sorted({two["c"][i] for i in inside})
                name = hashlib.sha1(repr((two["a"][inside[0]], back, ahead, cs)).encode()).hexdigest()
                out += [(name, back + ahead, two["a"][inside[0]], c, back) for c in cs]
            if out:
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int16()]
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), kinds)], ["group_id", "n_bytes", "a", "c", "back"])

    groups = ordered.select("a", "part", "c", "n", "r", "l").mapInArrow(run, "group_id string, n_bytes long, a long, c long, back short")
    placed = groups.join(occurrences, ["a", "c"]).select("group_id", "n_bytes", "k", (F.col("at") + F.col("left") - F.col("back")).alias("start"))
    return placed.distinct().groupBy("group_id", "n_bytes").agg(F.sort_array(F.collect_list(F.struct("k", "start"))).alias("occurrences"))


def joined_spans(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of the spans, in order."""
    out: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans or []):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def _kept(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def with_spans(docs: DataFrame, columns: list[str], length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """The named columns of every row, and spans: the maximal runs of bytes to remove."""
    spans = repeat_spans(docs, length, group=group).withColumnsRenamed({"k": "__k", "spans": "__spans"})
    t = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(*columns, F.xxhash64("doc_id", t).alias("__k")).join(spans, "__k", "left").drop("__k")


def op2_suffix_dedup(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "text", 1 << 22):
            out = []
            for doc_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "__spans"))):
                raw, spans = (text or "").encode("utf-8", "surrogatepass"), joined_spans(spans)
                kept = _kept(raw, spans)
                out.append((doc_id, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), kinds)], [f.split()[0] for f in schema.split(", ")])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_spans(docs, ["doc_id", "text"], length, group).mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`docs` without the repeated bytes. A character that loses some of its bytes goes with them; n_chars, where there is
    such a column, is counted anew."""
    joined = with_spans(docs, docs.columns, length)
    schema, names = docs.schema, docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "text", 1 << 22):
            texts = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("__spans").to_pylist()):
                runs_ = joined_spans(spans)
                texts.append(_kept(text.encode("utf-8", "surrogatepass"), runs_).decode("utf-8", "ignore") if runs_ else text)
            cols = {n: batch.column(n) for n in names}
            cols["text"] = pa.array(texts, pa.string())
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([None if t is None else len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(list(cols.values()), names)

    return joined.select(*names, "__spans").mapInArrow(run, schema)
