"""Operator 6, near-duplicate detection by ProbMinHash, banding and verification.

A document is its five-word shingles, weighted by their counts (words are lower-cased and split at blanks; a shorter text
is one shingle, an empty text the empty one). Each shingle runs a Poisson process whose rate is its weight, from a random
stream that depends on the shingle alone; every arrival falls in a random slot of the signature, which keeps the shingle
of its earliest arrival. A process stops once it is past the latest slot. Two signatures agree in a slot with the
probability Jaccard similarity of their documents; with all weights 1, with their plain Jaccard similarity.

Equal texts are one text. Bands of both signatures, the weighted one and that of weights 1, put texts in buckets; they are
one signature where no shingle repeats, and their bands share the buckets, so that a text without repeats meets the others
by either. A text is the more popular the more texts its buckets hold; the centre of a group of near copies shares most.

* First every text meets the most popular text of all its buckets, one pair a text; links join classes.
* Then every bucket that still holds two classes compares its most popular text with all others, and a bucket of at most
  SMALL texts all its pairs across classes.
* Texts of larger buckets that still hold two classes are dealt again by more slots of the same signatures (LEVELS), into
  smaller buckets, which are compared the same way. A level's pairs grow with its rows only.
* In buckets of the last level that are still large, every text outside the largest class meets all texts of other classes.
  These are all the pairs that can still link, so one pass is exact and nothing is capped. Their number grows with the
  square of such a bucket, by nature; they are never rows. The bucket is cut into blocks of about BLOCK texts, each pair of
  blocks is one group that is compared by array operations, and only pairs that are likely come out of it.

A pair's texts are never compared twice. Pairs whose signatures agree in fewer than AGREE slots go before any text moves;
the others are verified on whole texts and linked if their probability Jaccard or their plain Jaccard reaches `least`. Only
texts that share a bucket are carried along for it, written once.

The pairs of that last pass all agree in many slots; they are sifted by longer signatures (LONG slots, at least AGREE_LONG equal),
which lose another 3e-5 of the pairs of similarity 0.8.

With 32 bands of 4 slots a pair of either similarity 0.8 shares no bucket with a probability of 5e-8, and agrees in fewer than
84 of 128 slots with one of 3e-5. In a group so dense that its buckets are dealt again, a level misses such a pair with one of
0.0002, 0.001 and 0.05 by itself; links through third texts make up for most of these.

Null text counts as empty, so all such documents form one class. Repeated rows are in one class, as are different texts
under one doc_id. A row without doc_id takes part under a negative number made from its text and has that as class if no
other document is in it. Texts of any length are used whole; a task holds two texts at a time. An empty table gives an
empty one. Other columns, whatever their names, aren't read."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.common import WORKER_CACHES, runs, workers_can_import, written
from paymart.llm.graph import components, merged

WORDS, SLOTS_N, BANDS = 5, 128, 32
AGREE = 84  # slots of 128: a pair of similarity 0.8 agrees in 102 of them on average, with a deviation of 4.5
SMALL = 8  # texts of a bucket that may all meet
BLOCK = 512  # texts of a large bucket that are compared in one group, and as many others
LONG, AGREE_LONG = 512, 373  # slots of the second look at a dense group: 0.8 agrees in 410 on average, with a deviation of 9
LEVELS = ((8, 48), (14, 160), (20, 256))  # slots of a key, keys of a signature
CACHED = 2_000_000  # shingles of texts that a worker keeps while verifying
_GOLDEN, _A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        got = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return got


_WORD_HASHES = WordHashes()
WORKER_CACHES["words"] = _WORD_HASHES.clear


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, hashes, counts): the shingles of all texts, sorted within each; ends[i] is where those of text i end."""
    if len(_WORD_HASHES) > 200_000:
        _WORD_HASHES.clear()
    split = [t.lower().split() for t in texts]
    n = np.array([len(x) for x in split], np.int64)
    h = np.fromiter(map(_WORD_HASHES.__getitem__, chain.from_iterable(split)), np.uint64, int(n.sum()))
    rolled = np.full(len(h), words, np.uint64)
    for i in range(min(words, len(h))):
        rolled[: len(h) - i] = mix(rolled[: len(h) - i] * _GOLDEN + h[i:])
    starts, parts = np.cumsum(n) - n, []
    for i, (at, k) in enumerate(zip(starts.tolist(), n.tolist())):
        if k >= words:
            part = rolled[at : at + k - words + 1]
            part.sort()
        else:  # one shingle of all its words
            part = np.full(1, k, np.uint64)
            for x in h[at : at + k]:
                part = mix(part * _GOLDEN + x)
        parts.append(part)
    every = np.concatenate(parts) if parts else h
    ends = np.cumsum(np.maximum(n - words + 1, 1))
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    new[ends[:-1]] = True
    at = np.flatnonzero(new)
    return np.cumsum(new)[ends - 1] if len(ends) else ends, every[at], np.diff(at, append=len(every))


def shingles(text: str, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the text's shingles and their counts."""
    return shingle_sets([text], words)[1:]


def signatures_of(texts: list[str], slots: int = SLOTS_N) -> np.ndarray:
    """One ProbMinHash a row. Texts share their array operations, one arrival of every element a round; the
    elements of very short ones need hundreds of arrivals each and are worked out text by text."""
    return _signatures(*shingle_sets(texts), slots)


def _signatures(ends: np.ndarray, hashes: np.ndarray, weights: np.ndarray, slots: int = SLOTS_N) -> np.ndarray:
    weights = weights.astype(np.float64)
    n = np.diff(ends, prepend=0)
    kept, long = np.zeros((len(n), slots), np.uint64), n >= slots // 16
    for i in np.flatnonzero(~long).tolist():
        kept[i] = signature(hashes[ends[i] - n[i] : ends[i]], weights[ends[i] - n[i] : ends[i]], slots)
    row = np.repeat(np.arange(len(n)), n)
    going = long[row]
    row, hashes, weights = row[going], hashes[going], weights[going]
    first, flat, at, done = np.full(len(n) * slots, np.inf), kept.ravel(), np.zeros(len(row)), 0
    while len(row):
        done += 1
        draw = mix(hashes + _GOLDEN * np.array(done, np.uint64))
        at = at - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / weights
        place = row * slots + (mix(draw + _A) % np.uint64(slots)).astype(np.int64)
        early = np.flatnonzero(at < first[place])
        when, where = at[early], place[early]
        np.minimum.at(first, where, when)
        won = np.flatnonzero(when == first[where])[::-1]  # arrivals at one time go by element
        flat[where[won]] = hashes[early[won]]
        going = at < first.reshape(-1, slots).max(1)[row]  # early termination
        row, hashes, weights, at = row[going], hashes[going], weights[going], at[going]
    return kept


def signature(hashes: np.ndarray, weights: np.ndarray, slots: int = SLOTS_N) -> np.ndarray:
    """ProbMinHash of weighted elements: in each slot, the element of the earliest arrival."""
    first, kept = np.full(slots, np.inf), np.zeros(slots, np.uint64)
    at, done = np.zeros(len(hashes)), 0
    with np.errstate(over="ignore"):
        while len(hashes):
            n = max(1, -(-4 * slots // len(hashes))) if not done else max(1, slots // len(hashes))
            draw = mix(hashes[:, None] + _GOLDEN * np.arange(done + 1, done + n + 1, dtype=np.uint64))
            gaps = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / weights[:, None]
            gaps[:, 0] += at
            arrive = np.cumsum(gaps, 1)
            at, done = arrive[:, -1], done + n
            slot = (mix(draw + _A) % np.uint64(slots)).astype(np.int64)
            early = arrive < first[slot]
            row, _ = np.nonzero(early)
            when, where = arrive[early], slot[early]
            # the earliest is written last; arrivals at one time go by element
            order = np.lexsort((hashes[row], when))[::-1]
            first[where[order]], kept[where[order]] = when[order], hashes[row[order]]
            going = at < first.max()  # early termination
            hashes, weights, at = hashes[going], weights[going], at[going]
    return kept


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """(probability Jaccard, plain Jaccard) of two weighted sets."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    union = len(a[0]) + len(b[0]) - len(both)
    if not len(both):
        return 0.0, 0.0
    x, y = a[1][i].astype(float), b[1][j].astype(float)
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    only_a, only_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    above = x.sum() - np.concatenate([[0.0], np.cumsum(x)[:-1]]) + only_a  # x of this ratio and higher ones
    below = np.concatenate([[0.0], np.cumsum(y)[:-1]]) + only_b
    return float((x / (above + ratio * below)).sum()), len(both) / union


def band_keys(sigs: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """The bucket of each band of each signature."""
    rows = sigs.reshape(len(sigs), bands, sigs.shape[1] // bands)
    out = np.tile(np.arange(bands, dtype=np.uint64), (len(sigs), 1))
    for k in range(rows.shape[2]):
        out = mix(out * _GOLDEN + rows[:, :, k])
    return out.view(np.int64)


def both_signatures(texts: list[str], slots: int = SLOTS_N) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of all texts: weighted by the counts, and of weights 1."""
    ends, hashes, weights = shingle_sets(texts)
    n = np.diff(ends, prepend=0)
    weighted = _signatures(ends, hashes, weights, slots)
    row = np.repeat(np.arange(len(n)), n)
    often = np.unique(row[weights > 1])  # of the others, both signatures are one
    its = hashes[np.isin(row, often)]
    plain = weighted.copy()
    plain[often] = _signatures(np.cumsum(n[often]), its, np.ones(len(its)), slots)
    return weighted, plain


def union_of(keys: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ends, keys): those of text i up to ends[i]; first all of the weighted signature, then those that the other has besides."""
    held = np.concatenate([np.ones(keys.shape, bool), plain != keys], 1)
    return np.cumsum(held.sum(1)), np.concatenate([keys, plain], 1)[held]


def buckets_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ends, keys): the buckets of all texts by the bands of both signatures."""
    return union_of(*map(band_keys, both_signatures(texts)))


def level_keys(sketch: np.ndarray, slots: int, keys: int) -> np.ndarray:
    """The keys of each sketch: each over `slots` slots, the same for all texts."""
    chosen = np.argsort(np.random.default_rng(slots).random((keys, sketch.shape[1])), 1)[:, :slots]
    out = np.tile(np.arange(keys, dtype=np.uint64) + np.uint64(slots << 32), (len(sketch), 1))
    for k in range(slots):
        out = mix(out * _GOLDEN + sketch[:, chosen[:, k]])
    return out.view(np.int64)


def sketches_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """(text, signature, slot): the lowest byte of every slot."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), 2, -1)


def lists(ends: np.ndarray, keys: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), keys)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc, text_key, bands, sketch) of every row."""
    workers_can_import(docs.sparkSession)
    key = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rows = docs.select("doc_id", "text").withColumn("text_key", key).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.select(doc_name("doc_id", "text_key").alias("doc"), "text_key", F.col("text").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "t", 1 << 19, "words"):
            two = both_signatures(batch.column("t").to_pylist())
            sketch = np.stack(two, 1).astype(np.uint8)  # the lowest byte
            columns = [batch.column("doc"), batch.column("text_key"), lists(*union_of(*map(band_keys, two)))]
            columns.append(pa.array([x.tobytes() for x in sketch], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["doc", "text_key", "bands", "sketch"])

    return rows.mapInArrow(run, "doc long, text_key string, bands array<long>, sketch binary")


def doc_name(doc_id: str, text_key: str):
    return F.coalesce(F.col(doc_id).cast("long"), -F.abs(F.xxhash64(text_key) % (1 << 62)) - 1)


def deal_again(sketches: DataFrame, slots: int, keys: int) -> DataFrame:
    """(bucket, rep, pop, c): the keys of a level for every (rep, pop, c, sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "sketch", 1 << 17, "words"):
            two = sketches_of(batch.column("sketch"))
            found = lists(*union_of(level_keys(two[:, 0], slots, keys), level_keys(two[:, 1], slots, keys)))
            yield pa.RecordBatch.from_arrays([*map(batch.column, ("rep", "pop", "c")), found], ["rep", "pop", "c", "buckets"])

    dealt = sketches.select("rep", "pop", "c", "sketch").mapInArrow(run, "rep long, pop long, c long, buckets array<long>")
    return dealt.select(F.explode("buckets").alias("bucket"), "rep", "pop", "c")


def long_sketches(texts: DataFrame, reps: DataFrame) -> DataFrame:
    """(rep, sketch) of the texts (doc, text) in `reps`, of LONG slots, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "text", 1 << 17, "words"):
            sketch = np.stack(both_signatures(batch.column("text").to_pylist(), LONG), 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array([x.tobytes() for x in sketch], pa.binary())], ["rep", "sketch"])

    return written(texts.join(reps.select(F.col("rep").alias("doc")), "doc").mapInArrow(run, "rep long, sketch binary"), few=True)


def likely(pairs: DataFrame, sketches: DataFrame | None, least: float, agree: int = AGREE) -> DataFrame:
    """Those (u, v) of `pairs` with a signature that agrees in enough slots. `pairs` are rows (u, v), or blocks of texts with
    their sketches as `outside_largest_class` makes them; then `sketches` is None."""
    enough = agree if least >= 0.8 else 0
    if sketches is None:
        return likely_in_blocks(pairs, enough)
    rows = pairs.join(sketches.withColumnsRenamed({"rep": "v", "sketch": "b"}), "v").join(sketches.withColumnsRenamed({"rep": "u", "sketch": "a"}), "u")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            agree = (sketches_of(batch.column("a")) == sketches_of(batch.column("b"))).sum(2).max(1)
            yield batch.select(["u", "v"]).filter(pa.array(agree >= enough, pa.bool_()))

    return rows.select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def likely_in_blocks(blocks: DataFrame, enough: int) -> DataFrame:
    """(u, v): in each (bucket, i, j) the hubs with the other texts of other classes; two hubs meet once."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        rep, c = (group.column(name).to_numpy() for name in ("rep", "c"))
        also, asks = (group.column(name).to_numpy(zero_copy_only=False) for name in ("is_hub", "asks"))
        sketch = sketches_of(group.column("sketch"))
        met, pairs = np.flatnonzero(~asks), []
        for k in np.flatnonzero(asks).tolist():
            others = met[(c[met] != c[k]) & (~also[met] | (rep[met] < rep[k]))]
            near = others[np.count_nonzero(sketch[others] == sketch[k], axis=2).max(1, initial=0) >= enough]
            pairs.append(np.stack([np.minimum(rep[near], rep[k]), np.maximum(rep[near], rep[k])]))
        u, v = np.concatenate(pairs, 1) if pairs else np.zeros((2, 0), np.int64)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return blocks.groupBy("bucket", "i", "j").applyInArrow(run, "u long, v long").distinct()


def candidate_texts(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(doc, text) of the documents in `reps`, one row of each document and text, written once."""
    key = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("k"))
    texts = texts.select(doc_name("doc_id", "k").alias("doc"), "text", "k").join(reps.select(F.col("rep").alias("doc")), "doc")
    kept = written(texts)
    often = written(kept.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc"), few=True)
    if not often.isEmpty():
        kept = kept.join(often, "doc", "left_anti").unionByName(kept.join(often, "doc").dropDuplicates(["doc", "k"]))
    return kept.select("doc", "text")


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Those (u, v) of `pairs` whose texts are similar enough."""
    rows = pairs.join(texts.withColumnsRenamed({"doc": "v", "text": "b"}), "v").join(texts.withColumnsRenamed({"doc": "u", "text": "a"}), "u")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple] = {}
        size = 0

        def of(text: str) -> tuple:
            nonlocal size
            if (got := held.get(text)) is None:
                if size > CACHED:
                    held.clear()
                    size = 0
                got = held[text] = shingles(text)
                size += len(got[0])
            return got

        for batch in runs(batches, "b", 1 << 22, "words"):
            keep = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                x, y = of(a), of(b)
                keep.append(max(similarity(x, y)) >= least)
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return rows.select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def in_classes(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """`rows` (rep, ...) with the class c of each rep."""
    return rows.join(classes, rows["rep"] == classes["node"], "left").select(*rows.columns, F.coalesce("component", "rep").alias("c"))


def still_two(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """Of (bucket, rep, pop): the texts (rep, pop) of buckets that hold two classes by now.

    Only the rows of buckets that came to one class are looked up; a text is left out if they are all its rows. A dense group's
    buckets mostly stay as they are, and make no rows here."""
    named = written(in_classes(buckets, classes), few=True)
    one = written(named.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo = hi").select("bucket"), few=True)
    if one.isEmpty():
        return named.select("rep", "pop").distinct()
    gone = named.join(one, "bucket").groupBy("rep").agg(F.count(F.lit(1)).alias("gone"))
    texts = named.groupBy("rep", "pop").agg(F.count(F.lit(1)).alias("n"))
    return texts.join(gone, "rep", "left").where("gone is null or gone < n").select("rep", "pop")


def bucket_pairs(named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of (bucket, rep, pop, c): (pairs, rows of large buckets) where a bucket holds two classes. Its most popular text meets all
    others, those of a small one all."""
    top = F.max(F.struct("pop", (-F.col("rep")).alias("by"), "c")).alias("top")
    live = named.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi"), top).where("lo <> hi")
    live = written(live.select("bucket", "n", (-F.col("top.by")).alias("hub"), F.col("top.c").alias("hub_c")), few=True)
    named = written(named.join(live, "bucket"), few=True)
    large, small = named.where(F.col("n") > SMALL), named.where(F.col("n") <= SMALL).select("bucket", "rep", "c")
    # both sides come from one table: names tell them apart
    others = small.select(F.col("bucket").alias("at"), F.col("rep").alias("other"), F.col("c").alias("other_c"))
    every = small.join(others, (F.col("bucket") == F.col("at")) & (F.col("c") != F.col("other_c")) & (F.col("rep") < F.col("other")))
    stars = large.where("c <> hub_c").select(F.least("rep", "hub").alias("u"), F.greatest("rep", "hub").alias("v"))
    pairs = every.select(F.col("rep").alias("u"), F.col("other").alias("v")).unionByName(stars)
    return pairs.distinct(), large.select("bucket", "rep", "pop")


def outside_largest_class(buckets: DataFrame, classes: DataFrame, sketches: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(bucket, i, j, rep, c, is_hub, asks, sketch): blocks in which the texts outside a bucket's largest class, its hubs, ask all its
    texts. Each hub is in a block i and there for every j, each text in a block j and there for every i."""
    named = written(in_classes(buckets, classes).select("bucket", "rep", "c"), few=True)
    sizes = named.groupBy("bucket", "c").agg(F.count(F.lit(1)).alias("of_c"))
    largest = sizes.groupBy("bucket").agg(F.max(F.struct("of_c", (-F.col("c")).alias("by"))).alias("top"), F.count(F.lit(1)).alias("classes"), F.sum("of_c").alias("n"))
    blocks_of = lambda n: F.ceil(n / BLOCK).cast("int")
    largest = largest.where("classes > 1").select("bucket", (-F.col("top.by")).alias("most"), blocks_of(F.col("n") - F.col("top.of_c")).alias("is"), blocks_of(F.col("n")).alias("js"))
    named = written(named.join(largest, "bucket").withColumn("is_hub", F.col("c") != F.col("most")).drop("most"), few=True)
    named = named.join(sketches(named.select("rep").distinct()), "rep")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    rest = ["rep", "c", "is_hub", "sketch"]
    hubs = named.where("is_hub").select("bucket", own("is").alias("i"), every("js").alias("j"), *rest, F.lit(True).alias("asks"))
    return hubs.unionByName(named.select("bucket", every("is").alias("i"), own("js").alias("j"), *rest, F.lit(False).alias("asks")))


def most_popular(buckets: DataFrame) -> DataFrame:
    """(u, v): each text and the most popular other one that leads a bucket of its."""
    top = F.max(F.struct("pop", (-F.col("rep")).alias("by"))).alias("top")
    pairs = buckets.select("bucket", "rep").join(buckets.groupBy("bucket").agg(top), "bucket").where("rep <> -top.by")
    pairs = pairs.groupBy("rep").agg((-F.max("top")["by"]).alias("hub"))
    return pairs.select(F.least("rep", "hub").alias("u"), F.greatest("rep", "hub").alias("v")).distinct()


def near_duplicates(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc, text_key, class_id) of every row; class_id is the smallest doc of its class."""
    workers_can_import(docs.sparkSession)
    rows = written(signatures(docs))
    texts = written(rows.groupBy("text_key").agg(F.min("doc").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
    dealt = texts.select("rep", F.explode("bands").alias("bucket"))
    shared = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = written(dealt.join(shared, "bucket"))
    popular = buckets.groupBy("rep").agg(F.sum("n").alias("pop"))
    buckets = written(buckets.join(popular, "rep").select("bucket", "rep", "pop"))
    reps = written(popular)
    sketches = written(texts.join(reps.select("rep"), "rep").select("rep", "sketch"))
    held = candidate_texts(docs, reps)
    # texts under one doc_id, and the texts of the exact copies of a document, meet through their documents
    same = rows.join(texts.select("text_key", "rep"), "text_key").select(F.col("doc").alias("u"), F.col("rep").alias("v"))
    several = rows.groupBy("doc").agg(F.min("text_key").alias("lo"), F.max("text_key").alias("hi")).where("lo <> hi").select(F.col("doc").alias("u"))
    classes = written(components(same.join(several, "u")), few=True)
    seen = None

    def unseen(pairs: DataFrame) -> DataFrame:
        return written(pairs.join(seen, ["u", "v"], "left_anti") if seen is not None else pairs, few=True)

    def link(alike: DataFrame) -> None:
        nonlocal classes
        links = written(verified(alike, held, least), few=True)
        if not links.isEmpty():
            classes = merged(classes, links)

    def compare(pairs: DataFrame) -> None:
        """Links those pairs that are alike and have not met before."""
        nonlocal seen
        pairs = unseen(pairs)
        if not pairs.isEmpty():
            seen = pairs if seen is None else seen.unionByName(pairs)
            link(likely(pairs, sketches, least))

    compare(most_popular(buckets))
    pairs, large = bucket_pairs(written(in_classes(buckets, classes), few=True))
    compare(pairs)
    for slots, keys in LEVELS:
        again = written(still_two(large, classes), few=True)
        if again.isEmpty():
            break
        pairs, large = bucket_pairs(written(deal_again(in_classes(again, classes).join(sketches, "rep"), slots, keys), few=True))
        compare(pairs)
    # here all pairs agree in enough of the 128 slots
    blocks = outside_largest_class(large, classes, lambda reps: long_sketches(held, reps))
    alike = unseen(likely(blocks, None, least, AGREE_LONG))
    if not alike.isEmpty():
        link(alike)
    found = rows.select("doc", "text_key").join(texts.select("text_key", "rep"), "text_key")
    found = found.join(classes, found["rep"] == classes["node"], "left")
    return found.select("doc", "text_key", F.coalesce("component", "rep").alias("class_id"))


def op6_prob_minhash(docs: DataFrame, least: float = 0.8) -> DataFrame:
    found = near_duplicates(docs, least)
    return found.select(F.col("doc").alias("doc_id"), "class_id", (F.col("doc") == F.col("class_id")).alias("kept"))


def keep_representatives(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """One row of each class: that of its smallest document."""
    found = written(near_duplicates(docs, least).where("doc = class_id").groupBy("doc", "text_key").agg(F.count(F.lit(1)).alias("n")))
    one = found.groupBy("doc").agg(F.min("text_key").alias("text_key"), F.sum("n").alias("n"))
    key = F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary"))
    named = docs.withColumn("__key", key).withColumn("__doc", doc_name("doc_id", "__key"))
    left = named.join(one.select(F.col("doc").alias("__doc"), F.col("text_key").alias("__key"), F.col("n").alias("__n")), ["__doc", "__key"])
    kept = left.where("__n = 1").unionByName(left.where("__n > 1").dropDuplicates(["__doc", "__key"]))
    return kept.select(*docs.columns)
