"""Operator 8, document fingerprints by consistent weighted sampling, in DataFrame functions only.

A document is its words (ASCII blanks part them, letters are lower-cased) weighted by their counts. For each of SAMPLES
samples a word of weight w draws r and c from Gamma(2, 1) and b from U(0, 1), all from hashes of the word and the sample's
number; with t = floor(ln w / r + b), the word of the smallest ln c - r (t - b) - r is sampled, and the sample is (word, t).
Two documents have equal samples with a probability equal to their generalised Jaccard similarity, sum of the smaller over
sum of the larger counts. The minimum is a bigint: the value to 2^-24 in the upper half, 32 bits of the word's hash, changed by
t, in the lower half. The last 16 of them are that sample's 4 hexadecimal digits in the fingerprint, so that different samples
look equal once in 65,536 times.

The whole text moves once, by doc_id, and is read from that exchange wherever it is needed; the words are counted and the
minima taken within the same partitioning. What a document takes from the next one is cut out before it moves. The order
of the ids comes from a range partitioning that is kept in the shared folder before it is used.

Null text counts as empty; the empty text's one word is the empty string. Equal texts have equal fingerprints. Rows that
repeat a doc_id with its text are worked out once and returned as often as they come. A null doc_id stands before all
others. If several texts share the next doc_id, the smallest is taken. A single document is its own next one. Texts of any
length are used whole. An empty table gives an empty one. Other columns, whatever their names, aren't read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paymart.llm.common import cut

SAMPLES, REACH = 64, 32.0
LOWEST = -(1 << 63)
PARTITION_CHARS = 2_000_000  # so that a task's minima stay in the first, small hash map


def words(text: Column) -> Column:
    split = F.array_remove(F.split(F.translate(F.lower(text), "\t\n\v\f\r", "     "), " "), "")
    return F.when(F.size(split) == 0, F.array(F.lit(""))).otherwise(split)


def fingerprints(texts: DataFrame, keys: list[str], text_cols: list[str], reach: float | None = REACH) -> DataFrame:
    """(keys, samples) of each key: for each text column an array of SAMPLES smallints. `texts` has one row a key and is
    dealt out by (some of) the keys. Words that the texts of a row share draw their numbers once.

    The smallest value of a sample is exponentially distributed with the text's number of words n as its rate. A word of
    weight w can't get below c exp(-r) / w, so one for which that is over reach / n is left out before any logarithm is
    taken; with none left for a sample, as happens once in exp(reach) times, the sample is null. Without `reach` all are
    worked out."""
    sides = range(len(text_cols))
    sized = texts.select(*keys, *(words(F.col(c)).alias(f"ws{k}") for k, c in enumerate(text_cols)))
    sizes = [f"size{k}" for k in sides]
    terms = sized.select(*keys, *(F.size(f"ws{k}").alias(f"size{k}") for k in sides), F.explode(F.array(*(F.struct(F.lit(k).alias("side"), F.col(f"ws{k}").alias("ws")) for k in sides))).alias("e"))
    terms = terms.select(*keys, *sizes, "e.side", F.explode("e.ws").alias("w")).select(*keys, *sizes, "side", F.xxhash64("w").alias("h"))
    terms = terms.groupBy(*keys, *sizes, "h").agg(*(F.count(F.when(F.col("side") == k, 1)).alias(f"n{k}") for k in sides))
    logs = [f"lw{k}" for k in sides]
    share = [F.col(f"n{k}") * F.lit(reach or 0.0) / F.col(f"size{k}") for k in sides]
    rows = terms.select(
        *keys, "h", *(F.when(F.col(f"n{k}") > 0, F.log(f"n{k}")).alias(f"lw{k}") for k in sides),
        (F.greatest(*share) if len(share) > 1 else share[0]).alias("most"), F.explode(F.sequence(F.lit(0), F.lit(SAMPLES - 1))).alias("g"),
    )
    bits = lambda k: F.xxhash64(F.col("h").bitwiseXOR((F.col("g") * 4 + k).cast("long")))
    high = lambda x: (F.shiftrightunsigned(x, 32) + F.lit(0.5)) * F.lit(1 / (1 << 32))
    low = lambda x: (x.bitwiseAND(F.lit((1 << 32) - 1)) + F.lit(0.5)) * F.lit(1 / (1 << 32))
    rows = rows.select(*keys, "g", "h", *logs, "most", bits(0).alias("x0"), bits(1).alias("x1"))
    rows = rows.select(*keys, "g", "h", *logs, "most", (high(F.col("x0")) * low(F.col("x0"))).alias("u"), (high(F.col("x1")) * low(F.col("x1"))).alias("v"))
    if reach is not None:  # exp(-r) is u, and c = -ln v is at least 2 (1 - v) / (1 + v)
        rows = rows.where((F.lit(2.0) - 2 * F.col("v")) * F.col("u") <= F.col("most") * (F.col("v") + 1))
    rows = rows.select(*keys, "g", "h", *logs, (-F.log("u")).alias("r"), F.log(-F.log("v")).alias("c"), high(bits(2)).alias("b"))
    rows = rows.select(*rows.columns, *(F.floor(F.col(f"lw{k}") / F.col("r") + F.col("b")).alias(f"t{k}") for k in sides))

    def packed(k: int) -> Column:
        r, c, b, t = F.col("r"), F.col("c"), F.col("b"), F.col(f"t{k}")
        value = (c - r * (t - b) - r + 64) * F.lit(float(1 << 24))
        rank = F.least(F.greatest(value, F.lit(0.0)), F.lit(float((1 << 31) - 1))).cast("long")
        return F.when(t.isNotNull(), F.shiftleft(rank, 32).bitwiseOR(F.col("h").bitwiseXOR(F.shiftleft(t, 5)).bitwiseAND(F.lit((1 << 32) - 1))))

    rows = rows.select(*keys, "g", *(packed(k).alias(f"m{k}") for k in sides))
    least = rows.groupBy(*keys, "g").agg(*(F.min(f"m{k}").alias(f"m{k}") for k in sides))
    # the last 16 bits, as a signed smallint
    signed = lambda x: (x.bitwiseAND(F.lit(0xFFFF)) - F.lit(0x8000)).cast("short")
    part = F.struct("g", *(signed(F.col(f"m{k}")).alias(f"p{k}") for k in sides))
    parts = least.groupBy(*keys).agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return parts.select(*keys, F.array(*(F.col(f"parts.p{k}") for k in sides)).alias("samples"))


def likeness(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(SAMPLES))


def digits(samples: Column) -> Column:
    return F.concat_ws("", F.transform(samples, lambda x: F.lpad(F.lower(F.hex(x.cast("long") + F.lit(0x8000))), 4, "0")))


def following(ids: DataFrame) -> DataFrame:
    """(id, n, next_id) of distinct ids (id, n) in ascending order, the first after the last."""
    dealt = cut(ids.repartitionByRange("id").withColumn("p", F.spark_partition_id()))
    inside = Window.partitionBy("p").orderBy("id")
    rows = dealt.withColumn("next_in", F.lead("id").over(inside))
    firsts = dealt.groupBy("p").agg(F.min("id").alias("first"))  # one row a partition
    over = Window.orderBy("p")
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select("p", F.coalesce(F.lead("first").over(over), F.first("first").over(whole)).alias("next_p"))
    return rows.join(firsts, "p").select("id", "n", F.coalesce("next_in", "next_p").alias("next_id"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, samples, edited_samples, next_samples) of every row."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    sizes = rows.select("id", F.length("text").cast("long").alias("n")).groupBy("id").agg(F.max("n").alias("n"), F.sum("n").alias("total"))
    chain = cut(following(cut(sizes).select("id", "n")))
    chars = sizes.agg(F.sum("total")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(-(-chars // PARTITION_CHARS), 100_000))
    dealt = rows.repartition(parts, "id")
    key = F.xxhash64("text")
    texts = dealt.withColumn("key", key).groupBy("id", "key").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("times"))
    # from each document, the start that the one before it takes
    wanted = chain.select(F.col("next_id").alias("id"), F.col("id").alias("before"), F.floor(F.col("n") / 2).cast("int").alias("take"))
    starts = dealt.join(wanted.repartition(parts, "id"), "id").select(F.col("before").alias("id"), F.col("text").substr(F.lit(1), F.col("take")).alias("start"))
    starts = starts.repartition(parts, "id").groupBy("id").agg(F.min("start").alias("start"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = texts.join(starts, "id").select(
        "id", "key", "times", "text",
        F.concat(F.col("text").substr(F.lit(1), F.length("text") - half), F.col("start").substr(F.lit(1), half)).alias("edited"),
    )
    named = lambda df: df.select(
        F.col("id").alias("of"), F.col("key").alias("of_key"), F.get(F.col("samples"), F.lit(0)).alias("samples"), F.get(F.col("samples"), F.lit(1)).alias("edited_samples"),
    )
    found = named(fingerprints(edited, ["id", "key"], ["text", "edited"]))
    facts = edited.select("id", "key", "times", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    # both sides are dealt out by id; as a join key, the text's would deal them out again
    found = cut(facts.join(found, (F.col("id") == F.col("of")) & (F.col("key").bitwiseXOR(F.col("of_key")) == 0)).drop("of", "of_key"))
    full = lambda c: (F.size(c) == SAMPLES) & ~F.exists(c, lambda x: x.isNull())
    short = found.where(~(full("samples") & full("edited_samples")))
    if not short.isEmpty():  # about one document in 1e12: worked out again without leaving any word out
        again = named(fingerprints(edited.join(short.select("id", "key"), ["id", "key"]), ["id", "key"], ["text", "edited"], reach=None))
        again = short.drop("samples", "edited_samples").join(again, (F.col("id") == F.col("of")) & (F.col("key") == F.col("of_key")))
        found = cut(found.join(short.select("id", "key"), ["id", "key"], "left_anti").unionByName(again.select(*found.columns)))
    found = found.drop("key")
    # the next document's, of its smallest text's samples if it has several
    theirs = found.join(wanted.select("id", "before"), "id").groupBy("before").agg(F.min("samples").alias("next_samples"))
    out = found.join(theirs.withColumnRenamed("before", "id"), "id")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return out.select(F.when(F.col("id") != LOWEST, F.col("id")).alias("doc_id"), "n_chars", "edited_sha256", "samples", "edited_samples", "next_samples")


def op8_weighted_sampling(docs: DataFrame) -> DataFrame:
    found = fingerprint_edits(docs)
    return found.select(
        "doc_id", "n_chars", "edited_sha256",
        digits(F.col("samples")).alias("fingerprint"), digits(F.col("edited_samples")).alias("edited_fingerprint"),
        likeness(F.col("samples"), F.col("edited_samples")).alias("near_edited"),
        likeness(F.col("samples"), F.col("next_samples")).alias("near_next"),
    )
