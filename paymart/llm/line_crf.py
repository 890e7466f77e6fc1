"""Operator 5, quality rules: a linear-chain conditional random field labels each line content or boilerplate.

A document's lines with a word form a chain of two labels. Emission scores come from a few measures of each line, the
transitions from a 2 x 2 table; Viterbi decoding finds the best labelling, and the share of characters in content lines
decides whether the document stays. Plain rules on the whole text (word count, repeated three-word windows) come first.

The field is fitted by exact gradient (forward-backward) on the lines of labelled documents: lines of good documents count
as content, of bad ones as boilerplate. Labels of whole documents show no switch between lines, so the transitions stay
those of the prior and the emission weights are fitted under them. The sample is bounded: `sample` documents of each class,
those with the smallest hash of their id, with all their lines; the driver's memory and the fit grow with these. Of the
rows of a repeated doc_id one is used, the one whose measures have the smallest hash. Without labels of both classes the
prior weights are used.

Null text counts as empty: no words, so the base rule fails. Repeated rows give repeated results; equal texts always get
equal verdicts. Texts of any length are judged whole, in memory proportional to the text. An empty table gives an empty
one. Other columns, whatever their names, aren't read."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.common import one_each, runs, workers_can_import

CHAIN = 1024  # lines; longer documents are fitted as several chains
BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
FEATURES = ("bias", "upper", "symbols", "bars", "bangs", "adjacent", "variety", "word_length", "short_words", "long_line", "repeated", "digits")
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, content_share double, labels binary"
)


def _prior() -> np.ndarray:
    """Emission score of content over boilerplate before any fit."""
    return np.array([2.0, -6.0, -12.0, -12.0, -12.0, -8.0, 1.0, 0.0, 1.0, 0.0, -1.0, -1.0])


@dataclass(frozen=True)
class LineField:
    """Weights: score of content over boilerplate by feature; transition scores [from][to], 1 is content."""

    emission: np.ndarray = field(default_factory=_prior)
    transition: np.ndarray = field(default_factory=lambda: np.array([[0.5, -0.5], [-0.5, 0.5]]))

    def viterbi(self, scores: list[float]) -> list[int]:
        """Best labels; ties go to content."""
        (t00, t01), (t10, t11) = self.transition.tolist()
        bad, good, back = 0.0, scores[0], []
        for s in scores[1:]:
            from_bad = (bad + t00 > good + t10, bad + t01 > good + t11)
            bad, good = (bad + t00 if from_bad[0] else good + t10), (bad + t01 if from_bad[1] else good + t11) + s
            back.append(from_bad)
        label = int(good >= bad)
        out = [label]
        for from_bad in reversed(back):
            label = int(not from_bad[label])
            out.append(label)
        return out[::-1]


def line_features(words: list[bytes], seen: bool) -> tuple[float, ...]:
    """Measures of a line's words, each about 0 to 1; `seen`: an equal line came before."""
    n = len(words)
    joined = b"".join(words)
    size = len(joined)
    return (
        1.0,
        sum(map(bytes.isupper, words)) / n,
        (size - len(joined.translate(None, b"#*$%&<>"))) / size,
        joined.count(b"|") / n,
        joined.count(b"!") / n,
        sum(map(eq, words, words[1:])) / n,
        len(set(words)) / n,
        min(size / n / 20, 2.0),
        sum(1 for w in words if len(w) <= 3) / n,
        min(math.log1p(n) / 5, 2.0),
        float(seen),
        (size - len(joined.translate(None, b"0123456789"))) / size,
    )


def text_lines(text: str) -> list[tuple[list[bytes], int, bool]]:
    """(words, code points of the words, whether an equal line came before) of each line with a word."""
    out, before = [], set()
    for line in text.split("\n"):
        if words := line.encode("utf-8", "surrogatepass").split():
            out.append((words, len(line) - sum(map(line.count, BLANKS)), line in before))
            before.add(line)
    return out


def base_measures(text: str, words: list[bytes], lines: list) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    n, repeated = len(words), 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(counts := Counter(windows)) < len(windows):
            until = 0
            for i, window in enumerate(windows):
                if counts[window] > 1:
                    repeated += i + 3 - max(i, until)
                    until = i + 3
    return n, len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), sum(x[2] for x in lines), repeated


def _either(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log(exp(a) + exp(b))"""
    return np.maximum(a, b) + np.log1p(np.exp(-np.abs(a - b)))


def fit(chains: list[tuple[np.ndarray, int]], rounds: int = 60, rate: float = 0.3, l2: float = 0.05) -> LineField:
    """Maximum likelihood of (lines x features, label) chains by Adam on the exact gradient; classes weigh the same."""
    if {y for _, y in chains} != {0, 1}:
        return LineField()
    share = np.mean([y for _, y in chains])
    n_docs = len(chains)
    chains = [(x[k : k + CHAIN], y) for x, y in chains for k in range(0, len(x), CHAIN)]
    chains.sort(key=lambda c: -len(c[0]))
    # all first lines, then all second ones, and so on: those of chain i at line t are at start[t] + i
    size = np.array([len(x) for x, _ in chains])
    going = np.array([np.count_nonzero(size > t) for t in range(size[0])])
    start = np.cumsum(going) - going
    chain_of = np.concatenate([np.arange(n) for n in going])
    X = np.zeros((size.sum(), len(FEATURES)))
    for i, (x, _) in enumerate(chains):
        X[start[: len(x)] + i] = x
    y = np.array([label for _, label in chains])[chain_of]
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    last = start[size - 1] + np.arange(len(chains))
    prior = LineField()
    T, theta = prior.transition, prior.emission.copy()
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        e = X @ theta
        score = np.stack([np.zeros_like(e), e], -1)
        alpha, beta = score.copy(), np.zeros_like(score)
        for t in range(1, len(going)):
            now, before = slice(start[t], start[t] + going[t]), alpha[start[t - 1] : start[t - 1] + going[t]]
            alpha[now] += _either(before[:, 0, None] + T[0], before[:, 1, None] + T[1])
        for t in range(len(going) - 1, 0, -1):
            now = slice(start[t], start[t] + going[t])
            ahead = (score[now] + beta[now])[:, None, :] + T
            beta[start[t - 1] : start[t - 1] + going[t]] = _either(ahead[:, :, 0], ahead[:, :, 1])
        logz = _either(alpha[last, 0], alpha[last, 1])[chain_of]
        p = np.exp(alpha[:, 1] + beta[:, 1] - logz)
        grad = ((y - p) * weight) @ X / weight.sum() - l2 * (theta - prior.emission) / n_docs
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return LineField(theta, T)


def train(docs: DataFrame, labels: DataFrame, sample: int = 200) -> LineField:
    """Fit on `sample` documents of each class, picked by the hash of their id; the driver holds only their features."""
    workers_can_import(docs.sparkSession)
    picked = []
    for quality in (0, 1):
        ids = labels.where((F.col("quality") == quality) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
        picked.append(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).withColumn("y", F.lit(quality)))
    rows = docs.select("doc_id", F.col("text").alias("t")).join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("t").to_pylist():
                lines = text_lines(text or "")
                out.append(np.array([line_features(w, seen) for w, _, seen in lines], "<f8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(out, pa.binary())], ["i", "y", "x"])

    got = one_each(rows.select("doc_id", "y", "t").mapInArrow(run, "i long, y int, x binary"), ["x"]).collect()
    chains = [(np.frombuffer(r.x, "<f8").reshape(-1, len(FEATURES)), r.y) for r in sorted(got, key=lambda r: (r.i, r.y, r.x)) if r.x]
    return fit(chains)


def label_lines(docs: DataFrame, model: LineField, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base measures, share of word characters in content lines (0 without lines) and a byte per line with a word: 1 content."""
    workers_can_import(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "t", 1 << 21):
            rows = []
            for text in batch.column("t").to_pylist():
                text = text or ""
                lines = text_lines(text)
                words = [w for ws, _, _ in lines for w in ws]
                n, chars, symbols, dup, repeated = base_measures(text, words, lines)
                share, marks = 0.0, b""
                if lines:
                    x = np.array([line_features(ws, seen) for ws, _, seen in lines])
                    marks = bytes(model.viterbi((x @ model.emission).tolist()))
                    share = sum(size for (_, size, _), on in zip(lines, marks) if on) / chars
                rows.append((n, chars, symbols, dup, repeated, n < 50 or 100 * repeated > 50 * n, share, marks))
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.binary()]
            cols = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("i"), *cols], [f.split()[0] for f in SCHEMA.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).mapInArrow(run, SCHEMA)


def op5_line_crf(docs: DataFrame, labels: DataFrame, least_share: float = 0.5) -> DataFrame:
    out = label_lines(docs, train(docs, labels))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("content_share") >= least_share)).drop("labels")


def keep_content(docs: DataFrame, labels: DataFrame, least_share: float = 0.5, fit_on: DataFrame | None = None) -> DataFrame:
    """The rows of `docs` that pass the base rules and whose lines are mostly content; the text is read once, in place.

    fit_on: labelled documents of both classes, where `docs` has lost its bad ones already."""
    workers_can_import(docs.sparkSession)
    model = train(docs if fit_on is None else fit_on, labels)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "text", 1 << 21):
            keep = []
            for text in batch.column("text").to_pylist():
                text = text or ""
                lines = text_lines(text)
                words = [w for ws, _, _ in lines for w in ws]
                n, chars, _, _, repeated = base_measures(text, words, lines)
                if ok := not (n < 50 or 100 * repeated > 50 * n):
                    x = np.array([line_features(ws, seen) for ws, _, seen in lines])
                    marks = model.viterbi((x @ model.emission).tolist())
                    ok = sum(size for (_, size, _), on in zip(lines, marks) if on) / chars >= least_share
                keep.append(ok)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)
