"""Operator 10, quality classifier by co-training of two views.

View one is the text's content: hashed words and how they are written. View two is the page's metadata: language, source,
stored length and the layout of lines and blanks. A logistic classifier of each view starts from labelled documents; in
each round both score a pool of unlabelled documents, and each hands the ones it is surest of, good and bad in the
proportion of the labels, to the other as training examples. Held-out labels then calibrate both views (Platt), and their
log odds, less the prior's, add up to the score of every document.

The fit uses a bounded sample: at most `sample` labelled documents of each class and `pool` unlabelled ones, those with
the smallest hash of their id; of the rows of a repeated doc_id, the one whose features have the smallest hash. The driver
gets their features only, TEXT_DIMS + 10 numbers at most each. Scoring reads
every document whole and needs memory in proportion to one text.

Null text counts as empty, null language, source or length as a value of its own; empty texts are scored like any other.
Repeated rows get repeated scores, equal rows equal ones. A document with contradicting labels is used with each. Without
labels of both classes nothing can be learnt and every document scores 1 and is kept. An empty table gives an empty one.
Other columns, whatever their names, aren't read."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.common import one_each, runs, workers_can_import

TEXT_DIMS, META_DIMS, STYLE = 1024, 64, 8
SCHEMA = "doc_id long, content_score double, meta_score double, score double"


def content_view(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(slots, values): words hashed to TEXT_DIMS slots by root of their count, then STYLE measures and a constant."""
    words = text.encode("utf-8", "surrogatepass").split()
    n = max(len(words), 1)
    counts = Counter(words)
    slots = np.fromiter((crc32(w) % TEXT_DIMS for w in counts), np.int64, len(counts))
    values = np.sqrt(np.fromiter(counts.values(), np.float64, len(counts)))
    held, at = np.unique(slots, return_inverse=True)
    values = np.bincount(at, values, len(held)).astype(float)  # of no words: whole numbers
    values /= max(np.sqrt((values**2).sum()), 1.0)
    joined = b"".join(words)
    size = max(len(joined), 1)
    style = [
        sum(map(bytes.isupper, words)) / n,
        sum(map(eq, words, words[1:])) / n,
        1 - len(counts) / n,
        min(joined.count(b"|") / n, 1.0),
        min(joined.count(b"!") / n, 1.0),
        (size - len(joined.translate(None, b"#*$%&<>"))) / size * 3,
        min(size / n / 10, 2.0),
        1.0,
    ]
    return np.concatenate([held, np.arange(TEXT_DIMS, TEXT_DIMS + STYLE)]), np.concatenate([values, style])


def meta_view(text: str, lang: str | None, source: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Language and source hashed to META_DIMS slots, then length and layout measures and a constant."""
    lines = text.count("\n") + 1
    n = max(len(text), 1)
    values = [
        1.0, 0.5,
        math.log1p(max(n_chars or 0, 0)) / 10, math.log1p(lines) / 5, math.log1p(n / lines) / 10,
        text.count(" ") / n * 5, (text.count(".") + text.count(",")) / n * 20, sum(map(text.count, "!|#*$%&")) / n * 20, 1.0,
    ]
    named = [crc32(f"lang={lang}".encode("utf-8", "surrogatepass")) % META_DIMS, crc32(f"source={source}".encode("utf-8", "surrogatepass")) % META_DIMS]
    return np.array([*named, *range(META_DIMS, META_DIMS + 7)]), np.array(values)


VIEWS = {"content": TEXT_DIMS + STYLE, "meta": META_DIMS + 7}


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def logistic(X: np.ndarray, y: np.ndarray, l2: float = 1e-3, rounds: int = 150, rate: float = 0.3) -> np.ndarray:
    """Weights by Adam on the whole sample; both classes weigh the same."""
    share = y.mean()
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / len(y)
    w, m, v = (np.zeros(X.shape[1]) for _ in range(3))
    for step in range(1, rounds + 1):
        grad = X.T @ ((_sigmoid(X @ w) - y) * weight) + l2 * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w


def platt(z: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(a, b): P(good) = sigmoid(a z + b), by Newton's method on smoothed targets."""
    good, bad = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    Z = np.stack([z, np.ones_like(z)], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = _sigmoid(Z @ theta)
        grad = Z.T @ (p - target) + 1e-3 * theta
        hess = (Z * (p * (1 - p))[:, None]).T @ Z + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        theta = theta - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
    return max(float(theta[0]), 0.0), float(theta[1])


@dataclass(frozen=True)
class TwoViews:
    content: np.ndarray
    meta: np.ndarray
    content_scale: tuple[float, float]
    meta_scale: tuple[float, float]
    prior: float  # log odds of good

    def scores(self, text: str, lang, source, n_chars) -> tuple[float, float, float]:
        odds = []
        for weights, (a, b), (at, x) in ((self.content, self.content_scale, content_view(text)), (self.meta, self.meta_scale, meta_view(text, lang, source, n_chars))):
            odds.append(a * float(weights[at] @ x) + b)
        both = odds[0] + odds[1] - self.prior
        return float(_sigmoid(odds[0])), float(_sigmoid(odds[1])), float(_sigmoid(both))


def cotrain(rows: list, rounds: int = 5, share: float = 0.1) -> TwoViews | None:
    """rows: (y or None, {view: (slots, values)}). Every fourth labelled row is held out for calibration."""
    X = {}
    for view, dims in VIEWS.items():
        X[view] = np.zeros((len(rows), dims), np.float64)
        for i, (_, views) in enumerate(rows):
            np.add.at(X[view][i], views[view][0], views[view][1])
    y = np.array([-1 if label is None else label for label, _ in rows])
    known = np.flatnonzero(y >= 0)
    order = known[np.argsort(y[known], kind="stable")]
    held = order[3::4]
    start = np.setdiff1d(known, held)
    if len(set(y[start].tolist())) < 2 or len(set(y[held].tolist())) < 2:
        return None
    good = y[known].mean()
    train = {view: (start.tolist(), y[start].tolist()) for view in VIEWS}
    pool = set(np.flatnonzero(y < 0).tolist())
    for _ in range(rounds):
        weights = {view: logistic(X[view][at], np.array(label)) for view, (at, label) in train.items()}
        if not pool:
            break
        left = np.array(sorted(pool))
        each = max(2, int(share * len(left)))
        for view, other in (("content", "meta"), ("meta", "content")):
            rank = left[np.argsort(X[view][left] @ weights[view], kind="stable")]
            bad = rank[: max(1, round(each * (1 - good)))]
            fine = rank[::-1][: max(1, round(each * good))]
            for at, label in ((bad, 0), (fine, 1)):
                taken = [i for i in at.tolist() if i in pool]
                train[other][0].extend(taken)
                train[other][1].extend([label] * len(taken))
                pool -= set(taken)
    weights = {view: logistic(X[view][at], np.array(label)) for view, (at, label) in train.items()}
    scale = {view: platt(X[view][held] @ weights[view], y[held]) for view in VIEWS}
    share_good = min(max(y[held].mean(), 1e-3), 1 - 1e-3)
    return TwoViews(weights["content"], weights["meta"], scale["content"], scale["meta"], math.log(share_good / (1 - share_good)))


def train(docs: DataFrame, labels: DataFrame, sample: int = 500, pool: int = 1000) -> TwoViews | None:
    """Fit on at most `sample` labelled documents of each class and `pool` unlabelled ones."""
    workers_can_import(docs.sparkSession)
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    usable = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", F.col("quality").alias("y")).distinct()
    picked = [usable.where(F.col("y") == q).orderBy(*by_hash).limit(sample) for q in (0, 1)]
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    rest = ids.join(usable.select("doc_id"), "doc_id", "left_anti").orderBy(*by_hash).limit(pool).withColumn("y", F.lit(-1))
    wanted = picked[0].unionByName(picked[1]).unionByName(rest)  # at most 2 * sample + pool ids
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars").join(F.broadcast(wanted), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "text", 1 << 21):
            cols = {c: batch.column(c).to_pylist() for c in ("doc_id", "y", "text", "lang", "source", "n_chars")}
            out = []
            for i, y, text, lang, source, n in zip(*cols.values()):
                parts = [p for view in (content_view(text or ""), meta_view(text or "", lang, source, n)) for p in view]
                out.append((i, y, *(p.astype("<f4").tobytes() for p in parts)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.int64(), pa.int32()] + [pa.binary()] * 4)], ["i", "y", "a", "b", "c", "d"])

    got = one_each(rows.mapInArrow(run, "i long, y int, a binary, b binary, c binary, d binary"), ["a", "b", "c", "d"]).collect()
    read = lambda raw: np.frombuffer(raw, "<f4")
    # the labels' own rates, so that the calibrated score means what it says
    rows = []
    for r in sorted(got, key=lambda r: (r.i, r.y, r.a, r.b, r.c, r.d)):
        views = {"content": (read(r.a).astype(np.int64), read(r.b).astype(float)), "meta": (read(r.c).astype(np.int64), read(r.d).astype(float))}
        rows.append((None if r.y < 0 else r.y, views))
    return cotrain(rows)


def score_documents(docs: DataFrame, model: TwoViews | None) -> DataFrame:
    """SCHEMA of every row."""
    workers_can_import(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "text", 1 << 21):
            cols = (batch.column(c).to_pylist() for c in ("text", "lang", "source", "n_chars"))
            out = [model.scores(t or "", *rest) if model else (1.0, 1.0, 1.0) for t, *rest in zip(*cols)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.float64()) for c in zip(*out))], [f.split()[0] for f in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", "n_chars").mapInArrow(run, SCHEMA)


def op10_cotraining(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    return score_documents(docs, train(docs, labels)).withColumn("kept", F.col("score") >= least)


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of `docs` that score at least `least`, judged in place."""
    model = train(docs, labels)
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "text", 1 << 21):
            cols = (batch.column(c).to_pylist() for c in ("text", "lang", "source", "n_chars"))
            yield batch.filter(pa.array([model.scores(t or "", *rest)[2] >= least for t, *rest in zip(*cols)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
