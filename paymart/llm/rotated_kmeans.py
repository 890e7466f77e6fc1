"""Operator 11, centroid clustering: a rotation to principal axes filters centroids, integers decide.

Components become integers, floor(scale * x). The vectors are rotated to the principal axes of their covariance, which
Spark sums up over all rows; of a rotated vector only the LEADING coordinates and the norm of the rest are stored beside
the integers. For a centroid treated alike,

    |p - pc|^2 + (r - rc)^2 <= |x - c|^2

as the rest of the vectors can't be nearer than their norms. The centroid of the smallest bound is measured in integers;
every other centroid whose bound, less a margin for rounding, doesn't exceed that distance survives and is measured too, so
that the nearest one, the smaller number among equals, is always among them. Any rotation gives right results; this one
leaves few survivors.

A round is one pass over the stored table: each task sums its vectors by centroid, Spark adds the sums exactly and k *
dimensions numbers reach the driver, whatever the size of the input; a round's centroids (k rows) go back with the task.

Vectors of another length, or with a null or non-finite component, are left out, as is a null vector. Components must stay
under 2**27 in size as integers, so that a distance is a long; larger ones end the job with an error that says so. A null
vec_id is hashed as an empty text; equal hashes (repeated ids) are ordered by the vectors. Repeated rows are vectors of
their own and may start as equal centroids: the larger number then gets none and stays. Fewer rows than k give as many
centroids as rows; an empty table gives an empty result. Other columns are not read."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paymart.llm.common import cut, workers_can_import

K, ROUNDS, DIMENSIONS, SCALE, LEADING = 8, 10, 64, 1024, 16
LARGEST = 1 << 27
_FLOATS, _INTS = "<f8", "<i4"


def whole(vector: str, dimensions: int) -> Column:
    """True for vectors of the right length whose components are all finite numbers."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) == dimensions) & good


def _rows(batch: pa.RecordBatch, column: str, kind: str) -> np.ndarray:
    """A matrix of a column of equally long binaries or lists, without copying them one by one."""
    values = batch.column(column)
    if pa.types.is_binary(values.type):
        return np.frombuffer(b"".join(values.to_pylist()), kind).reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1), kind)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(kind)


def integers(vectors: DataFrame, dimensions: int, scale: int) -> DataFrame:
    """(vec_id, x) of the vectors kept: x as an array of double without a fraction."""
    kept = vectors.select("vec_id", F.col("embedding").alias("e")).where(whole("e", dimensions))
    return kept.select("vec_id", F.transform("e", lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("x"))


def moments(points: DataFrame, dimensions: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, mean, covariance) of all points: every task sums up products, Spark adds the sums cell by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, np.zeros(dimensions), np.zeros((dimensions, dimensions))
        for batch in batches:
            x = _rows(batch, "x", "f8").reshape(-1, dimensions)
            if len(x) and np.abs(x).max() >= LARGEST:
                raise ValueError(f"a component, scaled, is not under {LARGEST} in size: its distances are no longs")
            n, total, products = n + len(x), total + x.sum(0), products + x.T @ x
        if n:
            cells = np.concatenate([[n], total, products.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "s"])

    cells = points.select("x").mapInArrow(run, "cell long, s double").groupBy("cell").agg(F.sum("s").alias("s"))
    sums = np.zeros(1 + dimensions + dimensions**2)
    for row in cells.collect():  # 1 + dimensions + dimensions ** 2 rows
        sums[row.cell] = row.s
    n, mean = int(sums[0]), sums[1 : 1 + dimensions] / max(sums[0], 1)
    return n, mean, sums[1 + dimensions :].reshape(dimensions, dimensions) / max(n, 1) - np.outer(mean, mean)


class Rotation:
    def __init__(self, mean: np.ndarray, covariance: np.ndarray, leading: int):
        _, axes = np.linalg.eigh(covariance)
        self.mean, self.axes, self.leading = mean, axes[:, ::-1], leading

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Leading coordinates, the rest's norm and the whole squared norm of each row."""
        y = (x - self.mean) @ self.axes
        rest = (y[:, self.leading :] ** 2).sum(1)
        return np.column_stack([y[:, : self.leading], np.sqrt(rest), (y**2).sum(1)])


def nearest(x: np.ndarray, stored: np.ndarray, centroids: np.ndarray, rotated: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(centroid, squared distance, distances measured) of the integer rows x."""
    n, q = len(x), stored.shape[1] - 2
    low = ((stored[:, q, None] - rotated[None, :, q]) ** 2) + ((stored[:, None, :q] - rotated[None, :, :q]) ** 2).sum(2)
    low -= 1e-9 * (stored[:, q + 1, None] + rotated[None, :, q + 1]) + 1.0  # rounding
    rows = np.arange(n)
    first = low.argmin(1)
    best = ((x - centroids[first]) ** 2).sum(1)
    survivors = low <= best[:, None]
    survivors[rows, first] = False
    cluster, measured = first, n
    for c in range(len(centroids)):
        at = np.flatnonzero(survivors[:, c] & (low[:, c] <= best))
        if not len(at):
            continue
        measured += len(at)
        d = ((x[at] - centroids[c]) ** 2).sum(1)
        wins = (d < best[at]) | ((d == best[at]) & (c < cluster[at]))
        best[at[wins]], cluster[at[wins]] = d[wins], c
    return cluster, best, measured


def prepared(points: DataFrame, rotation: Rotation, dimensions: int) -> DataFrame:
    """(vec_id, x as 32-bit integers, p): the table that the rounds read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch, "x", "f8").reshape(-1, dimensions)
            p, whole_x = rotation(x).astype(_FLOATS), x.astype(_INTS)
            cols = [batch.column("vec_id"), pa.array([r.tobytes() for r in whole_x], pa.binary()), pa.array([r.tobytes() for r in p], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["vec_id", "x", "p"])

    return points.mapInArrow(run, "vec_id long, x binary, p binary")


def _over(table: DataFrame, schema: str, step: Callable, dimensions: int) -> DataFrame:
    """`step` of every batch's ids, integer rows and stored coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step((batch.column("vec_id"), _rows(batch, "x", _INTS).reshape(-1, dimensions).astype(np.int64), _rows(batch, "p", _FLOATS)) for batch in batches if batch.num_rows)

    return table.mapInArrow(run, schema)


def _new_sums(table: DataFrame, centroids: np.ndarray, rotated: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """centroid -> (vectors, sum of each component), exactly."""
    k, dimensions = centroids.shape

    def step(parts) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for _, x, p in parts:
            cluster, _, _ = nearest(x, p, centroids, rotated)
            n += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                sums[c] += x[cluster == c].sum(0)
        used = np.flatnonzero(n)
        cells = np.column_stack([n, sums])[used]
        if len(used):
            cols = [np.repeat(used, dimensions + 1), np.tile(np.arange(dimensions + 1), len(used)), cells.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], ["c", "i", "s"])

    cells = _over(table, "c long, i long, s long", step, dimensions).groupBy("c", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found: dict[int, dict[int, int]] = {}
    for row in cells.collect():  # k * (dimensions + 1) rows at most
        found.setdefault(row.c, {})[row.i] = int(row.s)
    return {c: (cell[0], [cell[i + 1] for i in range(dimensions)]) for c, cell in found.items()}


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, leading: int = LEADING, seed: str = "3:") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector kept, and the final centroids (integers, a row each)."""
    spark = vectors.sparkSession
    workers_can_import(spark)
    points = integers(vectors, dimensions, scale)
    n, mean, covariance = moments(points, dimensions)
    rotation = Rotation(mean, covariance, min(leading, dimensions))
    rank = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = points.select(rank.alias("h"), "x").orderBy("h", "x").limit(k).collect()
    centroids = np.array([r.x for r in first], np.int64).reshape(-1, dimensions)
    table = cut(prepared(points, rotation, dimensions))
    for _ in range(rounds if n else 0):
        for c, (count, sums) in _new_sums(table, centroids, rotation(centroids)).items():
            centroids[c] = [s // count for s in sums]
    final, rotated = centroids.copy(), rotation(centroids)

    def step(parts) -> Iterator[pa.RecordBatch]:
        for ids, x, p in parts:
            c, d, _ = nearest(x, p, final, rotated)
            yield pa.RecordBatch.from_arrays([ids, pa.array(c.astype(np.int32)), pa.array(d)], ["vec_id", "cluster", "distance"])

    return cut(_over(table, "vec_id long, cluster int, distance long", step, dimensions)), centroids


def op11_rotated_kmeans(vectors: DataFrame) -> DataFrame:
    assigned, centroids = cluster(vectors)
    spark = vectors.sparkSession
    names = [(c, hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest()) for c, row in enumerate(centroids)]
    long_sum = lambda col: F.sum(F.col(col).cast("decimal(38,0)"))
    inertia = assigned.groupBy("cluster").agg(long_sum("distance").alias("s"))
    total = inertia.agg(F.sum("s")).scalar()
    per = spark.createDataFrame(names, "cluster int, centroid_sha256 string").join(inertia, "cluster")
    per = per.select("cluster", F.col("s").cast("long").alias("cluster_inertia"), total.cast("long").alias("inertia"), "centroid_sha256")
    return assigned.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # per: k rows at most


def _sql() -> str:
    steps = []
    distance = "list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for r in range(ROUNDS + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT v.row, v.x, arg_min(c.c, ({distance}, c.c)) AS c, min({distance}) AS d FROM v CROSS JOIN c{r} c GROUP BY ALL)")
        if r < ROUNDS:
            steps.append(
                f"m{r} AS (SELECT c, list(m ORDER BY i) AS x FROM (SELECT c, i, floor_div(sum(e), count(*)) AS m FROM (SELECT c, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM a{r}) GROUP BY c, i) GROUP BY c),"
                f"\nc{r + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m ON m.c = c.c)"
            )
    body = ",\n".join(steps).replace("floor_div(sum(e), count(*))", "(sum(e) - ((sum(e) % count(*)) + count(*)) % count(*)) // count(*)")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, [floor({SCALE} * e::DOUBLE)::HUGEINT FOR e IN embedding] AS x FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len([e FOR e IN embedding IF e IS NOT NULL AND isfinite(e)]) = {DIMENSIONS}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM (SELECT sha256('3:' || coalesce(vec_id::VARCHAR, '')) AS h, x FROM v ORDER BY h, x LIMIT {K})),
{body}
SELECT v.vec_id, a.c::INTEGER AS cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN v ON v.row = a.row JOIN c{ROUNDS} c ON c.c = a.c
"""


OP11_SQL = _sql()
