"""Helpers shared by the operators: inputs, the shared scratch folder, lineage cuts and Arrow loops."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPO_ROOT = str(Path(__file__).resolve().parents[2])


def workers_can_import(spark: SparkSession) -> None:
    """Python workers that share this machine's files find the package where the driver found it.

    On a cluster the package is installed on the executors and the extra path is harmless."""
    env = spark.sparkContext.environment
    if REPO_ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [REPO_ROOT, env.get("PYTHONPATH", "")]))


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder: the context's checkpoint folder or spark.checkpoint.dir.

    Only a local master, as in tests, may fall back to a temporary folder of this machine."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = Path(tempfile.mkdtemp(prefix="paymart-llm-")).as_uri()
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder name under the shared root (the writer makes the folder)."""
    return f"{shared_root(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute once, keep in the shared folder, cut the lineage: survives the loss of any executor."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, few: bool = False) -> DataFrame:
    """As `cut`, but by a Parquet table of the shared folder: computed once, and without the constraints that a checkpoint
    hands on, which Catalyst multiplies over many rounds of joins.

    `few`: a table with few rows for its many shuffle partitions goes to a sixteenth as many files, two a core at least."""
    spark = df.sparkSession
    folder = shared_folder(spark, "written")
    if few:
        df = df.coalesce(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 16))
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_each(rows: DataFrame, features: list[str]) -> DataFrame:
    """One row of each (i, y): the one whose features have the smallest hash, so that a repeated id stays one row.

    Combined in every task before the shuffle, which therefore deals a row of each id and task at most."""
    first = F.min(F.struct(F.xxhash64(*features).alias("h"), *features)).alias("f")
    return rows.groupBy("i", "y").agg(first).select("i", "y", *(f"f.{c}" for c in features))


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


#: What Python workers keep from task to task, by name: how it is emptied.
WORKER_CACHES: dict[str, Callable[[], None]] = {}


def give_back(uses: str | None = None) -> None:
    """Empties the caches of this worker but for the one named, and hands back the memory that Arrow holds unused.

    Spark's workers live on from job to job; without this they hold the caches of every operator that they have served."""
    for name, empty in WORKER_CACHES.items():
        if name != uses:
            empty()
    pa.default_memory_pool().release_unused()


def runs(batches: Iterable[pa.RecordBatch], column: str, limit: int, uses: str | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `limit` bytes of `column`, at least one row each.

    Bounds what a task holds at a time beyond one whole row. `uses`: the worker's cache that the task needs; others go."""
    give_back(uses)
    for batch in batches:
        n, start = batch.num_rows, 0
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        held = 0
        for i in range(n):
            held += sizes[i]
            if held >= limit or i == n - 1:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0
    batch = None
    give_back(uses)
