"""Session settings every job relies on.

``prepare(spark)`` is idempotent and called at the top of each public entry
point.  It only touches runtime SQL confs that change results or plan shape:

* ``spark.sql.session.timeZone=UTC`` - timestamps carry no zone in the source
  data; hour / day / month extraction must not depend on the machine zone.
* AQE with skew-join splitting and partition coalescing - joins of the fact
  with its dimensions shuffle on user / merchant keys, and a busy key can hold
  a large share of the rows.

The checkpoint folder is read from ``spark.checkpoint.dir`` (the shared folder
a cluster names); a local master without one gets a folder of this machine.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_RUNTIME_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in _RUNTIME_CONFS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Taken from the session (``spark.checkpoint.dir``).  Only a local master, as
    in tests, may fall back to a folder of this machine when it is unset: on a
    cluster the executors and the driver would not see each other's files.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no local context
        sc = None
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="paymart-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint root for a materialised table."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/paymart/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "paymart",
                  driver_memory: str = "8g") -> SparkSession:
    """Session for tests and the local benchmark (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in _RUNTIME_CONFS.items():
        builder = builder.config(key, value)
    if os.environ.get("PAYMART_EVENT_LOG_DIR"):
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", os.environ["PAYMART_EVENT_LOG_DIR"]))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
