"""Session construction and the shared working folder.

All intermediate tables that cut lineage (merge targets, partitioned copies,
stream checkpoints) live under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that is unset (local runs, tests) do we
pick our own folder.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "meterline",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Local/test session with the settings the library assumes.

    On a cluster the session comes from the launcher; these settings are
    the ones that matter there too: AQE (coalescing + skew joins), UTC,
    no UI.
    """
    master = master or f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    b = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Target size of one task's input and of one shuffle partition.
TASK_BYTES = 256 * 1024 ** 2


def scale_settings(scan_bytes: int, total_cores: int) -> dict[str, str]:
    """Session settings for a cluster run whose largest shuffle carries about
    ``scan_bytes`` (the scanned bytes after column pruning) on
    ``total_cores`` executor cores; pass them to the launcher (or to
    ``get_session(extra_conf=...)``).

    The shuffle starts with one partition per ~256 MB (at least two per
    core) and AQE coalesces partitions that filters made small, so no
    reducer spills because 100 TB met the default 200 partitions; file
    splits are 256 MB; skewed join partitions and hot rebalance partitions
    (a day holding a third of the rows) are split at the same size.
    """
    parts = max(2 * int(total_cores), math.ceil(int(scan_bytes) / TASK_BYTES))
    size = str(TASK_BYTES)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": size,
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder for written tables and checkpoints.

    Reads ``spark.checkpoint.dir`` from the session.  Sets a folder of its
    own only where none is configured (local mode and tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="meterline-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path for one written table version."""
    return f"{shared_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
