"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def local_session(cpus: int | str = "*", app: str = "mdquarry", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks (cluster jobs get theirs from spark-submit)."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**_LOCAL_CONF, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage; we
    only invent one (a fresh temp folder) when running in local mode and the
    setting is absent, as in tests.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: only the session conf is visible
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("spark.checkpoint.dir is not set")
        return d
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/ABFS) before running lineage-cutting stages"
        )
    d = tempfile.mkdtemp(prefix="mdquarry-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
