"""Session helpers: a configured local session for tests and benches, and the
shared folder for checkpoints and staged tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "audix",
                shuffle_partitions: int | None = None) -> SparkSession:
    """A session with AQE on and the UI off (used by tests, bench and entry)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("AUDIX_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from the session (``spark.checkpoint.dir`` or an earlier
    ``setCheckpointDir``). Only a local-mode session without one gets a
    private folder; a cluster session without one is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="audix-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for a written table.

    Folders live in the application's own checkpoint folder, which a cluster
    removes with the application's other checkpoints.
    """
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/audix-stage/{name}-{uuid.uuid4().hex}"
