"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Only correctness-relevant and adaptive settings: master, memory and cores
# belong to the deployment (spark-submit), not to the library.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Stages after a shuffle may carry per-row Python work; do not merge them down to one task.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "strandline", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the library defaults; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Where the setting is absent, as on a laptop or in tests, a folder of the process is made and
    removed at its end; without a local master that raises, since executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = getattr(spark, "_strandline_checkpoint_root", None)
    if not root:
        if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="strandline-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(root)
        spark._strandline_checkpoint_root = root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared root for one intermediate table."""
    return f"{checkpoint_root(spark)}/strandline/{label}-{uuid.uuid4().hex}"


def materialize(df, label: str):
    """Cut lineage by writing ``df`` once to the shared folder and reading it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_once(spark: SparkSession, *jobs: Callable) -> None:
    """Run jobs that do not need each other at the same time; all have ended when the first failure is raised."""
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for job in running:
        job.result()


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(stage: Callable, rows: int = 1_000) -> Callable:
    """``stage``, whose tasks hand Python at most ``rows`` rows of a table at a time; 10,000 long texts or sets are held several times over."""

    def run(df):
        conf = df.sparkSession.conf
        before = conf.get(ARROW_ROWS)
        conf.set(ARROW_ROWS, str(min(rows, int(before)) if int(before) > 0 else rows))
        try:
            return stage(df)
        finally:
            conf.set(ARROW_ROWS, before)

    return run


def spread(scan):
    """Round-robin a table scan that has fewer splits than the cluster has cores.

    For scans feeding costly per-row work (hashing, audio). A table of many files
    already has more splits than cores and is returned as it is, unshuffled. Only
    for plain scans: asking a plan with shuffles for its partitions would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
