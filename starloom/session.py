"""Session helpers: builder with the settings the jobs assume, and reliable
materialization for frames that several jobs read."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Settings the jobs are written for. AQE re-plans joins from real sizes and
# splits skewed partitions (hot keys, NULL lookup keys); dynamic partition
# overwrite keeps partitioned publishes to the partitions written.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Remove reliable checkpoints once their DataFrames are gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", app: str = "starloom",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory the cluster names in
    ``spark.checkpoint.dir``. Only when it is unset (local tests) is a
    private temporary directory chosen."""
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session manages its own directory
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="starloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint so later jobs read the same
    rows even if executors are lost (never a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def driver_heap(spark: SparkSession) -> int | None:
    """Most bytes of the driver's heap (None in a remote session, which does not see it)."""
    try:
        return int(spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory())
    except Exception:
        return None


def run_concurrently(tasks: dict[str, Callable[[], T]], max_workers: int | None = None) -> dict[str, T]:
    """Run independent driver-side steps (each may start Spark jobs) from a
    thread pool, so their jobs share the cluster instead of queueing one after
    another. Exceptions propagate; results keep the input order."""
    if len(tasks) <= 1:
        return {name: fn() for name, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=max_workers or len(tasks)) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: fut.result() for name, fut in futures.items()}
