"""Session and checkpoint helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tabprep", cpus: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster pass your own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking `spark.checkpoint.dir` from the session.

    A folder of our own is made only in local mode with nothing configured; a cluster must name a shared one.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="tabprep-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def run_together(spark: SparkSession, *queries: Callable[[], object]) -> list:
    """Submit independent report queries at once, so that one's last tasks do not keep the cluster waiting."""
    with ThreadPoolExecutor(max_workers=len(queries)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(q)) for q in queries]]


_tables: list[str] = []


def remove_tables(spark: SparkSession) -> int:
    """Delete the tables that `materialise` has written in this process; results that still read them are lost."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    removed = 0
    while _tables:
        path = jvm.org.apache.hadoop.fs.Path(_tables.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` as a Parquet table below the checkpoint folder and read on from there.

    Cuts the lineage like a checkpoint, so lost executors recompute nothing before it, but stays columnar: later scans
    read only the columns they use, and the planner knows the table's size.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _tables.append(path)
    return spark.read.schema(df.schema).parquet(path)
