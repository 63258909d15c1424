"""Session helpers: the shared folder, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
BROADCAST_LIMIT = 64 * 1024 * 1024


def local_session(app: str = "tidemark", cores: str = "8") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: an explicit checkpoint folder, else the one the session names.

    Where there is neither, a temporary folder stands in on a single machine (tests, a laptop); on a
    cluster each executor would write to its own disk, so that is an error.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder
    if not context.master.startswith("local[") and context.master != "local":
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark).rstrip("/"), "tidemark", f"{label}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut the lineage by writing to the shared folder; the copy outlives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """The optimiser's size estimate for a plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only when the estimate is under `limit`.

    Beyond it the frame comes back unhinted, so the join shuffles and the
    adaptive planner splits skewed partitions.
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit else df
