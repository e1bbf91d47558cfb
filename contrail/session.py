"""Session helpers: recommended settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# What the jobs are tuned for. AQE picks broadcast joins from measured sizes, splits skewed
# sort-merge joins and sizes the reducers, so the shuffle partition count is only an upper bound.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the split costs one more shuffle above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def local_session(cores: str | int = 8, app: str = "contrail") -> SparkSession:
    """A one-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        # Small test data still uses every core.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.driver.memory", "8g")
        # No call-site capture per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.log.level", "ERROR")
    )
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` that every executor can reach.

    Only a local session may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="contrail-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable; the cluster's own folder always wins."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark, "checkpoints"))


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """A typed frame without rows that the optimizer knows to be empty."""
    return spark.range(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema)).limit(0)
