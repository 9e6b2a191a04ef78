"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER = "spark.meterwatch.local.dir"


def build_session(app: str = "meterwatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (AQE on, UTC)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A new folder for this call under the cluster's ``spark.checkpoint.dir``.

    Where that is unset, the folder that ``use_folder`` named is taken. Only with a
    local master a temporary folder is made instead; on a cluster every executor
    would write to its own disk, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(FOLDER, None)
    if not base:
        if not spark.conf.get("spark.master", "local").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="meterwatch-")
        spark.conf.set(FOLDER, base)
    return os.path.join(base, f"stage-{uuid.uuid4().hex}")


def use_folder(spark: SparkSession, path: str) -> None:
    """Where intermediate tables go if the cluster names no ``spark.checkpoint.dir``."""
    spark.conf.set(FOLDER, path)


def persist_table(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage and fixes values that depend on the physical layout
    (partition number, position); the files outlive a lost executor.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of input that a task of ``spread`` is given at most.
SPREAD_BYTES = 64 << 20


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition on ``keys`` for work that is heavy per row.

    Adaptive execution joins small partitions by their bytes, which would leave
    most cores idle, but keeps a partition number that was asked for. The number
    follows the size of the tables that ``df`` is made from, and is never below
    what the session is set for.
    """
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    if size < 1 << 60:  # beyond: a source that does not know its size
        tasks = max(tasks, -(-size // SPREAD_BYTES))
    return df.repartition(tasks, *keys)
