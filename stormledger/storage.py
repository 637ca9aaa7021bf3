"""Where jobs keep durable intermediate data: the folder the cluster names."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Only a local session without one gets a temporary folder of its own; on a cluster
    a machine-local folder would be lost with its machine, so that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="stormledger-"))
    return context.getCheckpointDir()


def run_folder(spark: SparkSession) -> str:
    """Where everything lies that this application writes for itself."""
    return f"{shared_dir(spark)}/stormledger/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the run's folder."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_run_folder(spark: SparkSession) -> None:
    """Delete the run's intermediate tables, once no frame that reads them is needed."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def durable(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Every later read then sees the same rows, even after executors are lost or the
    cluster has changed its size. As a Parquet table it is read by column, and its size
    is known to the optimizer.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def workers_find_package(spark: SparkSession) -> None:
    """Tell Python workers where this package lies, whatever their folder."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
