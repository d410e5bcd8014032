"""Reliable lineage cuts for iterative plans."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use ``spark.checkpoint.dir``; else the warehouse on a cluster, a temporary folder locally."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        local = sc.master == "local" or sc.master.startswith("local[")
        named = tempfile.mkdtemp(prefix="transpark-") if local else spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"
    sc.setCheckpointDir(named)


def materialise(df: DataFrame) -> DataFrame:
    """A checkpointed copy that survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once as a table in the shared folder and read from there."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_by_value(module_name: str) -> None:
    """Send a module's kernels to the workers by value, so that they need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
