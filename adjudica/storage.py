"""Tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a folder of our own if the master is local, and an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="adjudica-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, below one of this application's own that can be removed when it has ended."""
    return f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}-{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: df as a Parquet table in the shared folder, read back. A lost executor costs nothing then."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
