"""Incremental ingestion: verdicts that arrive as files are merged into a store, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.operators.merges import upsert, without_conflicts
from adjudica.schema import VERDICT_DDL

KEYS = ["kind", "dataset_id", "key"]


def merge_stream(spark: SparkSession, incoming: str, store: str, checkpoint: str, once: bool = True):
    """Reads JSON lines of verdicts from a folder as they come and upserts them; returns the running query.

    Each batch writes a version of its own, store/v=<batch>, from the one before: a batch that is repeated after a
    failure writes the same version again, so verdicts count once. A conflict that no stamp decides stops the query and its batch is not written. Within a batch the latest verdict of a key counts.
    """
    stream = spark.readStream.schema(VERDICT_DDL).json(incoming)

    def batch(df: DataFrame, number: int) -> None:
        value = [c for c in df.columns if c not in KEYS]
        latest = df.groupBy(*KEYS).agg(F.max_by(F.struct(*value), F.struct(F.col("reviewed_at"), F.col("decision"))).alias("v")).select(*KEYS, *[F.col(f"v.{c}").alias(c) for c in value])
        before = current(spark, store, number)
        out = latest if before is None else without_conflicts(upsert(before, latest, KEYS, "decision", "reviewed_at"), KEYS)
        out.write.mode("overwrite").parquet(f"{store}/v={number}")

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def current(spark: SparkSession, store: str, below: int | None = None) -> DataFrame | None:
    """The newest version of a store, or the newest before a batch; None if there is none."""
    jvm = spark._jvm.org.apache.hadoop.fs
    path = jvm.Path(store)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    found = [int(s.getPath().getName()[2:]) for s in fs.listStatus(path) if s.getPath().getName().startswith("v=") and fs.exists(jvm.Path(s.getPath(), "_SUCCESS"))]
    found = [v for v in found if below is None or v < below]
    return spark.read.parquet(f"{store}/v={max(found)}") if found else None
