"""Gates that a table passes while it is written (L8, L14, L15, V7): counted in the writing pass, and a version is only visible if all are passed.

A version is a folder below a store; current.json names the visible one and replaces the one before by a rename. A failed or a killed
run leaves a folder that nothing names.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass
class Gate:
    """What may not be, in how many rows at most, and what allows it."""

    name: str
    count: Column  # an aggregate
    most: int = 0
    allowed: bool = False


class GateError(ValueError):
    """Gates that were not passed: name to count."""

    def __init__(self, failed: dict[str, int]):
        super().__init__("; ".join(f"{n} {name}" for name, n in sorted(failed.items())))
        self.failed = failed


def count_of(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm.org.apache.hadoop.fs
    return jvm, jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def write_gated(df: DataFrame, store: str, gates: list[Gate], note: dict | None = None) -> dict[str, int]:
    """Writes df as a version of the store and makes it the visible one if all gates are passed, else raises GateError; the counts.

    The counts are observed by the job that writes: the table is not read a second time.
    """
    spark = df.sparkSession
    seen = Observation(f"gates-{uuid.uuid4().hex}")
    version = f"v-{uuid.uuid4().hex}"
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[g.count.cast("long").alias(f"g{k}") for k, g in enumerate(gates)]).write.parquet(f"{store}/{version}")
    found = seen.get
    counts = {g.name: int(found[f"g{k}"] or 0) for k, g in enumerate(gates)}
    failed = {g.name: counts[g.name] for g in gates if counts[g.name] > g.most and not g.allowed}
    if failed:
        raise GateError(failed)
    jvm, fs = _fs(spark, store)
    part, name = jvm.Path(f"{store}/.{version}.json"), jvm.Path(f"{store}/current.json")
    out = fs.create(part, True)
    out.write(bytearray(json.dumps({"version": version, "rows": int(found["rows"]), "gates": counts, "note": note or {}}, sort_keys=True).encode()))
    out.close()
    # a rename over an existing file is one step in the context of files, where it replaces
    context = jvm.FileContext.getFileContext(part.toUri() if part.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(part), fs.makeQualified(name), options)
    return counts | {"rows": int(found["rows"])}


def manifest(spark: SparkSession, store: str) -> dict | None:
    """What current.json says; None before the first version."""
    jvm, fs = _fs(spark, store)
    if not fs.exists(jvm.Path(f"{store}/current.json")):
        return None
    return json.loads(spark.read.text(f"{store}/current.json", wholetext=True).first()[0])


def read_visible(spark: SparkSession, store: str) -> DataFrame | None:
    """The rows of the visible version."""
    found = manifest(spark, store)
    return spark.read.parquet(f"{store}/{found['version']}") if found else None
