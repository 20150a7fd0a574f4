"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adjudica.storage import scratch_path, written

__all__ = ["ARROW_ROWS", "SPACE", "WORD", "bucket_digits", "columns_of", "hash_key", "packed", "prefix_sums", "repeated", "scratch_path", "ship", "small_batches", "written"]

#: White space that separates words in every word count here (fixed by the query contracts).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"

#: Rows in an Arrow batch: a batch of whole texts must fit in a Python worker.
ARROW_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Before Python code over whole texts: workers get this package, and Arrow batches stay small.

    A session that asks for still smaller batches keeps them.
    """
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def hash_key(seed: str, *cols: Column) -> Column:
    """A uniform key of 32 hex digits that any engine with md5 can reproduce; nulls count as empty."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("|", F.lit(seed), *parts).cast("binary"))


def bucket_digits(rows: int, per_bucket: int = 2_500) -> int:
    """How many hex digits give buckets of about per_bucket rows, at least 16 of them."""
    digits = 1
    while rows / 16**digits > per_bucket and digits < 12:
        digits += 1
    return digits


#: Hex digits that one window ranks: at most 16 ** LEVEL buckets are in a task.
LEVEL = 3


def prefix_sums(df: DataFrame, group: list[str], key: str, ties: list[str], values: dict[str, str], digits: int) -> DataFrame:
    """Exclusive prefix sums of columns inside each group, in the order of a uniform hash key.

    values maps new columns to the columns they sum. The leading digits of the key split every group into
    ordered buckets of bounded size, so that no task holds a group: a window sums inside each bucket, and
    the totals of the buckets (a small, pre-aggregated table) give each bucket its offset, LEVEL digits at a time. The
    buckets come from the key itself, so reruns agree.
    """
    df = df.withColumn("_bucket", F.substring(key, 1, digits))
    inside = Window.partitionBy(*group, "_bucket").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    part = df.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0).cast("long")).alias(f"_in_{k}") for k, v in values.items()])
    totals = df.groupBy(*group, "_bucket").agg(*[F.sum(v).cast("long").alias(k) for k, v in values.items()])
    joined = _with_offsets(part, _offsets(totals, group, list(values), digits), group, "_bucket", list(values))
    return joined.select(*[c for c in df.columns if c != "_bucket"], *[(F.col(f"_in_{k}") + F.col(f"_off_{k}")).alias(k) for k in values])


def _offsets(totals: DataFrame, group: list[str], values: list[str], digits: int) -> DataFrame:
    """_g_<group>, _b and _off_<value>: what comes before each bucket of its group."""
    upper = ["_upper"] if digits > LEVEL else []
    if upper:
        totals = totals.withColumn("_upper", F.substring("_bucket", 1, digits - LEVEL))
    before = Window.partitionBy(*group, *upper).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    out = totals.select("*", *[F.coalesce(F.sum(k).over(before), F.lit(0)).cast("long").alias(f"_here_{k}") for k in values])
    if upper:
        sums = totals.groupBy(*group, F.col("_upper").alias("_bucket")).agg(*[F.sum(k).cast("long").alias(k) for k in values])
        out = _with_offsets(out, _offsets(sums, group, values, digits - LEVEL), group, "_upper", values)
    off = [(F.col(f"_here_{k}") + (F.col(f"_off_{k}") if upper else F.lit(0))).alias(f"_off_{k}") for k in values]
    return out.select(*[F.col(g).alias(f"_g_{g}") for g in group], F.col("_bucket").alias("_b"), *off)


def _with_offsets(df: DataFrame, offsets: DataFrame, group: list[str], bucket: str, values: list[str]) -> DataFrame:
    on = F.col(bucket) == F.col("_b")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return df.join(offsets, on).drop("_b", *[f"_g_{g}" for g in group])


#: Rows that one row is repeated to at once.
REPEATED = 10_000


def repeated(units: DataFrame, count: str, name: str) -> DataFrame:
    """Each row as many times as its column `count` says, with its number from 0 in the column `name`.

    Rows that stand for many are split into blocks first, which tasks share: none makes a third of all rows.
    """
    last = F.col(count) - 1
    few = units.filter(F.col(count) <= REPEATED).withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), last)))
    blocks = units.filter(F.col(count) > REPEATED).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / REPEATED)))).repartition("_block")
    many = blocks.withColumn(name, F.explode(F.sequence(F.col("_block") * REPEATED, F.least(last, (F.col("_block") + 1) * REPEATED - 1)))).drop("_block")
    return few.unionByName(many)


def packed(df: DataFrame) -> DataFrame:
    """One column _row, a struct of all columns: nothing that is added beside it can clash with a name in it."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))


def columns_of(df: DataFrame, **new: Column) -> list[Column]:
    """The columns of df out of _row, some of them with new values."""
    return [new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in df.columns]


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python workers this package, for clusters where only the driver has it; once a session."""
    import os
    import zipfile

    context = spark.sparkContext
    if getattr(context, "_adjudica_shipped", False):
        return
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="adjudica-"), "adjudica.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("adjudica", os.path.relpath(full, home)))
    context.addPyFile(target)
    context._adjudica_shipped = True
