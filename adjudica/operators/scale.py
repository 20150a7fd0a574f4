"""Joins and numbers that no single task holds: hot keys are split, orders are numbered by ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adjudica.storage import written

#: A key is hot that holds more than one of so many parts of all rows: there are fewer hot keys than this.
HOT = 1000


def skew_join(rows: DataFrame, facts: DataFrame, key: str, count: str, total: int, spread: str, how: str = "inner") -> DataFrame:
    """rows with the columns of facts, which have rows for each key and in `count` how many of the `total` rows have it.

    A hot key's rows are split by a hash of the column `spread`, and its facts are repeated for each part, so no part has
    more than a HOT-th of all rows; rows without key are split too. What is broadcast are the names of hot keys: fewer
    than HOT of them, at every size.
    """
    hot = facts.filter(F.col(count) * HOT > total).select(F.col(key).alias("_hot"), F.ceil(F.col(count) * HOT / F.lit(max(total, 1))).cast("int").alias("_parts")).distinct()
    some = lambda n: F.pmod(F.xxhash64(spread), n).cast("int")
    part = F.when(F.col("_parts").isNotNull(), some(F.col("_parts"))).when(F.col(key).isNull(), some(F.lit(HOT))).otherwise(0)
    left = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn("_join_part", part).drop("_hot", "_parts")
    right = facts.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn("_join_split", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
    right = right.select(F.col(key).alias("_join_key"), "_join_split", *[c for c in facts.columns if c not in (key, count)])
    return left.join(right.hint("merge"), (F.col(key) == F.col("_join_key")) & (F.col("_join_part") == F.col("_join_split")), how).drop("_join_key", "_join_part", "_join_split")


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds name, the place of a row in the order, from 0: ranges are sorted by themselves and start after those before."""
    sorted_parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(sorted_parts.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at")), "ranges")
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_n"))  # a row for each range
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(F.col("_range").alias("_of"), before.alias("_start"))
    at = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_start")  # the lower bits of _at count inside a range
    return placed.join(F.broadcast(starts), F.col("_range") == F.col("_of")).withColumn(name, at).drop("_range", "_at", "_of", "_start")


def numbered_within(df: DataFrame, group: str, name: str) -> DataFrame:
    """Adds name, a number from 0 for each row of a group, null being one, in no particular order: parts count by themselves and start after those before."""
    placed = df.sortWithinPartitions(group).select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at"))
    placed = written(placed, "places")
    parts = placed.groupBy(F.col(group).alias("_group"), F.col("_range").alias("_of")).agg(F.min("_at").alias("_low"), F.count("*").alias("_n"))  # a row for each group and part
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_group").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select("_group", "_of", (before - F.col("_low")).alias("_start"))
    on = (F.col("_range") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group"))
    return placed.join(starts, on).withColumn(name, F.col("_at") + F.col("_start")).drop("_range", "_at", "_group", "_of", "_start")
