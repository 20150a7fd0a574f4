"""Trees of any shape as VARIANT columns (U2, U9, V4, S27): values that are missing, null and empty are three states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.storage import written

#: Levels of a tree that are walked at most; a deeper one is an error.
MAX_DEPTH = 40


def state(value: Column) -> Column:
    """missing, null, empty (a text, list or object without content) or value."""
    kind = F.schema_of_variant(value)
    empty = ((kind == "STRING") & (F.try_variant_get(value, "$", "string") == "")) | kind.isin("OBJECT<>", "ARRAY<>", "ARRAY<VOID>") & (F.to_json(value).isin("{}", "[]"))
    return F.when(value.isNull(), "missing").when(F.is_variant_null(value), "null").when(F.coalesce(empty, F.lit(False)), "empty").otherwise("value")


def kind(value: Column) -> Column:
    """object, array, null, text, number or boolean."""
    of = F.schema_of_variant(value)
    return F.when(of.startswith("OBJECT"), "object").when(of.startswith("ARRAY"), "array").when(of == "VOID", "null").when(of == "STRING", "text").when(of == "BOOLEAN", "boolean").otherwise("number")


def leaves(trees: DataFrame, key: list[str], tree: str) -> DataFrame:
    """key, path, kind and value (JSON text) of every leaf of each tree: all but objects and arrays with content.

    A path has a step a level, names quoted as JSON and places as numbers. One pass for each level of the deepest tree; each takes apart what is
    left with variant_explode. A tree that is missing has no leaf; one that is null, or empty, is a leaf at the empty path.
    """
    spark = trees.sparkSession
    left = trees.filter(F.col(tree).isNotNull()).select(*key, F.lit("").alias("path"), F.col(tree).alias("v"))
    left = left.withColumns({"kind": kind(F.col("v")), "value": F.to_json("v")})
    inner = F.col("kind").isin("object", "array") & ~F.col("value").isin("{}", "[]")
    found, depth = None, 0
    while True:
        left = written(left, "tree-level")
        done = left.filter(~inner).select(*key, "path", "kind", "value")
        found = done if found is None else found.unionByName(done)
        todo = left.filter(inner)
        if not todo.limit(1).count():
            return found
        depth += 1
        if depth > MAX_DEPTH:
            raise ValueError("trees are deeper than can be")
        parts = todo.drop("value", "kind").lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).select(F.col("pos").alias("_pos"), F.col("key").alias("_key"), F.col("value").alias("_v")))
        step = F.coalesce(F.to_json(F.array("_key")), F.concat(F.lit("["), F.col("_pos").cast("string"), F.lit("]")))
        step = F.when(F.col("_key").isNull(), F.concat(F.lit("["), F.col("_pos").cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("."), F.substring(step, F.lit(2), F.length(step) - 2)))
        left = parts.select(*key, F.concat("path", step).alias("path"), F.col("_v").alias("v")).withColumns({"kind": kind(F.col("v")), "value": F.to_json("v")})


def differences(left: DataFrame, right: DataFrame, key: list[str], tree: str) -> DataFrame:
    """key, path, left and right of leaves that two tables of trees don't share: what one lacks is null there, a null value is the text null."""
    a = leaves(left, key, tree).select(*key, "path", F.col("value").alias("left"))
    b = leaves(right, key, tree).select(*key, "path", F.col("value").alias("right"))
    both = a.join(b, [*key, "path"], "full_outer")
    return both.filter(~F.col("left").eqNullSafe(F.col("right")))


def merged(base: DataFrame, over: DataFrame, key: list[str], tree: str) -> DataFrame:
    """key, path, value and conflict: the leaves of both (U2). A leaf that only one has is taken; where values differ the base's stays, and it is a conflict.

    A missing leaf never removes one; a null is a value of its own.
    """
    a = leaves(base, key, tree).select(*key, "path", F.col("value").alias("_a"))
    b = leaves(over, key, tree).select(*key, "path", F.col("value").alias("_b"))
    both = a.join(b, [*key, "path"], "full_outer")
    return both.select(*key, "path", F.coalesce("_a", "_b").alias("value"), (F.col("_a").isNotNull() & F.col("_b").isNotNull() & (F.col("_a") != F.col("_b"))).alias("conflict"))
