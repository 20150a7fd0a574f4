"""Contracts: tables of violations, empty where all is well, and a stop for those that must not pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, rules: dict[str, Column], keys: list[str]) -> DataFrame:
    """rule and keys of rows that break a rule (a condition that must hold); null does not hold."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()]))
    return df.select(*keys, F.explode(broken).alias("rule"))


def violation_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rule and n for every rule, zeros too, in one pass."""
    one = df.agg(*[F.count_if(~F.coalesce(test, F.lit(False))).alias(name) for name, test in rules.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"`{r}`").alias("n")) for r in rules])).alias("x")).select("x.*")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def key_sets_differ(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only, and which."""
    a, b = left.select(*keys).distinct(), right.select(*keys).distinct()
    return a.exceptAll(b).withColumn("side", F.lit("left")).union(b.exceptAll(a).withColumn("side", F.lit("right")))


def decision_rules() -> dict[str, Column]:
    """What holds of every row of the selection table (V1)."""
    d, s = F.col("decision"), F.col("review_status")
    return {
        "known_decision": d.isin("keep", "exclude", "pending", "uncertain"),
        "not_needed_is_final": (s != "not_needed") | d.isin("keep", "exclude"),
        "human_has_reviewer": (F.col("source") != "human") | (F.coalesce(F.col("reviewer"), F.lit("")) != ""),
        "unverified_has_checks": (F.col("reason") != "kept_without_full_check") | (F.col("unverified_checks") != "none"),
    }


def decision_contract(decisions: DataFrame, records: DataFrame, keys: list[str]) -> DataFrame:
    """rule and n of all that must hold of a selection table (V1), zeros too: as many rows as records, no key twice, the same
    keys, null being one, and the rules of every row. Both tables are counted by key, so they meet once."""
    rules = decision_rules()
    at = lambda df, side, *facts: df.groupBy(*[F.col(k).alias(f"{side}{k}") for k in keys]).agg(*facts)
    a = at(decisions, "_d_", F.count("*").alias("_d"), *[F.count_if(~F.coalesce(test, F.lit(False))).alias(f"_r_{name}") for name, test in rules.items()])
    b = at(records, "_i_", F.count("*").alias("_i"))
    j = a.join(b, reduce(lambda x, y: x & y, [F.col(f"_d_{k}").eqNullSafe(F.col(f"_i_{k}")) for k in keys]), "full_outer")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    found = {
        "row_count": F.abs(total("_d") - total("_i")), "duplicate_key": F.count_if(F.col("_d") > 1), "key_without_decision": F.count_if(F.col("_d").isNull()),
        "decision_without_key": F.count_if(F.col("_i").isNull()), **{name: total(f"_r_{name}") for name in rules},
    }
    one = j.agg(*[n.alias(rule) for rule, n in found.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("n")) for rule in found])))


def sample_rules(columns: list[str] | None = None) -> dict[str, Column]:
    """What holds of every exported sample (V3), of those of its columns that it has; a side needs a case."""
    three = lambda c: F.col(c).isin("present", "absent", "unknown")
    has = lambda c: columns is None or c in columns
    rules = {c: three(c) for c in ("abnormal_finding_status", "bulla_bleb_status", "pleural_effusion_status") if has(c)}
    side = F.col("pneumothorax_side")
    if has("pneumothorax_side"):
        rules["side_vocabulary"] = side.isNull() | side.isin("left", "right", "bilateral")
        if has("pneumothorax_case"):
            rules["side_needs_case"] = side.isNull() | F.col("pneumothorax_case")
    return rules


def image_violations(decisions: DataFrame, images: DataFrame, key: str = "file_uid") -> DataFrame:
    """key and rule (V2): images without a decision, decisions without an image, images with several."""
    n = decisions.groupBy(F.col(key).alias("_d")).agg(F.count("*").alias("_n"))
    j = images.select(key).distinct().withColumn("_i", F.lit(True)).join(n, F.col(key) == F.col("_d"), "full_outer")
    rule = F.when(F.col("_n").isNull(), "no_decision").when(F.col("_i").isNull(), "no_image").when(F.col("_n") > 1, "several_decisions")
    return j.select(F.coalesce(key, "_d").alias(key), rule.alias("rule")).filter("rule is not null")


def changed_sources(before: DataFrame, after: DataFrame, name: str = "path", digest: str = "sha256") -> DataFrame:
    """Sources whose contents changed or went while a build ran (V7); empty if all is well."""
    new = after.select(F.col(name).alias("_n"), F.col(digest).alias("_h"))
    return before.join(new, F.col(name) == F.col("_n"), "left").filter(~F.col(digest).eqNullSafe(F.col("_h"))).select(name, F.col(digest).alias("before"), F.col("_h").alias("after"))


def structure_diff(left: dict | DataFrame, right: dict | DataFrame) -> dict[str, list[str]]:
    """Keys that only one structure has, and those that differ."""
    of = lambda x: dict(x.dtypes) if isinstance(x, DataFrame) else x
    a, b = of(left), of(right)
    return {"only_left": sorted(a.keys() - b.keys()), "only_right": sorted(b.keys() - a.keys()), "differing": sorted(k for k in a.keys() & b.keys() if a[k] != b[k])}


def mismatches(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, field, left and right of common keys that differ (V5); two nulls are equal."""
    j = left.alias("l").join(right.alias("r"), F.col(f"l.{key}") == F.col(f"r.{key}"))
    parts = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"l.{f}").cast("string").alias("left"), F.col(f"r.{f}").cast("string").alias("right")) for f in fields])
    return j.select(F.col(f"l.{key}").alias(key), F.explode(F.filter(parts, lambda x: ~x["left"].eqNullSafe(x["right"]))).alias("x")).select(key, "x.*")


def format_rules() -> dict[str, Column]:
    """Rules of the interchange format."""
    return {"score_range": F.col("score").isNull() | F.col("score").between(0, 1), "positive_spacing": F.col("spacing_x").isNull() | ((F.col("spacing_x") > 0) & (F.col("spacing_y") > 0)), "has_id": F.col("sample_id").isNotNull()}


def require_none(df: DataFrame, what: str) -> None:
    """Stops if df has rows, and shows a few."""
    rows = df.limit(5).collect()
    if rows:
        raise ValueError(f"{what}: {[r.asDict() for r in rows]}")


def all_of(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
