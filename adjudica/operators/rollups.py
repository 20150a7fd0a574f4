"""Aggregations of issues, decisions and cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEVERITIES = ("info", "warning", "error", "critical")


def dimension_counts(df: DataFrame, dims: list[str]) -> DataFrame:
    """dimension, value and n: a count by each of several columns in one pass."""
    sets = df.select(*dims).groupingSets([[d] for d in dims], *dims).agg(F.count("*").alias("n"), F.grouping_id().alias("_g"))
    which = value = None
    for i, d in enumerate(dims):
        here = F.col("_g") == (2 ** len(dims) - 1 - 2 ** (len(dims) - 1 - i))
        which = F.when(here, d) if which is None else which.when(here, d)
        value = F.when(here, F.col(d).cast("string")) if value is None else value.when(here, F.col(d).cast("string"))
    return sets.select(which.alias("dimension"), value.alias("value"), "n")


def distinct_levels(df: DataFrame, levels: dict[str, list[str]], by: list[str] = (), total: bool = False) -> DataFrame:
    """Distinct counts at each level of a hierarchy (A3, A5, A19, A21), by group and, if asked, over all."""
    aggs = [F.count_distinct(F.when(F.greatest(*[F.col(c).isNotNull() for c in keys]) if len(keys) > 1 else F.col(keys[0]).isNotNull(), F.struct(*keys))).alias(name) for name, keys in levels.items()]
    if total and by:
        return df.groupingSets([list(by), []], *by).agg(*aggs)
    return df.groupBy(*by).agg(*aggs)


def severity_rank(severity: Column) -> Column:
    return F.coalesce(F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), severity), F.lit(0)).cast("int")


def issue_rollup(issues: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each entity that has issues.

    n_issues, max_severity (or none) and detected_checks are of checked issues only; unverified_checks are those that
    could not be determined; what does not apply counts nowhere. Check ids come in first-seen order, the registry's.
    duplicate_group_id and related_uid, where issues have them, are the first ones seen of any status.
    """
    checked, open_ = F.col("status") == "checked", F.col("status") == "cannot_determine"
    seen = lambda test: F.array_join(F.transform(F.array_sort(F.collect_set(F.when(test, F.struct("check_ord", "check_id")))), lambda x: x["check_id"]), "|")
    named = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("none")).alias(c)
    firsts = [c for c in ("duplicate_group_id", "related_uid") if c in issues.columns]
    out = issues.groupBy(*keys).agg(
        F.count_if(checked).alias("n_issues"), F.bool_or("review_required").alias("needs_review"), F.max(F.when(checked, severity_rank(F.col("severity")))).alias("_s"),
        seen(checked).alias("detected_checks"), seen(open_).alias("unverified_checks"), *[F.min(F.when(F.col(c).isNotNull(), F.struct("check_ord", c)))[c].alias(c) for c in firsts],
    )
    names = F.array(*[F.lit(s) for s in SEVERITIES])
    worst = F.when(F.col("_s") > 0, F.element_at(names, F.col("_s"))).otherwise("none")
    return out.select(*keys, "n_issues", "needs_review", worst.alias("max_severity"), named("detected_checks"), named("unverified_checks"), *firsts)


def precision(hits: DataFrame, check: str, uid: str, decision: str) -> DataFrame:
    """Of distinct annotations that a check detected: how many were excluded, kept, uncertain, and the share excluded."""
    one = hits.select(check, uid, decision).distinct()
    out = one.groupBy(check).agg(F.count("*").alias("detected"), *[F.count_if(F.col(decision) == d).alias(n) for d, n in (("exclude", "excluded"), ("keep", "kept"), ("uncertain", "uncertain"))])
    return out.withColumn("precision", F.try_divide(F.col("excluded").cast("double"), (F.col("excluded") + F.col("kept") + F.col("uncertain")).cast("double")))


def top_and_other(df: DataFrame, key: str, k: int, other: str = "other") -> DataFrame:
    """The k most frequent values, ties by value, and one row for the rest."""
    counts = df.groupBy(F.col(key).cast("string").alias(key)).agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), key).limit(k).select(F.col(key).alias("_top"))
    label = F.when(F.col("_top").isNotNull(), F.col(key)).otherwise(F.lit(other))
    return counts.join(F.broadcast(top), F.col(key) == F.col("_top"), "left").groupBy(label.alias(key)).agg(F.sum("n").alias("n"))


def log_histogram(df: DataFrame, value: str, per_decade: int = 4) -> DataFrame:
    """bin and n of positive values, so many bins to a decade."""
    return df.filter(F.col(value) > 0).groupBy(F.floor(F.log10(F.col(value).cast("double")) * per_decade).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def upper_median(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """The middle value, of two the upper one, of each group (A28): by counts of values, so that no group is sorted in one task."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*by)
    running = counts.withColumn("_upto", F.sum("_n").over(w.orderBy(value))).withColumn("_all", F.sum("_n").over(w))
    return running.filter(F.col("_upto") > F.floor(F.col("_all") / 2)).groupBy(*by).agg(F.min(value).alias("median"))


def width_buckets(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """bucket (the index of its lower edge, -1 below all) and n; buckets hold their lower edge."""
    out = F.lit(-1)
    for i, e in enumerate(edges):
        out = F.when(F.col(value) >= e, i).otherwise(out)
    return df.filter(F.col(value).isNotNull()).groupBy(out.alias("bucket")).agg(F.count("*").alias("n"))


def spot_sample(df: DataFrame, buckets: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each bucket (T4); the same ones on every run."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*buckets).orderBy(*order))).filter(F.col("_r") <= n).drop("_r")


def ordinals(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Adds index (from 0) and count of a row in its group (SC9)."""
    w = Window.partitionBy(*group)
    return df.withColumn("index", (F.row_number().over(w.orderBy(*order)) - 1).cast("long")).withColumn("count", F.count("*").over(w))


def null_census(df: DataFrame, columns: list[str], empty: dict[str, Column] | None = None) -> DataFrame:
    """column and nulls (A22); empty tells what else counts as null of a column."""
    tests = {c: (empty or {}).get(c, F.lit(False)) | F.col(c).isNull() for c in columns}
    one = df.agg(*[F.count_if(t).alias(c) for c, t in tests.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns])).alias("x")).select("x.*")


def ambiguous(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one value, and how many."""
    return df.groupBy(key).agg(F.count_distinct(value).alias("n")).filter("n > 1")


def reused(df: DataFrame, uid: str, dataset: str) -> DataFrame:
    """datasets (sorted, joined by |) that share identities, and how many they share."""
    sets = df.groupBy(uid).agg(F.array_sort(F.collect_set(dataset)).alias("s")).filter(F.size("s") > 1)
    return sets.groupBy(F.array_join(F.transform("s", lambda x: x.cast("string")), "|").alias("datasets")).agg(F.count("*").alias("n"))


def significant(value: Column, digits: int = 4) -> Column:
    """value to so many significant digits, half to even; from 1000 on whole numbers."""
    size = F.floor(F.log10(F.abs(value)))
    out = F.bround(value, 0)
    for power in range(digits - 2, -13, -1):
        out = F.when(size == power, F.bround(value, digits - 1 - power)).otherwise(out)
    return F.when(value == 0, F.lit(0.0)).when(value.isNotNull(), out)


def summary_delta(now: DataFrame, before: DataFrame, key: str, count: str = "n") -> DataFrame:
    """key, before, now and delta of two summaries."""
    b = before.select(F.col(key).alias("_k"), F.col(count).alias("_b"))
    j = now.select(key, F.col(count).alias("_n")).join(b, F.col(key) == F.col("_k"), "full_outer")
    return j.select(F.coalesce(key, "_k").alias(key), F.coalesce("_b", F.lit(0)).alias("before"), F.coalesce("_n", F.lit(0)).alias("now"), (F.coalesce("_n", F.lit(0)) - F.coalesce("_b", F.lit(0))).alias("delta"))


def exploded_reasons(df: DataFrame, column: str, none: str = "none") -> DataFrame:
    """reason and n of a pipe-joined column."""
    one = df.select(F.explode(F.split(F.coalesce(column, F.lit("")), r"\|")).alias("reason"))
    return one.filter((F.col("reason") != "") & (F.col("reason") != none)).groupBy("reason").agg(F.count("*").alias("n"))


def vocabulary_ordered(tags: Column, vocabulary: list[str]) -> Column:
    """The tags that the vocabulary knows, in its order, pipe-joined; none if there are none."""
    known = F.filter(F.array(*[F.lit(v) for v in vocabulary]), lambda v: F.coalesce(F.array_contains(tags, v), F.lit(False)))
    return F.coalesce(F.nullif(F.array_join(known, "|"), F.lit("")), F.lit("none"))


def counted_once(df: DataFrame, uid: str, order: list[str], levels: list[str]) -> DataFrame:
    """n, the rows of different uid, and distinct levels of the first row of each uid by order."""
    first = df.groupBy(uid).agg(F.min_by(F.struct(*levels), F.struct(*order)).alias("x"))
    return first.agg(F.count("*").alias("n"), *[F.count_distinct(f"x.{c}").alias(c) for c in levels])


def counts_by_type(df: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """counts, a map of kinds to numbers of rows by key (A35); one entry a kind, its keys sorted."""
    n = df.groupBy(*keys, kind).agg(F.count("*").alias("_n"))
    return n.filter(F.col(kind).isNotNull()).groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(kind, "_n")))).alias("counts"))


def automatic_summary(decisions: DataFrame, undecidable: DataFrame) -> DataFrame:
    """One row (A36): automatic exclusions and keeps, groups (one keep each), and what neither rule decides."""
    d = F.col("decision")
    one = decisions.agg(F.count_if(d == "exclude").alias("automatic_exclude"), F.count_if(d == "keep").alias("automatic_keep"), F.count_if(d == "keep").alias("duplicate_groups"))
    return one.crossJoin(undecidable.agg(F.count("*").alias("undecidable")))  # two tables of one row
