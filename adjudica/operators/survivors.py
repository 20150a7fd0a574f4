"""Which of several duplicates stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _with_group(df: DataFrame, group: list[str], *facts: Column) -> DataFrame:
    """df with aggregates of its groups: partial sums meet the rows by a join, so no window holds a large group."""
    found = df.groupBy(*[F.col(g).alias(f"_g_{g}") for g in group]).agg(*facts)
    on = F.lit(True)
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return df.join(found, on).drop(*[f"_g_{g}" for g in group])


def newest_wins(df: DataFrame, group: list[str], stamp: str, uid: str) -> DataFrame:
    """Adds decision, reason and kept_uid (L3): the newest of a group of exact copies stays, the older ones go.

    A group with a missing stamp, or with equal stamps, is undecidable: decision is null, the reason says why.
    """
    distinct = F.count_distinct(stamp).alias("_distinct")
    out = _with_group(df, group, F.count("*").alias("_n"), F.count(stamp).alias("_known"), distinct, F.max(F.struct(F.col(stamp), F.col(uid)))[uid].alias("_top"))
    open_ = F.when(F.col("_known") < F.col("_n"), "timestamp_missing").when(F.col("_distinct") < F.col("_n"), "timestamp_tie")
    newest = F.col(uid) == F.col("_top")
    out = out.withColumn("_open", F.when(F.col("_n") > 1, open_))
    reason = F.when(F.col("_n") == 1, "single").when(F.col("_open").isNotNull(), F.col("_open")).when(newest, "newest_of_exact_duplicate_group").otherwise("older_exact_duplicate")
    decision = F.when(F.col("_open").isNull(), F.when(newest, "keep").otherwise("exclude"))
    kept = F.when(F.col("_open").isNull(), F.col("_top"))
    return out.withColumn("reason", reason).withColumn("decision", decision).withColumn("kept_uid", kept).drop("_n", "_known", "_distinct", "_top", "_open")


def survivor(df: DataFrame, group: list[str], stamp: str, export: str, uid: str) -> DataFrame:
    """Adds outcome and survivor (T1): all stamps distinct, the newest; any tie, the oldest export decides.

    A missing stamp or, where it is asked, export is timestamp_missing, equal exports are timestamp_tie; both decide nothing.
    """
    facts = [F.count("*").alias("_n")]
    for c, best in ((stamp, F.max), (export, F.min)):
        facts += [F.count(c).alias(f"_known_{c}"), F.count_distinct(c).alias(f"_distinct_{c}"), best(F.struct(F.col(c), F.col(uid)))[uid].alias(f"_best_{c}")]
    out = _with_group(df, group, *facts)
    n = F.col("_n")
    outcome = (
        F.when(F.col(f"_known_{stamp}") < n, "timestamp_missing").when(F.col(f"_distinct_{stamp}") == n, "newest")
        .when(F.col(f"_known_{export}") < n, "timestamp_missing").when(F.col(f"_distinct_{export}") < n, "timestamp_tie").otherwise("oldest_export")
    )
    out = out.withColumn("outcome", outcome)
    kept = F.when(F.col("outcome") == "newest", F.col(f"_best_{stamp}")).when(F.col("outcome") == "oldest_export", F.col(f"_best_{export}"))
    return out.withColumn("survivor", kept).drop("_n", *[f"_{x}_{c}" for x in ("known", "distinct", "best") for c in (stamp, export)])


def winner(df: DataFrame, path: str, has_kept: str, stamp: str, dataset: str, ties: list[str] = ()) -> DataFrame:
    """Adds is_winner, group_size and reason (T2, T3): of one path, an image with kept annotations, the newest export, the first dataset.

    Only rows alike in all of these and in `ties` meet in a window, as one of them wins; groups of a path meet by partial aggregates.
    """
    least = F.struct(F.col(dataset).alias("d"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(ties)])
    best = F.struct(F.col(has_kept).alias("k"), F.col(stamp).alias("s"))
    level = df.groupBy(F.col(path).alias("_p"), best.alias("_b")).agg(F.min(least).alias("_l"), F.count("*").alias("_n"))
    kept = F.col("_b.k").cast("int")
    found = level.groupBy("_p").agg(F.max("_b").alias("_b"), F.max_by("_l", "_b").alias("_l"), F.sum("_n").alias("group_size"), F.max(kept).alias("_any"), F.min(kept).alias("_all"))
    j = df.join(found, F.col(path).eqNullSafe(F.col("_p")))
    reason = F.when(F.col("group_size") == 1, "unique").when(F.col("_any") != F.col("_all"), "annotated_preferred").when(F.col("_any") == 1, "both_annotated").otherwise("none_annotated")
    first = best.eqNullSafe(F.col("_b")) & least.eqNullSafe(F.col("_l"))
    # of rows alike in all that decides, any one wins; all others are spread over windows of their own
    alone = F.when(first, 0).otherwise(F.xxhash64(*[F.col(c) for c in (stamp, dataset, *ties)]))
    place = F.row_number().over(Window.partitionBy(path, first, alone).orderBy(F.lit(0)))
    return j.select(*df.columns, (first & (place == 1)).alias("is_winner"), "group_size", reason.alias("reason"))


def fill_kept(df: DataFrame, group: str, decision: str, uid: str, kept: str) -> DataFrame:
    """Fills a null kept uid (L2): where exactly one of a group is kept, that one; rows without group stay as they are, and meet nothing."""
    one = df.filter(F.col(group).isNotNull() & (F.col(decision) == "keep")).groupBy(F.col(group).alias("_group")).agg(F.count("*").alias("_n"), F.max(uid).alias("_one")).filter("_n = 1")
    asked = df.filter(F.col(group).isNotNull() & F.col(kept).isNull()).join(one, F.col(group) == F.col("_group"), "left").withColumn(kept, F.col("_one").cast(df.schema[kept].dataType))
    return asked.select(*df.columns).unionByName(df.filter(F.col(group).isNull() | F.col(kept).isNotNull()))


def merged_automatic(df: DataFrame, uid: str, decision: str, source_ord: str) -> DataFrame:
    """One row for each uid (L5): the first source's, unless a later one excludes and it does not."""
    late = F.coalesce(F.col(decision) != "exclude", F.lit(True))
    return df.groupBy(F.col(uid).alias("_uid")).agg(F.min_by(F.struct(*df.columns), F.struct(late, F.col(source_ord))).alias("_v")).select("_v.*")


def size_then_hash(df: DataFrame, size: str, content: Column, uid: str) -> DataFrame:
    """uid, digest and group_size of exact copies (J19): only contents of equal size are hashed."""
    same = df.groupBy(size).agg(F.count("*").alias("_n")).filter("_n > 1").select(F.col(size).alias("_size"))
    hashed = df.join(same, F.col(size) == F.col("_size")).select(uid, F.sha2(content, 256).alias("digest"))
    groups = hashed.groupBy("digest").agg(F.count("*").alias("group_size")).filter("group_size > 1")
    return hashed.join(groups, "digest").select(uid, "digest", "group_size")
