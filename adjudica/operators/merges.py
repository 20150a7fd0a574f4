"""Merging trees, samples and verdict stores without losing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _same(a: str, b: str, keys: list[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return on


def upsert(base: DataFrame, incoming: DataFrame, keys: list[str], decision: str, stamp: str) -> DataFrame:
    """Merges two stores of one row a key (U1): action is kept, inserted, refreshed, replaced or conflict.

    Equal decisions keep the later stamp; of different ones the later stamp wins, as text; without two different
    stamps it is a conflict, and the base row stays. Nothing is ever deleted.
    """
    value = [c for c in base.columns if c not in keys]
    j = base.alias("b").withColumn("_in_b", F.lit(True)).alias("b").join(incoming.withColumn("_in_i", F.lit(True)).alias("i"), _same("b", "i", keys), "full_outer")
    has_b, has_i = F.coalesce(F.col("_in_b"), F.lit(False)), F.coalesce(F.col("_in_i"), F.lit(False))
    bs, is_ = F.col(f"b.{stamp}"), F.col(f"i.{stamp}")
    equal = F.col(f"b.{decision}").eqNullSafe(F.col(f"i.{decision}"))
    action = (
        F.when(~has_b, "inserted").when(~has_i, "kept")
        .when(equal, F.when(F.coalesce(is_ >= bs, is_.isNotNull()), "refreshed").otherwise("kept"))
        .when(bs.isNull() | is_.isNull() | (bs == is_), "conflict").when(is_ > bs, "replaced").otherwise("kept")
    )
    take = action.isin("inserted", "refreshed", "replaced")
    return j.select(*[F.when(has_b, F.col(f"b.{k}")).otherwise(F.col(f"i.{k}")).alias(k) for k in keys], *[F.when(take, F.col(f"i.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in value], action.alias("action"))


def without_conflicts(merged: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of upsert() without action; a conflict that no stamp decides stops the job, so nothing is written of it."""
    stop = F.raise_error(F.concat(F.lit("verdicts differ and no stamp decides: "), F.concat_ws("/", *[F.col(k).cast("string") for k in keys]))).cast("boolean")
    return merged.filter(F.when(F.col("action") == "conflict", stop).otherwise(F.lit(True))).drop("action")


def fold_stores(stores: list[DataFrame], keys: list[str], decision: str, stamp: str) -> DataFrame:
    """Upserts stores in order (U11); rows without a dataset are left out before, and undecided conflicts stop the job."""
    named = lambda s: s.filter(F.col("dataset_id").isNotNull()) if "dataset_id" in s.columns else s
    out = named(stores[0])
    for s in stores[1:]:
        out = without_conflicts(upsert(out, named(s), keys, decision, stamp), keys)
    return out


def accumulate(base: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both by key, the incoming values counting; is_new marks keys that base lacked."""
    value = [c for c in base.columns if c not in keys]
    j = base.withColumn("_in_b", F.lit(True)).alias("b").join(incoming.withColumn("_in_i", F.lit(True)).alias("i"), _same("b", "i", keys), "full_outer")
    return j.select(*[F.coalesce(f"b.{k}", f"i.{k}").alias(k) for k in keys], *[F.when(F.col("_in_i"), F.col(f"i.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in value], F.col("_in_b").isNull().alias("is_new"))


def union_files(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The files of all datasets; a file that two hold stops the job."""
    n = parts.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.count("*").alias("_n"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    ok = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("file in several datasets: "), F.concat_ws("/", *keys))).cast("boolean")).otherwise(F.lit(True))
    return parts.join(n, on).filter(ok).select(*parts.columns)


def container_values(parts: DataFrame, keys: list[str], values: list[str], ordinal: str) -> DataFrame:
    """Each container's values, the first dataset's counting, nulls too."""
    first = F.min_by(F.struct(*[F.col(v) for v in values]), F.col(ordinal))
    return parts.groupBy(*keys).agg(first.alias("_v")).select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])


def conflicts(parts: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """keys, field and n_values where datasets disagree; null is a value."""
    fields = F.explode(F.array(*[F.struct(F.lit(v).alias("field"), F.coalesce(F.col(v).cast("string"), F.lit("\0null")).alias("value")) for v in values]))
    return parts.select(*keys, fields.alias("x")).groupBy(*keys, F.col("x.field").alias("field")).agg(F.count_distinct("x.value").alias("n_values")).filter("n_values > 1")


def pruned(containers: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """Containers that hold a file (U4); doing it twice changes nothing."""
    return containers.join(files.select(*keys).distinct(), keys, "left_semi")


def empty_containers(containers: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    return containers.join(files.select(*keys).distinct(), keys, "left_anti")


def merge_samples(primary: DataFrame, secondary: DataFrame, key: str, fill: dict[str, list]) -> DataFrame:
    """All samples of both (J11): primary rows, their columns of `fill` enriched where they hold one of the given
    weak values (None for null) and the secondary's is not; rows that only the secondary has; and origin (J21)."""
    j = primary.withColumn("_p", F.lit(True)).alias("p").join(secondary.withColumn("_s", F.lit(True)).alias("s"), F.col(f"p.{key}") == F.col(f"s.{key}"), "full_outer")
    in_p, in_s = F.col("_p").isNotNull(), F.col("_s").isNotNull()
    cols = []
    for c in primary.columns:
        if c == key:
            cols.append(F.coalesce(f"p.{key}", f"s.{key}").alias(key))
            continue
        p, s = F.col(f"p.{c}"), F.col(f"s.{c}")
        out = F.when(in_p, p).otherwise(s)
        if c in fill:
            weak = lambda x, c=c: F.coalesce(x.isin(*[v for v in fill[c] if v is not None]), F.lit(False)) | (x.isNull() if None in fill[c] else F.lit(False))
            out = F.when(in_p & in_s & weak(p) & ~weak(s), s).otherwise(out)
        cols.append(out.alias(c))
    origin = F.when(in_p & in_s, "both").when(in_p, "primary").otherwise("secondary")
    return j.select(*cols, origin.alias("origin"))


def version_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """what and n: keys removed, added and common, and for each field how many common keys differ in it."""
    removed = old.join(new, key, "left_anti").agg(F.count("*").alias("n")).select(F.lit("removed").alias("what"), "n")
    added = new.join(old, key, "left_anti").agg(F.count("*").alias("n")).select(F.lit("added").alias("what"), "n")
    both = old.alias("o").join(new.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"))
    sums = both.agg(F.count("*").alias("common"), *[F.count_if(~F.col(f"o.{f}").eqNullSafe(F.col(f"n.{f}"))).alias(f"changed:{f}") for f in fields])
    rest = sums.select(F.explode(F.array(*[F.struct(F.lit(c).alias("what"), F.col(f"`{c}`").alias("n")) for c in sums.columns])).alias("x")).select("x.*")
    return removed.union(added).union(rest)


def missing_from(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of left whose key right lacks: verdicts not yet exported, or orphans (J15, J16, V9, SC20)."""
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def first_sibling(rows: DataFrame, group: list[str], order: list[str], has: Column, uid: str) -> DataFrame:
    """Adds sibling, the first row of the group that has it, to rows that don't (J13); none stays null."""
    first = rows.filter(has).withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter("_r = 1").select(*group, F.col(uid).alias("sibling"))
    return rows.filter(~has).join(first, group, "left")


def probe_paths(wanted: DataFrame, files: DataFrame, folder: str, date: str, path: str) -> DataFrame:
    """Adds found: exact (a file in the folder of the date), sibling (one in a folder that starts with the date and _), none."""
    have = files.select(F.col(folder).alias("_folder"), F.split(F.col(path), "/")[0].alias("_dir")).distinct()
    key = have.select("_folder", "_dir", F.split("_dir", "_")[0].alias("_date"), (~F.col("_dir").contains("_")).alias("_exact"))
    best = key.groupBy("_folder", "_date").agg(F.bool_or("_exact").alias("_exact"))
    j = wanted.join(best, (F.col(folder) == F.col("_folder")) & (F.col(date) == F.col("_date")), "left")
    return j.withColumn("found", F.when(F.col("_exact"), "exact").when(F.col("_exact").isNotNull(), "sibling").otherwise("none")).drop("_folder", "_date", "_exact")


def filled(df: DataFrame, lookup: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Fills blank cells from a lookup and marks mismatches of the others."""
    right = lookup.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in columns])
    j = df.join(right, F.col(key) == F.col("_k"), "left")
    own = {c: F.nullif(F.col(c), F.lit("")) for c in columns}
    clash = F.array_compact(F.array(*[F.when(own[c].isNotNull() & F.col(f"_{c}").isNotNull() & (own[c] != F.col(f"_{c}")), F.lit(c)) for c in columns]))
    return j.select(*[c for c in df.columns if c not in columns], *[F.coalesce(own[c], F.col(f"_{c}")).alias(c) for c in columns], clash.alias("mismatches"))
