"""Review: saved views, effective reasons and status, display helpers, gates of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.operators.rollups import vocabulary_ordered
from adjudica.operators.scale import numbered


#: Tags of machine findings, of rows to report, of rows to look at by chance, and of rows that are none (fixed values).
OUTSIDE, DIVERGENT, NESTED = "auto:s05_outside_body", "auto:s04_original_final_divergence", "auto:d04_contained_different_label"
TINY = ("auto:s03_suspiciously_small", "auto:s03_tiny_annotation", "auto:s03_stray_component")
TO_REPORT, SPOT_CHECK, SEED = "flag:needs_report", "spot_check", "system:schema_seed"


def views() -> dict[str, tuple[Column, list[Column]]]:
    """The saved views (F16): a condition and an order each, over kind, status, tags (an array), n_reasons, display_adjusted,
    dataset_id, image_class, series_image_index and uid."""
    has = lambda *tags: F.arrays_overlap(F.coalesce("tags", F.array().cast("array<string>")), F.array(*[F.lit(t) for t in tags]))
    annotation, image, pending = F.col("kind") == "annotation", F.col("kind") == "image", F.col("status") == "pending"
    plain = [F.col("uid")]
    return {
        "all": (F.lit(True), plain), "pending_annotations": (annotation & pending, plain), "pending_images": (image & pending, plain),
        "outside_body": (annotation & has(OUTSIDE), plain), "tiny_region": (annotation & has(*TINY), plain), "contained_different_label": (annotation & has(NESTED), plain),
        "broken_box": (annotation & F.col("display_adjusted").isNotNull(), plain), "flagged_for_report": (image & has(TO_REPORT), plain),
        "original_final_divergence": (annotation & has(DIVERGENT), plain), "needs_report_first": (F.lit(True), [has(TO_REPORT).desc(), *plain]),
        "reasoned_decisions": (annotation & (F.col("n_reasons") > 0) & ~has(SEED), plain),
        "spot_check_unannotated": (image & has(SPOT_CHECK), [F.col("dataset_id"), F.col("image_class"), F.col("series_image_index"), *plain]),
    }


def view(items: DataFrame, name: str) -> DataFrame:
    test, order = views()[name]
    return items.filter(F.coalesce(test, F.lit(False))).orderBy(*order)


def register_views(items: DataFrame, prefix: str = "review_") -> list[str]:
    """Temporary views by the saved conditions and orders."""
    for name in views():
        view(items, name).createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views()]


def view_counts(items: DataFrame) -> DataFrame:
    """name and n of each saved view, zeros too, in one pass."""
    one = items.agg(*[F.count_if(F.coalesce(test, F.lit(False))).alias(name) for name, (test, _) in views().items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(v).alias("name"), F.col(v).alias("n")) for v in views()])).alias("x")).select("x.*")


def unverified(df: DataFrame) -> DataFrame:
    """Rows with checks that could not be done."""
    return df.filter(F.coalesce(F.col("unverified_checks"), F.lit("none")) != "none")


def searched(df: DataFrame, equal: dict[str, str | None], text: str | None, columns: list[str], checks: str | None = None) -> DataFrame:
    """Rows that equal all given values, have a check, and hold a text in one of some columns, case aside."""
    for c, v in equal.items():
        if v is not None:
            df = df.filter(F.col(c) == v)
    if checks:
        df = df.filter(F.array_contains(F.split("detected_checks", r"\|"), checks))
    if text:
        test = F.lit(False)
        for c in columns:
            test = test | F.coalesce(F.lower(F.col(c)).contains(text.lower()), F.lit(False))
        df = df.filter(test)
    return df


def cases_with(cases: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Cases of which a row is among rows."""
    return cases.join(rows.select(key).distinct(), key, "left_semi")


def review_targets(images: DataFrame, pending_images: DataFrame, pending_annotations: DataFrame, key: str = "file_uid") -> DataFrame:
    """Images that are pending or have a pending annotation."""
    return images.join(pending_images.select(key).union(pending_annotations.select(key)).distinct(), key, "left_semi")


#: Reasons that a person may give for a verdict (fixed values); machine reasons are none of them.
REASONS = [
    "visually_valid", "true_small_lesion", "valid_nested_annotation", "boundary_tolerance", "frontal_view",
    "invalid_annotation", "invalid_duplicate", "older_duplicate", "stray_component", "outside_body", "lateral_view", "wrong_label",
]
DECIDED = ("keep", "exclude", "uncertain")


def tagged(tags: Column, prefix: str) -> Column:
    """What follows a prefix in tags."""
    return F.filter(F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda t: F.regexp_extract(t, f"^{prefix}(.+)$", 1)), lambda x: x != "")


def effective_reasons(field: Column, tags: Column, legacy: Column, vocabulary: list[str] = REASONS) -> Column:
    """Reasons by the first source that has known ones: the field, reason: tags, legacy text; in the vocabulary's order."""
    known = F.array(*[F.lit(v) for v in vocabulary])
    split = lambda c: F.transform(F.split(F.coalesce(c, F.lit("")), r"\|"), F.trim)
    sources = [F.array_intersect(known, s) for s in (split(field), tagged(tags, "reason:"), split(legacy))]
    first = F.when(F.size(sources[0]) > 0, sources[0]).when(F.size(sources[1]) > 0, sources[1]).otherwise(sources[2])
    return vocabulary_ordered(first, vocabulary)


def effective_status(field: Column, tags: Column) -> Column:
    """The decided status of the field, else that of the first review: tag with one, else pending."""
    first = F.get(F.filter(tagged(tags, "review:"), lambda v: v.isin(*DECIDED)), F.lit(0))
    return F.when(field.isin(*DECIDED), field).otherwise(F.coalesce(first, F.lit("pending")))


def dictionary_codes(df: DataFrame, column: str, order: list[str]) -> DataFrame:
    """value and code: codes by first appearance."""
    firsts = df.groupBy(column).agg(F.min(F.struct(*order)).alias("_o"))
    return numbered(firsts, ["_o", column], "code").select(F.col(column).alias("value"), "code")


def display_box(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column, least: int = 8) -> Column:
    """x, y, w and h of a box in shares of its image, with reason and original where it had to be changed (P10).

    A box that is less than `least` wide or high is widened to the right and below: degenerate_widened_for_display. What
    lies outside the image is shown there, but if a share is below -1 or above 2, all are held to -0.5 and 1.5:
    out_of_image_clamped_for_display. Null without a size of the image.
    """
    small = (x1 - x0 < least) | (y1 - y0 < least)
    wide = lambda low, high: F.when(small, F.greatest(high - low, F.lit(least))).otherwise(high - low)
    shares = [x0 / width, y0 / height, wide(x0, x1) / width, wide(y0, y1) / height]
    out = F.greatest(*[(v < -1) | (v > 2) for v in shares])
    held = [F.when(out, F.least(F.greatest(v, F.lit(-0.5)), F.lit(1.5))).otherwise(v) for v in shares]
    reason = F.when(out, "out_of_image_clamped_for_display").when(small, "degenerate_widened_for_display").alias("reason")
    original = F.when(out | small, F.array(*[c.cast("double") for c in (x0, y0, x1, y1)])).alias("original")
    return F.when((width != 0) & (height != 0), F.struct(*[v.alias(n) for n, v in zip("xywh", held)], reason, original))


def partner_hint(df: DataFrame, group: str, stamp: str, uid: str) -> DataFrame:
    """Pairs of a group with the seconds between their stamps and which is newer, null on a tie or a missing one."""
    a, b = (df.select(F.col(group).alias("_g"), F.col(uid).alias(f"uid_{s}"), F.col(stamp).alias(f"t_{s}")) for s in "ab")
    j = a.join(b, "_g").filter("uid_a <> uid_b")
    gap = F.unix_timestamp("t_b") - F.unix_timestamp("t_a")
    return j.select(F.col("_g").alias(group), "uid_a", "uid_b", gap.alias("seconds"), F.when(gap != 0, gap < 0).alias("a_is_newer"))


def elapsed_text(seconds: Column) -> Column:
    """Seconds as a rounded-down count of the largest unit that fits."""
    s = F.abs(seconds)
    unit = lambda n, name: F.concat(F.floor(s / n).cast("string"), F.lit(f" {name}"))
    return F.when(s >= 86400, unit(86400, "days")).when(s >= 3600, unit(3600, "hours")).when(s >= 60, unit(60, "minutes")).when(s.isNotNull(), unit(1, "seconds"))


def clock_seconds(*times: Column) -> Column:
    """Seconds of the day of the first of several HHMMSS.ffffff texts that can be read."""
    def one(t: Column) -> Column:
        ok = t.rlike(r"^\d{6}(\.\d+)?$")
        return F.when(ok, F.substring(t, 1, 2).try_cast("int") * 3600 + F.substring(t, 3, 2).try_cast("int") * 60 + F.substring(t, 5, 20).try_cast("double"))

    return F.coalesce(*[one(t) for t in times])


#: What tags of an image are searched for, by kind, and how far apart exposures of one session may be (fixed values).
TEXT_TAGS = ("ViewPosition", "AcquisitionDeviceProcessingDescription", "SeriesDescription")
LATERAL_HINTS = ("lat", "側面", "l-r", "r-l")
EXPIRATION_HINTS = ("呼気", "こき", "expir", "max-exp")
INSPIRATION_HINTS = ("吸気", "inspir", "max-insp")
SESSION_SECONDS = 600
#: What is said of an image, in the order in which it is tried (fixed values).
VIEW_KINDS = {
    "lateral": "側面像 -> 除外のまま", "expiration": "呼気像（記述あり）-> train候補", "inspiration": "吸気像（記述あり）-> 呼気ではない", "paired_expiration": "ペアが呼気像 -> この枚は吸気側",
    "same_view": "同一体位を連続撮影 -> 呼気像の候補", "same_size": "要目視（同サイズ・連続撮影だが撮影法タグが空）", "unknown": "要目視（判別材料なし）",
}


def _tag(tags: Column, name: str) -> Column:
    return F.coalesce(tags[name], F.lit(""))


def _mentions(tags: Column, hints: tuple[str, ...]) -> Column:
    text = F.lower(F.concat_ws(" ", *[_tag(tags, t) for t in TEXT_TAGS]))
    return F.greatest(*[text.contains(h) for h in hints])


def phase(tags: Column) -> Column:
    """expiration, inspiration or blank, by the first whose hints the tags hold."""
    return F.when(_mentions(tags, EXPIRATION_HINTS), "expiration").when(_mentions(tags, INSPIRATION_HINTS), "inspiration").otherwise("")


def view_kind(tags: Column, paired: Column, seconds: Column) -> Column:
    """What can be said of an image by its tags and those of its pair (F17): a key of VIEW_KINDS.

    tags and paired are maps of strings (null: none), seconds the time between the two, null if unknown.
    """
    near = F.coalesce(F.abs(seconds) <= SESSION_SECONDS, F.lit(False))
    same = lambda t: _tag(tags, t) == _tag(paired, t)
    described, sized = "AcquisitionDeviceProcessingDescription", "Rows"
    own = phase(tags)
    return (
        F.when(_mentions(tags, LATERAL_HINTS), "lateral").when(own != "", own).when(phase(paired) == "expiration", "paired_expiration")
        .when((_tag(tags, described) != "") & same(described) & near, "same_view").when((_tag(tags, sized) != "") & same(sized) & same("Columns") & near, "same_size").otherwise("unknown")
    )


def view_text(kind: Column) -> Column:
    """The sentence of a kind."""
    return F.create_map(*[F.lit(x) for pair in VIEW_KINDS.items() for x in pair])[kind]


def protected_ids(provenance: DataFrame, key: str = "sample_id") -> DataFrame:
    """Identities that a merge must not relabel (L13): both lists of the evidence; another version of it is an error."""
    ok = F.when(F.col("schema_version") == 1, True).otherwise(F.raise_error(F.lit("unknown evidence version")).cast("boolean"))
    both = F.concat(F.coalesce("explicit_negative_normal", F.array()), F.coalesce("explicit_negative_report", F.array()))
    return provenance.filter(ok).select(F.explode(both).alias(key)).distinct()


def run_gate(meta: dict, allow_partial: bool = False, allow_unmeasured: bool = False) -> list[str]:
    """Why a selection must not be built on a run (L14): partial checks, or files not measured."""
    m = meta.get("measurements", {})
    out = []
    if meta.get("checks_partial") and not allow_partial:
        out.append("not all checks were run")
    if m.get("scan_required", True) and m.get("n_measured", 0) < m.get("n_files", 0) and not allow_unmeasured:
        out.append(f"{m.get('n_files', 0) - m.get('n_measured', 0)} files are not measured")
    return out


def one_fingerprint(df: DataFrame, column: str = "fingerprint") -> None:
    """Stops if rows of several fingerprints would be mixed."""
    found = [r[0] for r in df.select(column).distinct().limit(2).collect()]
    if len(found) > 1:
        raise ValueError(f"rows of several fingerprints: {found}")


def review_status(items: DataFrame) -> DataFrame:
    """kind, status and n of review items."""
    return items.groupBy("kind", "status").agg(F.count("*").alias("n"))


def tag_counts(items: DataFrame) -> DataFrame:
    return items.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


