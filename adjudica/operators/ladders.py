"""Decision ladders: the first rung that applies decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _rung(decision, source: str, reason) -> Column:
    status = {"human": "reviewed", "-": "pending"}.get(source, "not_needed")
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(lit(decision).alias("decision"), F.lit(source).alias("source"), lit(reason).alias("reason"), F.lit(status).alias("review_status"))


def annotation_ladder(human: Column, automatic: Column, needs_review: Column, unverified: Column, in_scope: Column, human_reason: Column | None = None, automatic_reason: Column | None = None) -> Column:
    """A struct (decision, source, reason, review_status) of an annotation (L1).

    Human verdicts first, with their own reason or else the decision as one; then automatic exclusions with theirs (an
    automatic keep is not final); review needed is pending and decided by nobody (-); what could not be verified is kept as
    such; out of scope is kept; the rest is kept.
    """
    said = human if human_reason is None else F.coalesce(F.nullif(human_reason, F.lit("")), human)
    return (
        F.when(human.isNotNull(), _rung(human, "human", said))
        .when(automatic == "exclude", _rung("exclude", "automatic", automatic_reason if automatic_reason is not None else "older_exact_duplicate"))
        .when(needs_review, _rung("pending", "-", "review_required"))
        .when(unverified, _rung("keep", "default", "kept_without_full_check"))
        .when(~in_scope, _rung("keep", "default", "out_of_scope"))
        .otherwise(_rung("keep", "default", "no_issue_detected"))
    )


def overrides_automatic(human: Column, automatic: Column) -> Column:
    """Whether a human verdict differs from the automatic one (L1)."""
    return F.coalesce(human != automatic, F.lit(False))


def image_class(n_records: Column, negative: Column, series_annotated: Column) -> Column:
    """annotated, negative_case, unannotated_view or unannotated_orphan."""
    return F.when(n_records > 0, "annotated").when(negative, "negative_case").when(series_annotated, "unannotated_view").otherwise("unannotated_orphan")


def negative_case(labels: Column, n_records: Column) -> Column:
    """No annotation, and a case label of No Findings or normal."""
    return (n_records == 0) & F.coalesce(F.exists(labels, lambda x: (x["code_system"] == "No Findings") | (F.lower(x["code_text_eng"]) == "normal")), F.lit(False))


def image_ladder(human: Column, kind: Column, needs_review: Column, human_reason: Column | None = None) -> Column:
    """A struct (decision, source, reason, review_status) of an image."""
    said = human if human_reason is None else F.coalesce(F.nullif(human_reason, F.lit("")), human)
    return (
        F.when(human.isNotNull(), _rung(human, "human", said))
        .when(kind == "annotated", _rung("keep", "default", "has_annotations"))
        .when(kind == "unannotated_orphan", _rung("exclude", "default", "unannotated_orphan_unused"))
        .when(needs_review, _rung("pending", "-", "review_required"))
        .when(kind == "negative_case", _rung("keep", "default", "negative_case"))
        .otherwise(_rung("keep", "default", "kept_without_review"))
    )


def matching_override(rules: list[dict], columns: dict[str, Column]) -> Column:
    """The id of the first keep rule whose every key holds the row's value (F15); a missing or null key is a wildcard."""
    out = F.lit(None).cast("string")
    for rule in reversed([r for r in rules if r.get("action", "keep") == "keep"]):
        fits = F.lit(True)
        for key, c in columns.items():
            values = rule.get(key)
            if values is not None:
                fits = fits & F.coalesce(c.isin(*(values if isinstance(values, (list, tuple)) else [values])), F.lit(False))
        out = F.when(fits, F.lit(rule["id"])).otherwise(out)
    return out


def overridden(verdict: Column, rule: Column) -> Column:
    """A default exclusion that a rule matches is kept; its reason stays."""
    flips = (verdict["source"] == "default") & (verdict["decision"] == "exclude") & rule.isNotNull()
    return F.when(flips, F.struct(F.lit("keep").alias("decision"), F.lit("override").alias("source"), verdict["reason"].alias("reason"), verdict["review_status"].alias("review_status"))).otherwise(verdict)


def case_status(decisions: DataFrame, keys: list[str], decision: str = "decision") -> DataFrame:
    """The status of each case by the decisions in it, null ones (no annotation) not counting."""
    d = F.col(decision)
    has = lambda *v: F.coalesce(F.bool_or(d.isin(*v)), F.lit(False))
    status = (
        F.when(F.count(d) == 0, "no_annotation").when(has("pending", "uncertain"), "needs_review")
        .when(has("keep") & has("exclude"), "partial").when(has("keep"), "passed").otherwise("all_excluded")
    )
    return decisions.groupBy(*keys).agg(status.alias("status"))


STATUSES = ("passed", "partial", "all_excluded", "needs_review", "no_annotation")


def status_counts(statuses: DataFrame) -> DataFrame:
    """How many cases have each status, with zeros for those that none has (A4)."""
    vocabulary = statuses.sparkSession.createDataFrame([(s,) for s in STATUSES], "status string")
    return vocabulary.join(statuses.groupBy("status").agg(F.count("*").alias("n")), "status", "left").select("status", F.coalesce("n", F.lit(0)).alias("n"))


def first_broken(issues: DataFrame, uid: str, ordinal: str) -> DataFrame:
    """The first machine error of automatic policy that was checked, of each annotation: it is excluded (L4)."""
    bad = issues.filter("category = 'machine' and severity = 'error' and status = 'checked' and policy = 'auto'")
    w = Window.partitionBy(uid).orderBy(ordinal)
    return bad.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(uid, "check_id", F.lit("exclude").alias("decision"), F.lit("broken_mask").alias("reason"))


def kept_rows(df: DataFrame, decision: str, pending_as: str, uncertain_as: str) -> DataFrame:
    """Rows that the build takes (L9, U5): kept ones, and pending or uncertain ones where those count as keep."""
    d = F.col(decision)
    final = F.when(d == "pending", pending_as).when(d == "uncertain", uncertain_as).otherwise(d)
    return df.filter(F.coalesce(final == "keep", F.lit(False)))


def gate(count: int, what: str, allow: bool = False, treat_as: str | None = None) -> str | None:
    """Why a build must stop, or None (L8): open rows pass only if allowed and told what they count as."""
    if not count or (allow and treat_as):
        return None
    return f"{count} {what}: " + ("say what they count as" if allow else "not allowed")


def gate_column(count: Column, what: str, allow: Column, told: Column) -> Column:
    """gate() of a table of counts: the sentence that stops a build, or null."""
    reason = F.when(allow, "say what they count as").otherwise("not allowed")
    return F.when((count > 0) & ~(allow & told), F.concat(count.cast("string"), F.lit(f" {what}: "), reason))


def with_issues(rows: DataFrame, issues: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with check_ids, the sorted checks whose issues share their keys (J7); an empty list without any."""
    found = issues.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.array_sort(F.collect_set("check_id")).alias("_checks"))
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return rows.join(found, on, "left").withColumn("check_ids", F.coalesce("_checks", F.array().cast("array<string>"))).drop("_checks", *[f"_{k}" for k in keys])


def review_scope(issues: DataFrame, decisions: DataFrame, keys: list[str], levels: list[str]) -> DataFrame:
    """check_id, annotations and distinct levels (institutions, patients) that pending decisions leave to review.

    issues has asks, whether a finding asks for review. An annotation counts once a check, however many issues it has."""
    asked = issues.filter("asks").select("check_id", *keys).distinct()
    open_ = decisions.filter("decision = 'pending'").select(*keys, *levels)
    return asked.join(open_, keys).groupBy("check_id").agg(F.count("*").alias("annotations"), *[F.count_distinct(level).alias(level) for level in levels])


def image_inputs(images: DataFrame, human: DataFrame, issues: DataFrame) -> DataFrame:
    """What the ladder of images reads (J9): human_decision by stable_file_uid, which outlives a new export; detected, the
    sorted checks that ask for review of the image as a whole, by file_uid; and whether its series is annotated.

    images has dataset_id, study, series, file_uid, stable_file_uid and n_records; issues file_uid, geometry_uid, check_id
    and asks; human key, decision and reason, one row a key.
    """
    verdict = human.select(F.col("key").alias("_v"), F.col("decision").alias("human_decision"), F.col("reason").alias("human_reason"))
    whole = issues.filter("geometry_uid is null and asks").groupBy(F.col("file_uid").alias("_f")).agg(F.array_sort(F.collect_set("check_id")).alias("_checks"))
    series = images.filter("n_records > 0").select(*[F.col(c).alias(f"_{c}") for c in ("dataset_id", "study", "series")]).distinct()
    same = (F.col("dataset_id") == F.col("_dataset_id")) & (F.col("study") == F.col("_study")) & (F.col("series") == F.col("_series"))
    j = images.join(verdict, F.col("stable_file_uid") == F.col("_v"), "left").join(whole, F.col("file_uid") == F.col("_f"), "left").join(series, same, "left")
    return j.withColumns({"detected": F.coalesce("_checks", F.array().cast("array<string>")), "series_annotated": F.col("_series").isNotNull()}).drop("_v", "_f", "_checks", "_dataset_id", "_study", "_series")
