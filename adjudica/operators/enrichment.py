"""Labels enriched by reports and by a second sample set; nothing confirmed is ever weakened.

Every rule yields the new value, a change or a conflict. Changes are structs (field, before, after, reason), conflicts
(field, kept, other, reason), values as text, in the order case, side, bulla, effusion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The report format that these rules are for, and sides of a case (fixed values).
REPORT_SCHEMA = 2
SIDES = ("left", "right", "bilateral")
#: What a sample shows of its pixels always comes from the primary.
PIXEL_FIELDS = ("image_file", "pneumothorax_mask", "lung_mask", "thorax_mask", "lung_rect", "pneumothorax_area_pix2", "pneumothorax_area_mm2")

LABELS = ("pneumothorax_case", "case_evidence", "pneumothorax_side", "bulla_bleb_status", "pleural_effusion_status")


def _true(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def _text(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("string")


def _change(when: Column, field: str, before, after, reason: str) -> Column:
    return F.when(_true(when), F.struct(F.lit(field).alias("field"), _text(before).alias("before"), _text(after).alias("after"), F.lit(reason).alias("reason")))


def _conflict(when: Column, field: str, kept, other, reason) -> Column:
    return F.when(_true(when), F.struct(F.lit(field).alias("field"), _text(kept).alias("kept"), _text(other).alias("other"), _text(reason).alias("reason")))


def _side(kept: Column, other: Column, case: Column) -> tuple[Column, list[Column], list[Column]]:
    """A missing side of a case is filled; one that is neither of SIDES stops the job."""
    known = F.when(other.isNull() | other.isin(*SIDES), other).otherwise(F.raise_error(F.concat(F.lit("unknown side: "), other)).cast("string"))
    says = known.isNotNull() & case
    return (
        F.when(kept.isNull() & says, known).otherwise(kept),
        [_change(says & kept.isNull(), "pneumothorax_side", None, known, "report_side")],
        [_conflict(says & (kept != known), "pneumothorax_side", kept, known, "side_already_set")],
    )


def _status(field: str, kept: Column, other: Column, why: str, absent_wins: bool) -> tuple[Column, list[Column], list[Column]]:
    """unknown becomes present or absent; anything else stays, and differing statements are a conflict."""
    says = _true(other.isin("present", "absent"))
    up = says & _true(kept == "unknown")
    reason = F.when(_true(kept == "absent"), "explicit_negative_wins").otherwise("never_downgrade") if absent_wins else F.lit("never_downgrade")
    return F.when(up, other).otherwise(kept), [_change(up, field, "unknown", other, why)], [_conflict(says & ~up & ~kept.eqNullSafe(other), field, kept, other, reason)]


def _rest(own: dict[str, Column], other: dict[str, Column], case: Column) -> tuple[dict[str, Column], list[Column], list[Column]]:
    side = _side(own["pneumothorax_side"], other["pneumothorax_side"], case)
    bulla = _status("bulla_bleb_status", own["bulla_bleb_status"], other["bulla_bleb_status"], "report_bulla_bleb", False)
    effusion = _status("pleural_effusion_status", own["pleural_effusion_status"], other["pleural_effusion_status"], "report_pleural_effusion", True)
    values = {"pneumothorax_side": side[0], "bulla_bleb_status": bulla[0], "pleural_effusion_status": effusion[0]}
    return values, side[1] + bulla[1] + effusion[1], side[2] + bulla[2] + effusion[2]


def _listed(items: list[Column]) -> Column:
    return F.array_compact(F.array(*items))


def with_report(df: DataFrame, report: str = "report") -> DataFrame:
    """df with LABELS enriched by a report's struct, and with changes and conflicts.

    A null report changes nothing. A report of another format stops the job. An annotated case stays, and so does an explicit
    negative; an unconfirmed one becomes a case by a report of presence, and an explicit negative by a report of
    absence that is there (evidence neither null nor no_report) and names no finding at all.
    """
    r = F.col(report)
    there = r.isNotNull()
    fits = F.when(~there | r["schema_version"].isNull() | (r["schema_version"] == REPORT_SCHEMA), r).otherwise(F.raise_error(F.lit("unknown report format")).cast(df.schema[report].dataType))
    said = fits["pneumothorax_status"]
    case, evidence = _true(F.col("pneumothorax_case")), F.col("case_evidence")
    explicit = ~case & _true(evidence == "explicit_negative_normal")
    open_ = there & ~case & ~explicit
    up = _true(open_ & (said == "present"))
    has_report = _true(fits["pneumothorax_evidence"] != "no_report")
    confirmed = _true(open_ & (said == "absent") & has_report & (fits["observed_finding_count"] == 0))
    new_case = case | up
    values, changes, conflicts = _rest({c: F.col(c) for c in LABELS}, {c: fits[c] for c in LABELS[2:]}, new_case)
    values |= {"pneumothorax_case": new_case, "case_evidence": F.when(up, "report_positive").when(confirmed, "explicit_negative_report").otherwise(evidence)}
    changes = [_change(up, "pneumothorax_case", case, F.lit(True), "report_positive"), _change(confirmed, "case_evidence", evidence, "explicit_negative_report", "report_confirmed_negative"), *changes]
    conflicts = [
        _conflict(case & (said == "absent"), "pneumothorax_case", case, said, "never_downgrade"),
        _conflict(explicit & (said == "present"), "pneumothorax_case", case, said, "explicit_negative_wins"), *conflicts,
    ]
    return df.withColumns(values | {"changes": _listed(changes), "conflicts": _listed(conflicts)})


def merged_samples(primary: DataFrame, secondary: DataFrame, protected: DataFrame | None = None, key: str = "sample_id") -> DataFrame:
    """All samples of both sets of the same columns: those of both enriched, with origin, changes and conflicts.

    The primary's columns win, its pixel fields always; its case is raised by the secondary's unless `protected` (a table
    of keys, see review.protected_ids) holds the sample. A sample that only one set has comes as it is.
    """
    left, right = (df.select(F.col(key).alias(key), F.struct(*[F.col(c) for c in primary.columns if c != key]).alias(side)) for df, side in ((primary, "p"), (secondary, "s")))
    j = left.join(right, key, "full_outer")
    if protected is not None:
        j = j.join(protected.select(key).distinct().withColumn("_safe", F.lit(True)), key, "left")
    safe = _true(F.col("_safe")) if protected is not None else F.lit(False)
    p, s = F.col("p"), F.col("s")
    both = p.isNotNull() & s.isNotNull()
    base, other = _true(p["pneumothorax_case"]), _true(s["pneumothorax_case"])
    raised = both & ~base & other & ~safe
    own, theirs = {c: p[c] for c in LABELS[2:]}, {c: F.when(both, s[c]) for c in LABELS[2:]}
    values, changes, conflicts = _rest(own, theirs, base | raised)
    values["pneumothorax_case"] = F.when(raised, F.lit(True)).otherwise(p["pneumothorax_case"])
    changes = [_change(raised, "pneumothorax_case", F.lit(False), F.lit(True), "report_positive"), *changes]
    conflicts = [
        _conflict(both & ~base & other & safe, "pneumothorax_case", F.lit(False), F.lit(True), "explicit_negative_wins"),
        _conflict(both & base & ~other, "pneumothorax_case", F.lit(True), F.lit(False), "never_downgrade"), *conflicts,
    ]
    cols = [F.when(p.isNotNull(), values.get(c, p[c])).otherwise(s[c]).alias(c) for c in primary.columns if c != key]
    origin = F.when(both, "both").when(p.isNotNull(), "primary").otherwise("secondary")
    return j.select(key, *cols, origin.alias("origin"), _listed(changes).alias("changes"), _listed(conflicts).alias("conflicts"))
