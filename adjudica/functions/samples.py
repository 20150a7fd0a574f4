"""Sample projections and labels of the feature export."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica import config as settings


def has_label(labels: Column, system: str, name: str) -> Column:
    return F.coalesce(F.exists(labels, lambda x: (x["code_system"] == system) & (F.lower(x["code_text_eng"]) == name)), F.lit(False))


def case_labels(config: dict = settings.DEFAULTS) -> dict[str, Column]:
    """Labels of an image by its annotations' and its case's labels (L10); three-valued statuses are never folded.

    Columns: ann_labels (of the image's annotations) and case_labels. Evidence of a normal case counts on any level; that
    there are no annotations is none. A bulla is present or unknown, for nothing says that it was looked for; an effusion
    is absent only for a normal case without any finding.
    """
    systems = config["finding_code_systems"]
    found = F.array_sort(F.array_distinct(F.transform(F.filter("ann_labels", lambda x: x["code_system"].isin(*systems) & (F.coalesce(x["code_text_eng"], F.lit("")) != "")), lambda x: x["code_text_eng"])))
    found = F.coalesce(found, F.array().cast("array<string>"))
    everywhere = F.concat(*[F.coalesce(F.transform(c, lambda x: F.concat_ws("/", x["code_system"], x["code_text_eng"])), F.array().cast("array<string>")) for c in ("case_labels", "ann_labels")])
    evidence = F.array(*[F.lit(f"{system}/{name}") for system, name in config["normal_evidence"]])
    hits = F.array_sort(F.array_intersect(evidence, everywhere))
    any_found, normal, has = F.size(found) > 0, F.size(hits) > 0, lambda name: F.array_contains(found, name)
    return {
        "findings": found, "abnormal_finding_status": F.when(any_found, "present").when(normal, "absent").otherwise("unknown"),
        "pneumothorax_case": has("pneumothorax"),
        "bulla_bleb_status": F.when(has("bulla_bleb"), "present").otherwise("unknown"),
        "pleural_effusion_status": F.when(has("pleural_effusion"), "present").when(normal & ~any_found, "absent").otherwise("unknown"),
        "normal_evidence_hits": hits,
        "case_evidence": F.when(has("pneumothorax"), "explicit_positive_annotation").when(normal, "explicit_negative_normal").otherwise("unconfirmed"),
    }


def spacing(x: Column, y: Column) -> Column:
    """A struct of both spacings, or null unless both are positive."""
    return F.when((x > 0) & (y > 0), F.struct(x.alias("x"), y.alias("y")))


def effective_spacing(json_value: Column, dicom_value: Column) -> Column:
    """The document's value first, the image's where it has none."""
    return F.coalesce(json_value, dicom_value)


def view_position(labels: Column) -> Column:
    """The first named case label of the series types."""
    return F.get(F.filter(labels, lambda x: (x["code_system"] == "CRSeriesTypes") & (F.coalesce(x["code_text_eng"], F.lit("")) != "")), F.lit(0))["code_text_eng"]


def relative_path(path: Column, base: str) -> Column:
    """The path below a base, or as it is."""
    base = base.rstrip("/") + "/"
    return F.when(path.startswith(base), F.substring(path, len(base) + 1, 1 << 30)).otherwise(path)


def reference_status(corrupt: Column, shapes_differ: Column, kinds: Column, required: list[str]) -> Column:
    """available if all required kinds are whole, whatever else is broken; then corrupt, shape_mismatch, lung_only or no_reference."""
    whole = F.size(F.array_except(F.array(*[F.lit(k) for k in required]), kinds)) == 0
    reason = F.when(corrupt, "reference_corrupt").when(shapes_differ, "reference_shape_mismatch").when(F.array_contains(kinds, "lung"), "lung_only").otherwise("no_reference")
    return F.when(whole, "available").otherwise(F.concat(F.lit("cannot_determine:"), reason))


def record_path(column: str, base: str | None) -> Column:
    return relative_path(F.col(column), base) if base else F.col(column)


def mask(column: str, base: str | None) -> Column:
    """A mask's struct, which is there even if its path is null."""
    return F.struct(record_path(column, base).alias("pixel_array"))


def lung_rect(lung: Column, thorax: Column) -> Column:
    """The box around both, its far edges exclusive; none without both."""
    return F.when(lung.isNotNull() & thorax.isNotNull(), F.struct(
        F.least(lung["min_x"], thorax["min_x"]).alias("x_min"), F.least(lung["min_y"], thorax["min_y"]).alias("y_min"),
        (F.greatest(lung["max_x"], thorax["max_x"]) + 1).alias("x_max"), (F.greatest(lung["max_y"], thorax["max_y"]) + 1).alias("y_max"),
    ))


def _blank(column: str) -> Column:
    return F.nullif(F.col(column), F.lit(""))


#: A sample's columns by name, of the folder that paths are written below; a new column is a line here (X4). Labels come
#: with the row (case_labels(), enrichment), measurements of pixels too.
FIELD_BUILDERS: dict[str, Callable[[str | None], Column]] = {
    "patient_id": lambda base: _blank("patient_id"),
    "dicom_file": lambda base: record_path("image_path", base),
    "image_file": lambda base: record_path("image_file", base),
    "pixel_spacing": lambda base: spacing(F.col("spacing_x"), F.col("spacing_y")),
    "image_shape": lambda base: F.when(F.col("shape_w").isNotNull() & F.col("shape_h").isNotNull(), F.struct(F.col("shape_h").alias("height"), F.col("shape_w").alias("width"))),
    "facility_id": lambda base: _blank("institution"),
    "vendor_id": lambda base: _blank("manufacturer"),
    "view_position": lambda base: view_position(F.col("case_labels")),
    "pneumothorax_case": lambda base: F.col("pneumothorax_case"),
    "abnormal_finding_status": lambda base: F.col("abnormal_finding_status"),
    "pneumothorax_side": lambda base: F.col("pneumothorax_side"),
    "bulla_bleb_status": lambda base: F.col("bulla_bleb_status"),
    "pleural_effusion_status": lambda base: F.col("pleural_effusion_status"),
    "pneumothorax_mask": lambda base: mask("mask_path", base),
    "lung_mask": lambda base: mask("lung_mask_path", base),
    "thorax_mask": lambda base: mask("thorax_mask_path", base),
    "lung_rect": lambda base: lung_rect(F.col("lung_box"), F.col("thorax_box")),
    "pneumothorax_area_pix2": lambda base: F.col("pneumothorax_pixels"),
    "pneumothorax_area_mm2": lambda base: F.col("pneumothorax_area"),
}
_BOX = "struct<min_x:int,min_y:int,max_x:int,max_y:int>"
#: Of what an image may lack, null by then.
MEASURED = {
    "image_file": "string", "mask_path": "string", "lung_mask_path": "string", "thorax_mask_path": "string", "lung_box": _BOX, "thorax_box": _BOX,
    "pneumothorax_pixels": "bigint", "pneumothorax_area": "double", "pneumothorax_side": "string",
}


def labelled(images: DataFrame, config: dict = settings.DEFAULTS) -> DataFrame:
    """Images with ann_labels, and the columns of case_labels() beside (L10); no annotation names a side."""
    out = images.withColumns(case_labels(config))
    return out if "pneumothorax_side" in out.columns else out.withColumn("pneumothorax_side", F.lit(None).cast("string"))


def samples(images: DataFrame, base: str | None = None) -> DataFrame:
    """sample_id (the file's name) and the 19 fields of labelled images (P5)."""
    known = images.withColumns({c: F.lit(None).cast(kind) for c, kind in MEASURED.items() if c not in images.columns})
    return known.select(F.col("file").alias("sample_id"), *[f(base).alias(k) for k, f in FIELD_BUILDERS.items()])


def report_in_scope(report: Column, statuses: list[str]) -> Column:
    """without statuses all; without a report none."""
    return F.lit(True) if not statuses else F.coalesce(report["pneumothorax_status"].isin(*statuses), F.lit(False))


def export_groups(images: DataFrame, datasets: list[str], statuses: list[str], limit: int | None) -> tuple[DataFrame, DataFrame]:
    """Chosen images and counts of dropped ones by status (F10); the limit comes after the filters, in the order of file_uid."""
    here = images.filter(F.col("dataset_id").isin(*datasets)) if datasets else images
    inside = report_in_scope(F.col("report"), statuses)
    dropped = here.filter(~inside).groupBy(F.coalesce(F.col("report")["pneumothorax_status"], F.lit("no_report")).alias("status")).agg(F.count("*").alias("n"))
    chosen = here.filter(inside)
    return (chosen.orderBy("file_uid").limit(limit) if limit else chosen), dropped
