"""Nested source documents as flat tables (SC1–SC9)."""

from __future__ import annotations

import glob
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica import ids
from adjudica.operators.rollups import ordinals
from adjudica.schema import SOURCE_DDL

#: The findings that a report's list may name, in this order (fixed values).
OBSERVED = ("pleural_effusion", "hemothorax")


def resolve(patterns: list[str], exclude: list[str] = ()) -> list[str]:
    """Files of the patterns in order, each once, without those whose name holds an excluded part (SC1, SC2)."""
    found = [p for pattern in patterns for p in (sorted(glob.glob(os.path.normpath(pattern))) if glob.has_magic(pattern) else [pattern])]
    return [p for p in dict.fromkeys(found) if not any(x in os.path.basename(p) for x in exclude)]


def documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """source_json and doc of each document; one that can't be read has a null doc (see rejected)."""
    raw = spark.read.text(paths, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_name"), "/"), -1).alias("source_json"), "value")
    return raw.select("source_json", F.from_json("value", SOURCE_DDL).alias("doc"))


def rejected(docs: DataFrame) -> DataFrame:
    """Documents that are no source: skipped, and reported."""
    return docs.filter("doc is null or doc.dataset is null").select("source_json")


def _case_labels(container: Column) -> Column:
    return F.flatten(F.transform(F.coalesce(container, F.array()), lambda a: F.coalesce(a["labels"], F.array())))


def studies_of(docs: DataFrame) -> DataFrame:
    """source_json, institution, study and s, the study's struct, of whole documents; nested_text.studies() reads them in parts."""
    d = docs.filter("doc.dataset is not null").select("source_json", F.explode("doc.dataset").alias("institution", "studies"))
    return d.select("source_json", "institution", F.explode("studies").alias("study", "s"))


def images(docs: DataFrame) -> DataFrame:
    """A row for each image, with its records (an array), labels of the case, and its place in the series."""
    return images_of(studies_of(docs))


def images_of(studies: DataFrame) -> DataFrame:
    """images() of a table of studies."""
    d = studies.select("source_json", "institution", "study", "s", F.explode("s.series_list").alias("series", "x"))
    d = d.select("source_json", "institution", "study", "s", "series", "x", F.explode("x.file_list").alias("file", "f"))
    dataset = F.coalesce(F.nullif(F.col("f.dataset_id"), F.lit("")), ids.dataset_of(F.col("source_json")))
    path = [F.col(c) for c in ("institution", "study", "series", "file")]
    labels = F.array_distinct(F.concat(_case_labels(F.col("s.annotations")), _case_labels(F.col("x.annotations"))))
    flat = d.select(
        "source_json", dataset.alias("dataset_id"), "institution", "study", "series", "file", ids.file_uid(F.col("source_json"), *path).alias("file_uid"),
        ids.stable_file_uid(dataset, *path).alias("stable_file_uid"), ids.export_stamp(F.col("source_json")).alias("export_stamp"),
        F.col("s.patient_id").alias("patient_id"), F.col("s.study_date").alias("study_date"), F.col("x.shape.w").alias("shape_w"), F.col("x.shape.h").alias("shape_h"),
        F.col("x.spacing.x").alias("spacing_x"), F.col("x.spacing.y").alias("spacing_y"), F.col("x.manufacturer").alias("manufacturer"),
        F.col("f.image_path").alias("image_path"), labels.alias("case_labels"), report_labels(F.col("s.report_labels")).alias("report"), F.coalesce("f.annotations", F.array()).alias("records"),
    )
    placed = ordinals(flat, ["source_json", "institution", "study", "series"], ["file"])
    return placed.withColumnsRenamed({"index": "series_image_index", "count": "series_image_count"})


def report_labels(r: Column) -> Column:
    """A report's labels, missing statuses unknown, known findings in their own order (SC7); null without a report."""
    status = lambda c: F.coalesce(F.nullif(r[c], F.lit("")), F.lit("unknown")).alias(c)
    seen = F.coalesce(r["finding_labels_observed"], F.array())
    known = F.filter(F.array(*[F.lit(x) for x in OBSERVED]), lambda x: F.array_contains(seen, x))
    listed = lambda c: F.coalesce(r[c], F.array().cast("array<string>")).alias(c)
    counts = lambda c: F.coalesce(r[c], F.create_map().cast("map<string,int>")).alias(c)
    as_is = ("pneumothorax_side", "pneumothorax_subtype", "pneumothorax_evidence", "pneumothorax_certainty_max", "bulla_bleb_evidence", "bulla_bleb_certainty_max", "pleural_effusion_evidence", "pleural_effusion_certainty_max")
    return F.when(r.isNotNull(), F.struct(
        status("pneumothorax_status"), status("bulla_bleb_status"), status("pleural_effusion_status"), *[r[c].alias(c) for c in as_is],
        *[counts(c) for c in ("pneumothorax_certainty_counts", "pneumothorax_absent_certainty_counts", "bulla_bleb_certainty_counts")], listed("pleural_effusion_flags"), listed("flags"),
        known.alias("pleural_effusion_findings"), F.size(seen).alias("observed_finding_count"), F.coalesce(r["needs_review"], F.lit(False)).alias("needs_review"),
        *[r[c].alias(c) for c in ("study_name", "source_dataset_id", "source_json", "schema_version")],
    ))


def annotations(imgs: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """A row for each annotation (SC4, SC5): bounds, is_latest and version are 0 where missing, other counts stay null.

    also names what rows keep of the image besides: report, case_labels.
    """
    keep = [c for c in imgs.columns if c in also or c not in ("records", "report", "case_labels")]
    a = imgs.select(*keep, F.posexplode("records").alias("ann_index", "a"))
    zero = lambda c: F.coalesce(F.col(f"a.{c}"), F.lit(0)).alias(c)
    own = lambda c: F.col(f"a.{c}").alias(c)
    labels = distinct_labels(F.coalesce("a.labels", F.array()))
    return a.select(
        *keep, "ann_index", ids.annotation_uid(F.col("dataset_id"), F.col("a.geometry_uid")).alias("annotation_uid"), own("annotation_type"), own("geometry_id"), own("geometry_uid"),
        own("path_mask"), own("path_original_mask"), zero("min_x"), zero("min_y"), zero("max_x"), zero("max_y"), F.col("a.width").alias("declared_w"), F.col("a.height").alias("declared_h"),
        own("region_count"), F.try_to_timestamp(F.col("a.timestamp")).alias("stamp"), own("user"), zero("version"), zero("is_latest"), own("annotation_request"), own("comment"),
        labels.alias("labels"), ids.label_keys(labels).alias("label_keys"), ids.label_family(labels).alias("family"),
    )


def distinct_labels(labels: Column) -> Column:
    """Labels without repeats in all but label_id, the first kept."""
    bare = lambda x: F.struct(x["code"], x["code_system"], x["code_text"], x["code_text_eng"], x["confidence"])
    return F.filter(labels, lambda x, i: F.array_position(F.transform(labels, bare), bare(x)) == i + 1)


def geometry_free_count(docs: DataFrame) -> DataFrame:
    """n: annotations of studies and series, which have no geometry (SC6)."""
    study = docs.select(F.explode("doc.dataset").alias("i", "studies")).select(F.explode("studies").alias("k", "s"))
    series = study.select(F.explode("s.series_list").alias("k", "x")).select(F.size(F.coalesce("x.annotations", F.array())).alias("n"))
    return study.select(F.size(F.coalesce("s.annotations", F.array())).alias("n")).union(series).agg(F.sum("n").alias("n"))


def in_scope(labels: Column, names: list[str]) -> Column:
    """Whether a label is a target, by system/code or by English name; without targets all are (F1)."""
    if not names:
        return F.lit(True)
    keys, plain = [n for n in names if "/" in n], [n for n in names if "/" not in n]
    return F.coalesce(F.exists(labels, lambda x: ids.qualified_code(x).isin(*keys or [""]) | x["code_text_eng"].isin(*plain or [""])), F.lit(False))
