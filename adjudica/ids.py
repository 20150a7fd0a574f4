"""Identities of images and annotations, once computed and never mixed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Families of findings by English label (fixed values); others are regional.
LABEL_FAMILIES = {
    "nodule": "focal", "multiple_granular_shadows": "focal",
    "atelectasis": "localized", "bulla_bleb": "localized", "cavity": "localized", "hilar_expansion": "localized", "hyperinflation": "localized",
    "pneumothorax": "regional", "pleural_effusion": "regional", "infiltrative_shadow": "regional", "interstitial_opacity": "regional", "pneumomediastinum": "regional",
    "mediastinum_enlargement": "regional", "aortic_protrusion": "regional",
    "fracture": "localized", "other": "regional",
}


def file_uid(source: Column, *path: Column) -> Column:
    """An image in this run: the source document and its path of keys."""
    return F.concat(source, F.lit("::"), F.concat_ws("/", *path))


def stable_file_uid(dataset: Column, *path: Column) -> Column:
    """An image over re-exports: the dataset and its path of keys."""
    return F.concat(dataset, F.lit("::"), F.concat_ws("/", *path))


def annotation_uid(dataset: Column, geometry: Column) -> Column:
    return F.concat(dataset, F.lit("::"), geometry)


def short_uid(uid: Column) -> Column:
    return F.substring(F.element_at(F.split(uid, "::"), -1), 1, 8)


def dataset_of(file_name: Column) -> Column:
    """The dataset of a source document: its stem without the prefix and the export stamp."""
    stem = F.regexp_replace(F.element_at(F.split(file_name, "/"), -1), r"\.json$", "")
    return F.regexp_replace(F.regexp_replace(stem, "^engineer-set-", ""), r"-\d{8}_\d{6}$", "")


def export_stamp(file_name: Column) -> Column:
    """When a source document was exported, by its name; null where the name doesn't say."""
    return F.try_to_timestamp(F.regexp_extract(file_name, r"(\d{8}_\d{6})\.json$", 1), F.lit("yyyyMMdd_HHmmss"))


def qualified_code(label: Column) -> Column:
    return F.concat_ws("/", label["code_system"], label["code"])


def label_keys(labels: Column) -> Column:
    """The set of (system, code) of labels, as a sorted array that compares by =."""
    return F.array_sort(F.array_distinct(F.transform(F.coalesce(labels, F.array()), lambda x: F.struct(x["code_system"], x["code"]))))


def label_family(labels: Column, families: dict[str, str] = LABEL_FAMILIES) -> Column:
    """The family of the first label."""
    first = F.lower(F.get(labels, F.lit(0))["code_text_eng"])
    out = F.lit("regional")
    for name, family in families.items():
        out = F.when(first == name, family).otherwise(out)
    return out
