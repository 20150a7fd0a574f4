"""Adapters: what a source format gives to the checks, and what it can't.

An adapter reads its documents into the tables of images and annotations that everything else works on, names the evidence
that there is, and the rules of its paths. What needs evidence that is not there is cannot_determine, never passed.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.operators import checks
from adjudica.sources import nested

#: Evidence that a dataset may offer (fixed values).
CAPABILITIES = ("has_dicom", "has_spacing", "has_original_mask", "has_lung_reference", "has_thorax_reference", "has_mediastinum_reference")
#: What checks need; the others need none.
NEEDS = {
    "M01_MASK_RESOLUTION": ("has_dicom",), "S03_TINY_ANNOTATION": ("has_spacing",), "S04_ORIGINAL_FINAL_DIVERGENCE": ("has_original_mask",),
    "S05_OUTSIDE_BODY": ("has_lung_reference", "has_thorax_reference", "has_mediastinum_reference"),
}


@runtime_checkable
class Adapter(Protocol):
    def images(self, spark: SparkSession) -> DataFrame: ...

    def annotations(self, spark: SparkSession) -> DataFrame: ...

    def capabilities(self) -> frozenset[str]: ...

    def path_invariants(self) -> dict[str, str]: ...


@dataclass
class NestedAdapter:
    """Nested JSON documents. reference_roots maps kinds to folders; one that is not there gives no evidence."""

    patterns: list[str]
    exclude: list[str] = field(default_factory=list)
    reference_roots: dict[str, str] = field(default_factory=dict)

    def images(self, spark: SparkSession) -> DataFrame:
        return nested.images(nested.documents(spark, nested.resolve(self.patterns, self.exclude)))

    def annotations(self, spark: SparkSession) -> DataFrame:
        return nested.annotations(self.images(spark))

    def capabilities(self) -> frozenset[str]:
        found = {f"has_{kind}_reference" for kind, root in self.reference_roots.items() if root and os.path.isdir(root)}
        return frozenset(("has_dicom", "has_spacing", "has_original_mask")) | (found & set(CAPABILITIES))

    def path_invariants(self) -> dict[str, str]:
        """Roots, depth and names of paths of this format (fixed values)."""
        return {
            "image_path_root": "medical2", "annotation_path_root": "annotation", "image_path_depth": "8",
            "mask_stem_equals": "geometry_uid", "image_stem_equals": "file_id",
        }


def path_settings(adapter: Adapter) -> dict:
    """roots and depth of a checks.Context, by an adapter's path invariants."""
    rules = adapter.path_invariants()
    roots = {"image_path": rules["image_path_root"], "path_mask": rules["annotation_path_root"], "path_original_mask": rules["annotation_path_root"]}
    return {"roots": roots, "depth": int(rules["image_path_depth"])}


def capability_report(adapter: Adapter, spark: SparkSession) -> DataFrame:
    """capability and available, for all of CAPABILITIES."""
    has = adapter.capabilities()
    return spark.createDataFrame([(c, c in has) for c in CAPABILITIES], "capability string, available boolean")


def unverifiable(annotations: DataFrame, adapter: Adapter) -> DataFrame:
    """An issue cannot_determine of each annotation and check whose evidence the adapter lacks."""
    has = adapter.capabilities()
    gaps = [(check, [n for n in need if n not in has]) for check, need in NEEDS.items()]
    gaps = F.array(*[F.struct(F.lit(check).alias("check"), F.lit("|".join(missing)).alias("missing")) for check, missing in gaps if missing] or [F.lit(None).cast("struct<check:string,missing:string>")])
    df = annotations.withColumn("_gap", F.explode(F.array_compact(gaps)))
    return checks.issues(df, F.col("_gap.check"), "machine", "info", "cannot_determine", F.concat(F.lit("no_"), F.regexp_replace("_gap.missing", "has_", "")))
