"""The counts of a sample set's charts on rows with nulls, and templates."""

import json

import pytest

from adjudica.operators import distribution
from adjudica.sources import artifacts

DDL = """facility_id string, patient_id string, pneumothorax_case boolean, pneumothorax_side string, bulla_bleb_status string, abnormal_finding_status string, view_position string, vendor_id string,
pixel_spacing struct<x: double, y: double>, image_shape struct<height: int, width: int>, pneumothorax_area_mm2 double, pneumothorax_mask struct<pixel_array: string>, lung_mask struct<pixel_array: string>, thorax_mask struct<pixel_array: string>"""
ROWS = [
    ("F1", "1", True, "left", "present", "absent", "PA", None, (0.2, 0.2), (2000, 1000), 0.5, ("m.png",), ("",), None),
    ("F1", "1", True, None, "unknown", "present", None, None, (0.4, 0.4), (2000, 1000), 2e9, None, None, None),
    ("F2", "1", False, None, "unknown", "present", "PA", "v", None, (2000, 1000), 0.0, ("m.png",), None, None),
    (None, None, None, None, None, None, None, None, None, None, None, None, None, None),
]


def test_distribution(spark):
    got = {(r["chart"], r["field"], r["value"]): r["images"] for r in distribution.distribution(spark.createDataFrame(ROWS, DDL)).collect()}
    assert got["00_overview", "samples", "total"] == 4 and got["00_overview", "patients", "unique (facility, patient)"] == 3 and got["00_overview", "patients", "with pneumothorax"] == 1
    assert [got["02_case_vs_mask", f"Pneumothorax case = {t}", f"mask {m}"] for t in ("true", "false") for m in ("present", "absent")] == [1, 1, 1, 1]
    assert got["03_side", "pneumothorax_side", "left"] == 1 and got["03_side", "pneumothorax_side", "unknown (null)"] == 1
    assert got["05_area", "pneumothorax_area_mm2", "[1, 2) mm2"] == 1 and got["05_area", "pneumothorax_area_mm2", "[56234, 100000) mm2"] == 1  # beyond both ends
    assert got["09_physical_width", "image_shape.width * pixel_spacing.x", "[200, 250) mm"] == 1 and got["09_physical_width", "image_shape.width * pixel_spacing.x", "[400, 10000) mm"] == 1
    assert got["06_facility", None, "images"] == 1 and got["04_mask_coverage", "lung_mask", "missing"] == 4
    empty = distribution.distribution(spark.createDataFrame([], DDL)).collect()
    assert {r["images"] for r in empty} == {0} and not {"05_area", "06_facility"} & {r["chart"] for r in empty}


def test_facility_shares(spark):
    got = {(r["facility"], r["other"]): (r["facilities"], r["images"], r["with_mask"], r["without_mask"], r["others"]) for r in distribution.distribution_charts(distribution.distribution(spark.createDataFrame(ROWS, DDL)), top=1).collect()}
    assert got == {("F1", False): (1, 2, 50.0, 50.0, 0.0), (None, True): (2, 2, 50.0, -50.0, 100.0)}


def test_templates(tmp_path):
    structure = {"sides": {"type": "string", "multiple": True}, "view": {"type": "string"}}
    (tmp_path / "a.json").write_text(json.dumps({"meta": {"structure": structure}}))
    assert artifacts.read_template(str(tmp_path / "a.json")) == structure
    assert artifacts.multiple_fields(structure) == {"sides"}
    pytest.importorskip("yaml")
    (tmp_path / "a.yaml").write_text("meta:\n  name: x\n  structure:\n    sides: {type: string, multiple: true}\n    view:\n      type: string\n")
    assert artifacts.read_template(str(tmp_path / "a.yaml")) == structure
    for n, text in enumerate(("meta: [", "[]", "meta: {structure: {}}", "name: x", "")):
        (tmp_path / f"bad{n}.yaml").write_text(text)
        with pytest.raises(ValueError):
            artifacts.read_template(str(tmp_path / f"bad{n}.yaml"))
