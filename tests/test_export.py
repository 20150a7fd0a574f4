"""Enrichment, export, stores, runs and adapters on small tables."""

import json
import os

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from adjudica.functions import raster
from adjudica.operators import build, contracts, enrichment, export, ladders, review, rollups
from adjudica.schema import VERDICT_DDL
from adjudica.sources import adapters, artifacts

REPORT = "struct<schema_version:int,pneumothorax_status:string,pneumothorax_side:string,bulla_bleb_status:string,pleural_effusion_status:string,pneumothorax_evidence:string,observed_finding_count:int>"
DDL = f"id string, pneumothorax_case boolean, case_evidence string, pneumothorax_side string, bulla_bleb_status string, pleural_effusion_status string, report {REPORT}"
YES, NO, OPEN = "explicit_positive_annotation", "explicit_negative_normal", "unconfirmed"


def test_report(spark):
    def report(status, side=None, bulla="unknown", effusion="unknown", evidence="text", n=0, version=2):
        return (version, status, side, bulla, effusion, evidence, n)

    df = spark.createDataFrame([
        ("none", False, OPEN, None, "unknown", "unknown", None), ("up", False, OPEN, None, "unknown", "unknown", report("present", "left", "absent", "present")),
        ("confirmed", False, OPEN, None, "unknown", "unknown", report("absent")), ("other", False, OPEN, None, "unknown", "unknown", report("absent", n=1)),
        ("no report", False, OPEN, None, "unknown", "unknown", report("absent", evidence="no_report")), ("null evidence", False, OPEN, None, "unknown", "unknown", report("absent", evidence=None)),
        ("kept", True, YES, "right", "present", "absent", report("absent", "left", "absent", "present")), ("normal", False, NO, None, "unknown", "absent", report("present", "left", version=None)),
    ], DDL)
    got = {r["id"]: r for r in enrichment.with_report(df).collect()}
    what = lambda r: (r["pneumothorax_case"], r["case_evidence"], r["pneumothorax_side"], r["bulla_bleb_status"], r["pleural_effusion_status"], [tuple(c) for c in r["changes"]], [tuple(c) for c in r["conflicts"]])
    assert what(got["none"]) == (False, OPEN, None, "unknown", "unknown", [], [])
    assert what(got["up"]) == (True, "report_positive", "left", "absent", "present", [
        ("pneumothorax_case", "false", "true", "report_positive"), ("pneumothorax_side", None, "left", "report_side"), ("bulla_bleb_status", "unknown", "absent", "report_bulla_bleb"),
        ("pleural_effusion_status", "unknown", "present", "report_pleural_effusion")], [])
    assert what(got["confirmed"])[:2] == (False, "explicit_negative_report") and got["confirmed"]["changes"][0]["reason"] == "report_confirmed_negative"
    assert {got[k]["case_evidence"] for k in ("other", "no report", "null evidence")} == {OPEN}
    assert what(got["kept"])[:5] == (True, YES, "right", "present", "absent")
    assert [tuple(c) for c in got["kept"]["conflicts"]] == [
        ("pneumothorax_case", "true", "absent", "never_downgrade"), ("pneumothorax_side", "right", "left", "side_already_set"), ("bulla_bleb_status", "present", "absent", "never_downgrade"),
        ("pleural_effusion_status", "absent", "present", "explicit_negative_wins")]
    assert what(got["normal"])[:3] == (False, NO, None) and [c["reason"] for c in got["normal"]["conflicts"]] == ["explicit_negative_wins"]
    for bad in (report("present", "up"), report("present", version=1)):
        with pytest.raises(Exception, match="unknown"):
            enrichment.with_report(spark.createDataFrame([("x", False, OPEN, None, "unknown", "unknown", bad)], DDL)).collect()
    assert enrichment.with_report(df.limit(0)).count() == 0


def test_merged_samples(spark):
    ddl = "sample_id string, pneumothorax_case boolean, pneumothorax_side string, bulla_bleb_status string, pleural_effusion_status string, image_file string"
    p = spark.createDataFrame([("a", False, None, "unknown", "absent", "p"), ("b", False, None, "present", "unknown", "p"), ("c", True, "left", "unknown", "unknown", "p"), ("only", None, None, "unknown", "unknown", "p")], ddl)
    s = spark.createDataFrame([("a", True, "left", "present", "present", "s"), ("b", True, "right", "absent", "present", "s"), ("c", False, "right", "unknown", "unknown", "s"), ("new", True, "left", "absent", "absent", "s")], ddl)
    got = {r["sample_id"]: r for r in enrichment.merged_samples(p, s, spark.createDataFrame([("a",), ("zz",)], "sample_id string")).collect()}
    assert set(got) == {"a", "b", "c", "only", "new"}
    assert got["a"][1:7] == (False, None, "present", "absent", "p", "both") and [c["reason"] for c in got["a"]["conflicts"]] == ["explicit_negative_wins", "explicit_negative_wins"]
    assert got["b"][1:7] == (True, "right", "present", "present", "p", "both") and [c["reason"] for c in got["b"]["conflicts"]] == ["never_downgrade"]
    assert got["c"][1:3] == (True, "left") and [c["field"] for c in got["c"]["conflicts"]] == ["pneumothorax_case", "pneumothorax_side"]
    assert got["only"][1] is None and got["only"]["origin"] == "primary" and got["new"]["origin"] == "secondary" and got["new"]["changes"] == [] and got["new"]["image_file"] == "s"


def test_dataset_file(spark, tmp_path):
    odd = 'q"\\ü\n'
    df = spark.createDataFrame([("b", 1, None, (None,)), (odd, None, ["x"], ("m",))], "sample_id string, z int, a array<string>, mask struct<pixel_array:string>")
    export.write_dataset(df, {"owner": "me", "content_type": "dataset"}, str(tmp_path / "d"))
    text = "".join(open(tmp_path / "d" / p, encoding="utf-8").read() for p in sorted(os.listdir(tmp_path / "d")) if p.startswith("part"))
    got = json.loads(text)
    assert got["meta"]["owner"] == "me" and got["samples"] == {"b": {"a": None, "mask": {"pixel_array": None}, "z": 1}, odd: {"a": ["x"], "mask": {"pixel_array": "m"}, "z": None}}
    assert list(got["samples"]["b"]) == ["a", "mask", "z"]
    assert rows(artifacts.read_sample_lines(spark, str(tmp_path / "d"), "z INT").filter("z = 1")) == [("b", 1)]
    export.write_dataset(df.limit(0), {}, str(tmp_path / "e"))
    assert json.loads("".join(open(tmp_path / "e" / p).read() for p in sorted(os.listdir(tmp_path / "e")) if p.startswith("part"))) == {"meta": {}, "samples": {}}
    with pytest.raises(ValueError, match="no sample of its own"):
        export.write_dataset(df.union(df), {}, str(tmp_path / "f"))
    counted = rows(export.counters(df.withColumns({"abnormal_finding_status": F.lit("x"), "pneumothorax_case": F.lit(True), "case_evidence": F.lit("e")}), fields=["z", "a", "mask"]))
    assert ("null", "mask", 1) in counted and ("null", "a", 1) in counted and ("status_case", "x/true", 2) in counted
    assert export.unresolved({"owner": "<owner>", "b": "x < y", "a": "see <here>", "n": 1}) == ["a=see <here>", "owner=<owner>"]
    names = spark.createDataFrame([("X_PNEUMOTHORAX",), ("abnormal_non_pneumothorax",), ("x",)], "n string")
    assert [r[0] for r in names.select(export.named_as(F.col("n"))).collect()] == [True, False, False]


def test_issue_table(spark, tmp_path):
    df = spark.createDataFrame([("M01", None, ["a", "b"], {"z": "1", "a": "2"}), ("M00", "x", None, None)], "check_id string, message string, related_geometry_uids array<string>, detail map<string,string>")
    artifacts.write_issues(df, str(tmp_path / "i"))
    got = spark.read.csv(str(tmp_path / "i" / "csv"), header=True, escape="\\")
    assert tuple(got.columns) == artifacts.ISSUE_COLUMNS and len(got.columns) == 21
    flat = {r["check_id"]: r for r in artifacts.issue_table(df).collect()}
    assert flat["M01"]["detail"] == '{"a":"2","z":"1"}' and flat["M01"]["related_geometry_uids"] == "a|b" and flat["M00"]["detail"] == "{}" and flat["M01"]["message"] == ""


def test_verdict_store(spark, tmp_path):
    row = lambda kind, key, decision, stamp: (kind, "d", key, decision, "r", "me", stamp, None, None)
    base = spark.createDataFrame([row("image", "1", "keep", "1"), row("annotation", "2", "keep", "1")], VERDICT_DDL)
    later = spark.createDataFrame([row("annotation", "2", "exclude", "2"), row("annotation", "0", "keep", "2"), ("image", None, "9", "keep", "r", "me", "1", None, None)], VERDICT_DDL)
    got = artifacts.write_verdicts(base, later, str(tmp_path / "s"))
    assert rows(got.select("kind", "key", "decision")) == [("annotation", "0", "keep"), ("annotation", "2", "exclude"), ("image", "1", "keep")]
    lines = [json.loads(x)["key"] for p in sorted(os.listdir(tmp_path / "s" / "json")) if p.startswith("part") for x in open(tmp_path / "s" / "json" / p)]
    assert lines == ["0", "2", "1"]
    with pytest.raises(Exception, match="no stamp decides"):
        artifacts.write_verdicts(base, spark.createDataFrame([row("image", "1", "exclude", "1")], VERDICT_DDL), str(tmp_path / "t"))
    assert not os.path.exists(tmp_path / "t")


def test_runs(tmp_path):
    assert artifacts.ordered_distinct(["b", "a", "b"]) == ["b", "a"]
    for name, at in (("20260101", 50), ("20260201", 10), ("20260301", None)):
        (tmp_path / name).mkdir()
        if at:
            (tmp_path / name / "selection").write_text("x")
            os.utime(tmp_path / name / "selection", (at, at))
    assert artifacts.newest_tagged(str(tmp_path), "selection").endswith("20260201/selection") and artifacts.newest_written(str(tmp_path), "selection").endswith("20260101")
    assert artifacts.newest_tagged(str(tmp_path / "none"), "x") is None and artifacts.newest_written(str(tmp_path), "x") is None and artifacts.runs(str(tmp_path / "none"), "x") == []
    got = artifacts.runs(str(tmp_path), "20260301")
    assert [r["fingerprint"] for r in got] == ["20260201", "20260101", "20260301"] and got[2]["is_current"] and not got[2]["artifacts"]["selection"]


def test_adapter(spark, tmp_path):
    a = adapters.NestedAdapter([str(tmp_path / "*.json")], reference_roots={"lung": str(tmp_path), "thorax": str(tmp_path / "none"), "mediastinum": ""})
    assert isinstance(a, adapters.Adapter) and not isinstance(object(), adapters.Adapter)
    assert dict(rows(adapters.capability_report(a, spark))) == {"has_dicom": True, "has_spacing": True, "has_original_mask": True, "has_lung_reference": True, "has_thorax_reference": False, "has_mediastinum_reference": False}
    ann = spark.createDataFrame([("d", "f", "g")], "dataset_id string, file_uid string, geometry_uid string")
    assert rows(adapters.unverifiable(ann, a).select("check_id", "status", "cannot_determine_reason")) == [("S05_OUTSIDE_BODY", "cannot_determine", "no_thorax_reference|mediastinum_reference")]
    a.reference_roots = {k: str(tmp_path) for k in ("lung", "thorax", "mediastinum")}
    assert adapters.unverifiable(ann, a).count() == 0 and adapters.path_settings(a)["depth"] == 8 and adapters.path_settings(a)["roots"]["image_path"] == "medical2"


def test_contracts(spark):
    rules = contracts.sample_rules(["pneumothorax_side", "pneumothorax_case"])
    df = spark.createDataFrame([("a", "left", False), ("b", "up", True), ("c", None, False)], "k string, pneumothorax_side string, pneumothorax_case boolean")
    assert rows(contracts.violations(df, rules, ["k"])) == [("a", "side_needs_case"), ("b", "side_vocabulary")]
    images = spark.createDataFrame([("a",), ("b",), ("c",)], "file_uid string")
    decided = spark.createDataFrame([("a",), ("b",), ("b",), ("x",)], "file_uid string")
    assert rows(contracts.image_violations(decided, images)) == [("b", "several_decisions"), ("c", "no_decision"), ("x", "no_image")]
    assert contracts.image_violations(images, images).count() == 0


def test_lookups(spark):
    found = spark.createDataFrame([("a", 1, "C2"), ("a", 1, "C1"), ("a", 1, "C1"), ("b", 1, "C1")], "d string, g int, check_id string")
    held = spark.createDataFrame([("a", 1), ("b", 2), (None, 1)], "d string, g int")
    assert {r["d"]: r["check_ids"] for r in ladders.with_issues(held, found, ["d", "g"]).collect()} == {"a": ["C1", "C2"], "b": [], None: []}
    df = spark.createDataFrame([("a", "brush"), ("a", "rect"), ("a", "brush"), ("b", None)], "i string, t string")
    assert [(r["i"], r["counts"]) for r in rollups.counts_by_type(df, ["i"], "t").collect()] == [("a", {"brush": 2, "rect": 1})]


def test_build(spark):
    images = spark.createDataFrame([("s", f, "i", "st", "se", f, f"p/{f}") for f in "abcde"], "source_json string, file_uid string, institution string, study string, series string, file string, image_path string")
    ddl = "file_uid string, annotation_uid string, ann_index int, annotation struct<geometry_uid:string>"
    ann = spark.createDataFrame([("a", "2", 1, ("2",)), ("a", "1", 0, ("1",)), ("b", "3", 0, ("3",)), ("c", "4", 0, ("4",)), ("d", "5", 0, ("5",)), ("a", "6", 2, ("6",))], ddl)
    said = spark.createDataFrame([("1", "keep"), ("2", "keep"), ("3", "exclude"), ("4", "keep"), ("5", "pending")], "annotation_uid string, decision string")
    seen = spark.createDataFrame([("c", "exclude"), ("d", "pending")], "file_uid string, decision string")
    built, numbers = build.build(images, ann, said, seen, losers=images.filter("file_uid in ('c', 'e')").select("file_uid"))
    assert {r["file_uid"]: [x["geometry_uid"] for x in r["annotations"]] for r in built.collect()} == {"a": ["1", "2"], "b": [], "d": []}
    assert numbers.first().asDict() == {
        "images_total": 5, "images_pending": 1, "images_dropped": 1, "duplicates_dropped": 1, "files_total": 3, "files_emptied": 2, "files_already_empty": 0,
        "kept": 2, "excluded": 1, "pending": 1, "uncertain": 0, "unknown": 2}
    value = json.loads(build.documents(built).first()["value"])
    files = value["dataset"]["i"]["st"]["series_list"]["se"]["file_list"]
    assert list(files) == ["a", "b", "d"] and [x["geometry_uid"] for x in files["a"]["annotations"]] == ["1", "2"]
    kept, numbers = build.build(images, ann, said, seen.limit(0), pending_as="keep")
    assert kept.filter("file_uid = 'd'").first()["annotations"][0]["geometry_uid"] == "5" and numbers.first()["unknown"] == 1
    assert build.build(images.limit(0), ann, said, seen)[1].first()["kept"] == 0


def test_view_kinds(spark):
    made = [({"SeriesDescription": "Chest LAT"}, None, None), ({"SeriesDescription": "吸気 max-exp"}, None, None), ({"ViewPosition": "Inspiration"}, None, None), ({}, {"ViewPosition": "呼気"}, None),
            ({"AcquisitionDeviceProcessingDescription": "PA"}, {"AcquisitionDeviceProcessingDescription": "PA"}, -600.0), ({"Rows": "1", "Columns": "2"}, {"Rows": "1", "Columns": "2"}, 5.0),
            ({"Rows": "1"}, {"Rows": "1"}, 601.0), (None, None, None)]
    df = spark.createDataFrame(made, "t map<string,string>, p map<string,string>, s double").select(review.view_kind(F.col("t"), F.col("p"), F.col("s")).alias("k"))
    assert [r["k"] for r in df.collect()] == ["lateral", "expiration", "inspiration", "paired_expiration", "same_view", "same_size", "unknown", "unknown"]
    assert df.select(review.view_text(F.col("k"))).first()[0] == review.VIEW_KINDS["lateral"]


def test_written_files(spark, tmp_path):
    image = np.arange(12, dtype=np.uint8).reshape(3, 4)
    df = spark.createDataFrame([("a/x.png", raster.write_png(image)), ("y.png", None), ("../z.png", b"z"), (None, b"n")], "name string, content binary")
    got = {r["name"]: r["status"] for r in raster.written_files(df, str(tmp_path / "out")).collect()}
    assert got == {"a/x.png": "written", "y.png": "empty", "../z.png": "error: not below the folder", None: "error: not below the folder"}
    assert (raster.read_png((tmp_path / "out" / "a" / "x.png").read_bytes()) == image).all() and not (tmp_path / "z.png").exists()
    assert raster.written_files(df.limit(1), str(tmp_path / "out")).first()["status"] == "exists" and raster.written_files(df.limit(1), str(tmp_path / "out"), force=True).first()["status"] == "written"
    assert sorted(os.listdir(tmp_path / "out" / "a")) == ["x.png"]


def test_issues_are_compressed_where_asked(spark, tmp_path):
    df = spark.createDataFrame([("S03_TINY", "b", "2", None), ("S03_TINY", None, "3", ["x", "y"]), ("D01_EXACT", "a", "1", ["z"])], "check_id string, dataset_id string, geometry_uid string, related_geometry_uids array<string>")
    artifacts.write_issues(df.coalesce(1), str(tmp_path / "i"), "gzip")
    assert not list((tmp_path / "i").glob("*/part-*.json")) + list((tmp_path / "i").glob("*/part-*.csv"))
    rows_ = spark.read.json(str(tmp_path / "i" / "json")).orderBy("geometry_uid").collect()
    assert [(r["dataset_id"], r["related_geometry_uids"], r["detail"]) for r in rows_] == [("a", "z", ""), ("b", "", ""), ("", "x|y", "")]
