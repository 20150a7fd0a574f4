"""Nested documents, caches, stores, samples and incremental ingestion."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from adjudica.functions import samples
from adjudica.schema import VERDICT_DDL
from adjudica.sources import artifacts, nested
from adjudica.streaming import incremental

LABEL = {"code_system": "Findings", "code": "010", "code_text_eng": "pneumothorax", "confidence": 1.0, "label_id": 1}
NORMAL = {"code_system": "No Findings", "code": "001", "code_text_eng": "normal", "label_id": 2}


def _annotation(uid, **more):
    return {"annotation_type": "brush", "geometry_id": 1, "geometry_uid": uid, "path_mask": f"mask/{uid}.png", "timestamp": "2026-01-01T00:00:00+00:00", "labels": [LABEL, {**LABEL, "label_id": 9}], **more}


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("sources")
    study = {
        "patient_id": "p", "study_date": "20260101", "annotations": [{"annotation_id": 1, "labels": [NORMAL]}], "report_labels": {"pneumothorax_status": "present", "finding_labels_observed": ["x", "hemothorax", "pleural_effusion"]},
        "series_list": {"S1": {"shape": {"w": 10, "h": 20}, "spacing": {"x": 0.1}, "annotations": [], "file_list": {
            "b": {"image_path": "image/b", "annotations": [_annotation("g1", min_x=1), _annotation("g2", timestamp="never")]}, "a": {"image_path": "image/a", "annotations": []}}}},
    }
    (home / "engineer-set-DS-20260102_030405.json").write_text(json.dumps({"dataset": {"INST": {"ST": study}}}))
    (home / "engineer-set-BAD-20260102_030405.json").write_text("not json")
    paths = nested.resolve([str(home / "*.json"), str(home / "*DS*.json")])
    assert len(paths) == 2 and nested.resolve([str(home / "*.json")], ["BAD"]) == [str(home / "engineer-set-DS-20260102_030405.json")]
    return nested.documents(spark, paths), paths


def test_nested(spark, docs):
    d, paths = docs
    assert [r[0] for r in nested.rejected(d).collect()] == ["engineer-set-BAD-20260102_030405.json"]
    imgs = nested.images(d)
    got = [(r["file"], r["series_image_index"], r["series_image_count"], r["dataset_id"], len(r["records"])) for r in imgs.orderBy("file").collect()]
    assert got == [("a", 0, 2, "DS", 0), ("b", 1, 2, "DS", 2)]
    assert imgs.first()["file_uid"].startswith("engineer-set-DS-20260102_030405.json::INST/ST/S1/")
    report = imgs.first()["report"]
    assert report["pleural_effusion_findings"] == ["pleural_effusion", "hemothorax"] and report["observed_finding_count"] == 3 and report["bulla_bleb_status"] == "unknown"
    ann = nested.annotations(imgs)
    got = [(r["geometry_uid"], r["ann_index"], r["min_x"], r["min_y"], r["region_count"], len(r["labels"]), r["stamp"] is None) for r in ann.orderBy("ann_index").collect()]
    assert got == [("g1", 0, 1, 0, None, 1, False), ("g2", 1, 0, 0, None, 1, True)]
    assert nested.geometry_free_count(d).first()["n"] == 1
    assert ann.filter(nested.in_scope(F.col("labels"), ["Findings/010"])).count() == 2 and ann.filter(nested.in_scope(F.col("labels"), ["nodule"])).count() == 0
    assert artifacts.fingerprint(spark, paths) == artifacts.fingerprint(spark, paths)


def test_samples(docs):
    imgs = nested.images(docs[0])
    found = F.flatten(F.transform("records", lambda r: r["labels"]))
    labelled = samples.labelled(imgs.withColumn("ann_labels", found))
    got = {r["file"]: r for r in labelled.collect()}
    assert (got["a"]["pneumothorax_case"], got["a"]["abnormal_finding_status"], got["a"]["case_evidence"]) == (False, "absent", "explicit_negative_normal")
    assert (got["b"]["pneumothorax_case"], got["b"]["findings"], got["b"]["bulla_bleb_status"]) == (True, ["pneumothorax"], "unknown")
    made = samples.samples(labelled.withColumn("lung_box", F.struct(*[F.lit(v).alias(k) for k, v in (("min_x", 1), ("min_y", 2), ("max_x", 5), ("max_y", 6))])).withColumn("thorax_box", F.struct(*[F.lit(v).alias(k) for k, v in (("min_x", 0), ("min_y", 3), ("max_x", 9), ("max_y", 4))])))
    a = made.filter("sample_id = 'a'").first()
    assert a["pixel_spacing"] is None and a["image_shape"].asDict() == {"height": 20, "width": 10} and a["lung_rect"].asDict() == {"x_min": 0, "y_min": 2, "x_max": 10, "y_max": 7}
    assert len(made.columns) == 20 and a["pneumothorax_mask"]["pixel_array"] is None and a["vendor_id"] is None
    assert samples.samples(labelled).first()["lung_rect"] is None
    chosen, dropped = samples.export_groups(imgs, ["DS"], ["absent"], None)
    assert chosen.count() == 0 and rows(dropped) == [("present", 2)]


def test_round_trip(spark, docs):
    imgs = nested.images(docs[0])
    flat = imgs.select("source_json", "institution", "study", "series", "file", "image_path", F.explode_outer("records").alias("annotation"))
    value = json.loads(artifacts.nested_documents(flat).first()["value"])
    files = value["dataset"]["INST"]["ST"]["series_list"]["S1"]["file_list"]
    assert list(files) == ["a", "b"] and len(files["b"]["annotations"]) == 2 and files["a"].get("annotations", []) == []


def test_store(spark, tmp_path):
    (tmp_path / "v1.json").write_text(json.dumps([{"kind": "image", "file_uid": "engineer-set-DS-20260102_030405.json::I/S/X/f", "decision": "keep"}, {"kind": "image", "file_uid": "broken"}]))
    got = artifacts.read_verdicts(spark, str(tmp_path / "v1.json"), version=1).collect()
    assert [(r["dataset_id"], r["key"]) for r in got] == [("DS", "I/S/X/f")]
    (tmp_path / "cache.jsonl").write_text('{"file_uid": "a", "n_masks": 1}\nbroken\n{"file_uid": "b", "n_masks": 2}\n')
    files = spark.createDataFrame([("a",)], "file_uid string")
    assert rows(artifacts.read_cache(spark, str(tmp_path / "cache.jsonl"), "file_uid string, n_masks int", files)) == [("a", 1)]
    (tmp_path / "s.json").write_text(json.dumps({"meta": {"content_type": "dataset"}, "samples": {"x": {"a": 1}, "y": {"a": None}}}))
    assert rows(artifacts.read_samples(spark, str(tmp_path / "s.json"), "a: int"), "sample_id") == [("x", 1), ("y", None)]
    assert artifacts.merge_meta(str(tmp_path / "m.json"), {"a": 1}) == {"a": 1} and artifacts.merge_meta(str(tmp_path / "m.json"), {"b": 2}) == {"a": 1, "b": 2}


def test_stream(spark, tmp_path):
    def put(name, *verdicts):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("\n".join(json.dumps({"kind": "image", "dataset_id": "D", "key": k, "decision": d, "reviewed_at": t}) for k, d, t in verdicts))

    def run():
        incremental.merge_stream(spark, str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "cp")).awaitTermination(60)
        return {r["key"]: r["decision"] for r in incremental.current(spark, str(tmp_path / "store")).collect()}

    assert incremental.current(spark, str(tmp_path / "store")) is None
    put("1.json", ("a", "keep", "1"), ("a", "exclude", "2"), ("b", "keep", "1"))
    assert run() == {"a": "exclude", "b": "keep"}
    put("2.json", ("a", "keep", "1"), ("b", "exclude", "5"), ("c", "keep", "1"))
    assert run() == {"a": "exclude", "b": "exclude", "c": "keep"}
    put("3.json", ("c", "exclude", "1"), ("d", "keep", "1"))  # no stamp decides: the batch stops and nothing of it is written
    with pytest.raises(Exception, match="no stamp decides"):
        run()
    assert {r["key"] for r in incremental.current(spark, str(tmp_path / "store")).collect()} == {"a", "b", "c"}
    assert "decision" in VERDICT_DDL
