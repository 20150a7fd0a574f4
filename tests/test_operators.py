"""Operators on small tables: every rung, tie, missing value and key."""

import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from adjudica import config, ids
from adjudica.operators import checks, components, contracts, ladders, merges, policy, reports, review, rollups, survivors
from adjudica.schema import FILES_DDL, MASKS_DDL, PAIRS_DDL


def test_config():
    c = config.with_overrides(config.DEFAULTS, ["tiny.annotation_mm2=5", "small.by_class.focal=1.5", "target_labels=[\"nodule\"]"])
    assert c["tiny"]["annotation_mm2"] == 5 and c["small"]["by_class"]["focal"] == 1.5 and c["target_labels"] == ["nodule"]
    assert config.DEFAULTS["tiny"]["annotation_mm2"] == 20.0
    with pytest.raises(KeyError):
        config.with_overrides(config.DEFAULTS, ["tiny.nothing=1"])


def test_policy():
    p = {"auto": ["D01"], "review": ["d01_exact_duplicate"], "informational": ["M06"]}
    assert policy.policy_for("D01_EXACT_DUPLICATE", p) == "review"
    assert policy.policy_for("D01_OTHER", p) == "auto"
    assert policy.policy_for("M06_PATH", p) == "informational"
    assert policy.policy_for("X", p) == "review"
    assert policy.policy_for("M01", {"auto": ["M01"], "review": ["M01"]}) == "auto"
    known = lambda c: policy.policy_for(c, config.DEFAULTS["policy"])
    assert known("M02_MASK_NOT_8BIT") == "auto" and known("M07_BBOX_DEGENERATE") == "review" and known("M07_SIZE_FIELDS_NULL") == "informational" and known("D05_CROSS_DATASET_DUPLICATE_TIE") == "review"
    assert known("M08_REGION_COUNT_MISMATCH") == "informational" and known("M01_MASK_RESOLUTION") == "auto" and known("D05_CROSS_DATASET_DUPLICATE") == "auto" and known("D04_CONTAINED_DIFFERENT_LABEL") == "review"
    assert policy.selected(["M01_A", "M02_B", "D01_C"], only=["M01", "D01"], skip=["D01_C"]) == ["M01_A"]


def test_ids(spark):
    df = spark.createDataFrame([("engineer-set-ABC-20260102_030405.json",), ("x.json",), (None,)], "n string")
    got = df.select(ids.dataset_of(F.col("n")).alias("d"), ids.export_stamp(F.col("n")).cast("string").alias("t")).collect()
    assert [tuple(r) for r in got] == [("ABC", "2026-01-02 03:04:05"), ("x", None), (None, None)]


def test_components(spark):
    edges = spark.createDataFrame([(2, 1), (2, 3), (9, 8), (3, 4), (7, 7), (5, None), (8, 10)], "a int, b int")
    assert rows(components.components(edges)) == [(1, 1), (2, 1), (3, 1), (4, 1), (7, 7), (8, 8), (9, 8), (10, 8)]
    assert components.components(edges.limit(0)).count() == 0
    chain = spark.range(0, 40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert rows(components.components(chain).select("label").distinct()) == [(0,)]
    labels = components.components(edges)
    order = spark.createDataFrame([(8, 0), (1, 5), (7, 2)], "node int, place int")
    assert {r["label"]: r["group_id"] for r in components.numbered_groups(labels, order, "DUP").collect()} == {8: "DUP_0001", 7: "DUP_0002", 1: "DUP_0003"}
    assert rows(components.star_clusters(edges.filter("b is not null"))) == [(1, 1), (1, 2), (3, 2), (3, 3), (3, 4), (8, 8), (8, 9), (8, 10)]
    assert rows(components.star_clusters(spark.createDataFrame([(1, 2), (2, 9), (3, 9)], "a int, b int"))) == [(1, 1), (1, 2), (9, 2), (9, 3), (9, 9)]


def test_star_clusters_of_chains_and_random_graphs(spark):
    rng = random.Random(3)
    graphs = [[(i, i + 1) for i in range(60)], [(i, rng.randrange(i)) for i in range(1, 80)], [(rng.randrange(30), rng.randrange(30)) for _ in range(45)]]
    for pairs in graphs:
        linked, order = {}, []
        for a, b in sorted({(min(p), max(p)) for p in pairs if p[0] != p[1]}):
            for x, y in ((a, b), (b, a)):
                if x not in linked:
                    order.append(x)
                linked.setdefault(x, set()).add(y)
        centers = []
        for x in order:
            if not linked[x] & set(centers):
                centers.append(x)
        want = sorted((c, n) for c in centers for n in (c, *linked[c]))
        assert rows(components.star_clusters(spark.createDataFrame(pairs, "a int, b int"))) == want



def test_newest_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), ("b", 1, "y"), ("c", None, "x"), ("c", 3, "y"), ("d", 1, "x")], "g string, t int, u string")
    got = {(r["g"], r["u"]): (r["decision"], r["reason"], r["kept_uid"]) for r in survivors.newest_wins(df, ["g"], "t", "u").collect()}
    assert got[("a", "x")] == ("exclude", "older_exact_duplicate", "y") and got[("a", "y")] == ("keep", "newest_of_exact_duplicate_group", "y")
    assert got[("b", "x")] == (None, "timestamp_tie", None) and got[("c", "y")] == (None, "timestamp_missing", None)
    assert got[("d", "x")] == ("keep", "single", "x")


def test_survivor(spark):
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 2, 6, "y"), ("b", 1, 5, "x"), ("b", 1, 4, "y"), ("c", 1, 4, "x"), ("c", 1, 4, "y"), ("d", 1, None, "x"), ("d", 1, 4, "y"), ("e", None, 1, "x"), ("e", 2, 2, "y")], "g string, t int, e int, u string")
    got = {r["g"]: (r["outcome"], r["survivor"]) for r in survivors.survivor(df, ["g"], "t", "e", "u").collect()}
    assert got == {"a": ("newest", "y"), "b": ("oldest_export", "y"), "c": ("timestamp_tie", None), "d": ("timestamp_missing", None), "e": ("timestamp_missing", None)}


def test_annotation_ladder(spark):
    df = spark.createDataFrame([("keep", "exclude", True, True, True), (None, "exclude", True, True, True), (None, "keep", True, True, True), (None, None, False, True, True), (None, None, False, False, False), (None, None, False, False, True)], "h string, a string, r boolean, u boolean, s boolean")
    got = [tuple(r["v"]) for r in df.select(ladders.annotation_ladder(*[F.col(c) for c in "harus"]).alias("v")).collect()]
    assert [g[0] for g in got] == ["keep", "exclude", "pending", "keep", "keep", "keep"]
    assert [g[1] for g in got] == ["human", "automatic", "-", "default", "default", "default"]
    assert [g[2] for g in got] == ["keep", "older_exact_duplicate", "review_required", "kept_without_full_check", "out_of_scope", "no_issue_detected"]
    assert [g[3] for g in got] == ["reviewed", "not_needed", "pending", "not_needed", "not_needed", "not_needed"]
    said = ladders.annotation_ladder(*[F.col(c) for c in "harus"], human_reason=F.lit("visually_valid"), automatic_reason=F.lit("broken_mask"))
    assert [r[0] for r in df.select(said["reason"]).collect()][:2] == ["visually_valid", "broken_mask"]
    assert [r[0] for r in df.select(ladders.overrides_automatic(F.col("h"), F.col("a"))).collect()][:3] == [True, False, False]


def test_overrides(spark):
    df = spark.createDataFrame([("A", "orphan"), ("B", "orphan"), (None, "orphan")], "ds string, k string")
    rules = [{"id": "r0", "action": "drop", "ds": ["A"]}, {"id": "r1", "action": "keep", "ds": ["A", "C"]}, {"id": "r2", "action": "keep", "ds": ["A"]}]
    assert [r[0] for r in df.select(ladders.matching_override(rules, {"ds": F.col("ds"), "k": F.col("k")})).collect()] == ["r1", None, None]
    verdict = ladders.image_ladder(F.lit(None).cast("string"), F.lit("unannotated_orphan"), F.lit(False))
    assert tuple(df.select(ladders.overridden(verdict, F.lit("r1")).alias("v")).first()["v"]) == ("keep", "override", "unannotated_orphan_unused", "not_needed")


def test_case_status(spark):
    df = spark.createDataFrame([("a", "keep"), ("a", "exclude"), ("b", None), ("c", "pending"), ("c", "keep"), ("d", "exclude"), ("e", "keep")], "c string, decision string")
    status = ladders.case_status(df, ["c"])
    assert rows(status) == [("a", "partial"), ("b", "no_annotation"), ("c", "needs_review"), ("d", "all_excluded"), ("e", "passed")]
    assert rows(ladders.status_counts(status.filter("c = 'a'"))) == [("all_excluded", 0), ("needs_review", 0), ("no_annotation", 0), ("partial", 1), ("passed", 0)]


def test_winner_and_automatic(spark):
    df = spark.createDataFrame([("p", True, 1, "b", 1), ("p", True, 1, "a", 2), ("p", True, None, "a", 3), ("p", False, 9, "a", 4), ("q", False, 1, "a", 5), (None, True, 1, "a", 6), (None, True, 1, "a", 6), (None, True, 0, "a", 7)],
                               "path string, kept boolean, t int, ds string, n int")
    got = rows(survivors.winner(df, "path", "kept", "t", "ds", ["n"]).select("n", "is_winner", "group_size", "reason"))
    assert got == [(1, False, 4, "annotated_preferred"), (2, True, 4, "annotated_preferred"), (3, False, 4, "annotated_preferred"), (4, False, 4, "annotated_preferred"), (5, True, 1, "unique"),
                   (6, False, 3, "both_annotated"), (6, True, 3, "both_annotated"), (7, False, 3, "both_annotated")]
    auto = spark.createDataFrame([("a", "keep", 0), ("a", "exclude", 2), ("a", "exclude", 1), ("b", "keep", 1), ("b", None, 0), (None, "keep", 0)], "u string, d string, o int")
    assert sorted(rows(survivors.merged_automatic(auto, "u", "d", "o")), key=str) == [("a", "exclude", 1), ("b", None, 0), (None, "keep", 0)]
    with pytest.raises(ValueError, match="write it as a table"):
        reports.payload({"df": df}, most=7)


def test_decision_contract(spark):
    ddl = "k string, decision string, source string, reason string, review_status string, reviewer string, unverified_checks string"
    d = spark.createDataFrame([("a", "keep", "human", "x", "pending", "", "none"), ("a", "pending", "default", "x", "not_needed", None, "none"), ("z", None, "-", "kept_without_full_check", "pending", None, "none"), (None, "keep", "-", "x", "pending", None, "none")], ddl)
    records = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert dict(rows(contracts.decision_contract(d, records, ["k"]))) == {"row_count": 1, "duplicate_key": 1, "key_without_decision": 1, "decision_without_key": 1, "known_decision": 1, "not_needed_is_final": 1, "human_has_reviewer": 1, "unverified_has_checks": 1}
    assert {n for _, n in rows(contracts.decision_contract(d.limit(0), records.limit(0), ["k"]))} == {0}


def test_gate():
    assert ladders.gate(0, "pending") is None and ladders.gate(2, "pending", True, "keep") is None
    assert "not allowed" in ladders.gate(2, "pending", False, "keep") and "say" in ladders.gate(2, "pending", True)


def test_upsert(spark):
    schema = "k int, decision string, t string"
    base = spark.createDataFrame([(1, "keep", "1"), (2, "keep", "1"), (3, "keep", "2"), (4, "keep", None), (5, "keep", "1")], schema)
    new = spark.createDataFrame([(1, "keep", "2"), (2, "exclude", "2"), (3, "exclude", "1"), (4, "exclude", "1"), (6, "keep", "1")], schema)
    got = {r["k"]: (r["decision"], r["t"], r["action"]) for r in merges.upsert(base, new, ["k"], "decision", "t").collect()}
    assert got == {1: ("keep", "2", "refreshed"), 2: ("exclude", "2", "replaced"), 3: ("keep", "2", "kept"), 4: ("keep", None, "conflict"), 5: ("keep", "1", "kept"), 6: ("keep", "1", "inserted")}


def test_tree_merge(spark):
    p = spark.createDataFrame([("i", "s", "f1", 1, "d1", None), ("i", "s", "f2", 2, "d2", "x")], "inst string, study string, file string, ord int, date string, note string")
    assert merges.union_files(p, ["inst", "study", "file"]).count() == 2
    with pytest.raises(Exception, match="file in several datasets"):
        merges.union_files(p.withColumn("file", F.lit("f")), ["inst", "study", "file"]).collect()
    assert rows(merges.conflicts(p, ["inst", "study"], ["date", "note"])) == [("i", "s", "date", 2), ("i", "s", "note", 2)]
    assert rows(merges.container_values(p, ["inst", "study"], ["date", "note"], "ord")) == [("i", "s", "d1", None)]


def test_probe_and_fill(spark):
    wanted = spark.createDataFrame([("a", "20260101"), ("a", "20260102"), ("b", "20260101")], "folder string, date string")
    files = spark.createDataFrame([("a", "20260101/x.png"), ("a", "20260102_2/x.png")], "folder string, path string")
    assert [r["found"] for r in merges.probe_paths(wanted, files, "folder", "date", "path").orderBy("folder", "date").collect()] == ["exact", "sibling", "none"]
    df = spark.createDataFrame([(1, ""), (2, "x"), (3, "y")], "k int, v string")
    look = spark.createDataFrame([(1, "new"), (2, "x"), (3, "z")], "k int, v string")
    assert rows(merges.filled(df, look, "k", ["v"]), "k") == [(1, "new", []), (2, "x", []), (3, "y", ["v"])]


def test_significant(spark):
    df = spark.createDataFrame([(0.0,), (1234.5,), (12.3456,), (0.00123456,), (-98.7654,), (None,)], "v double")
    assert [r[0] for r in df.select(rollups.significant(F.col("v"))).collect()] == [0.0, 1234.0, 12.35, 0.001235, -98.77, None]


def test_rollup_order(spark):
    df = spark.createDataFrame([("u", 2, "B", "checked", "error", True), ("u", 1, "A", "checked", "info", False), ("u", 2, "B", "checked", "error", True), ("u", 3, "C", "cannot_determine", "critical", False), ("u", 4, "D", "not_applicable", "critical", False), ("v", 4, "D", "not_applicable", "error", False)], "u string, check_ord int, check_id string, status string, severity string, review_required boolean")
    r, none = rollups.issue_rollup(df, ["u"]).orderBy("u").collect()
    assert (r["n_issues"], r["needs_review"], r["max_severity"], r["detected_checks"], r["unverified_checks"]) == (3, True, "error", "A|B", "C")
    assert (none["n_issues"], none["max_severity"], none["detected_checks"], none["unverified_checks"]) == (0, "none", "none", "none")
    more = df.withColumn("duplicate_group_id", F.when(F.col("check_ord") > 1, F.concat(F.lit("G"), "check_ord"))).withColumn("related_uid", F.when(F.col("check_ord") == 3, "w"))
    assert tuple(rollups.issue_rollup(more, ["u"]).filter("u = 'u'").select("duplicate_group_id", "related_uid").first()) == ("G2", "w")


def test_ids_in_the_order_of_their_check(spark):
    ids = ["S03_STRAY_COMPONENT", "S03_TINY_ANNOTATION", "S03_TINY_ANNOTATION", "M06_PATH_NAME_MISMATCH", "M06_PATH_UNEXPECTED_ROOT", "D03_NEAR_DUPLICATE", "D01_EXACT_DUPLICATE", "M09_UNANNOTATED_VIEW"]
    registry = {name: i for i, (name, *_) in enumerate(checks.CHECKS)}
    parts = [spark.createDataFrame([("u", i, "checked", "error", True)], "u string, check_id string, status string, severity string, review_required boolean") for i in ids]
    issues = None
    for i, part in zip(ids, parts):
        name = "D01" if i[0] == "D" else i[:3]
        part = part.withColumn("check_ord", checks.placed(name, registry[name])).withColumn("related_uid", F.lit("of " + i[:3]) if i[0] == "D" else F.lit(None).cast("string"))
        issues = part if issues is None else issues.unionByName(part)
    got = rollups.issue_rollup(issues, ["u"]).first()
    assert got["detected_checks"] == "M06_PATH_UNEXPECTED_ROOT|M06_PATH_NAME_MISMATCH|M09_UNANNOTATED_VIEW|D01_EXACT_DUPLICATE|D03_NEAR_DUPLICATE|S03_TINY_ANNOTATION|S03_STRAY_COMPONENT"
    assert got["related_uid"] == "of D01"


def test_vocabulary(spark):
    df = spark.createDataFrame([(["b", "zz", "a"],), ([],), (None,)], "t array<string>")
    assert [r[0] for r in df.select(rollups.vocabulary_ordered(F.col("t"), ["a", "b", "c"])).collect()] == ["a|b", "none", "none"]


def test_contracts(spark):
    df = spark.createDataFrame([(1, "keep", "human", "x", None, "r", "none"), (2, "odd", "default", "not_needed", "me", "kept_without_full_check", "none")], "k int, decision string, source string, review_status string, reviewer string, reason string, unverified_checks string")
    got = rows(contracts.violations(df, contracts.decision_rules(), ["k"]), "k", "rule")
    assert got == [(1, "human_has_reviewer"), (2, "known_decision"), (2, "not_needed_is_final"), (2, "unverified_has_checks")]
    with pytest.raises(ValueError):
        contracts.require_none(df, "rows")
    assert contracts.structure_diff({"a": 1, "b": 2}, {"b": 3, "c": 4}) == {"only_left": ["a"], "only_right": ["c"], "differing": ["b"]}


def _context(spark):
    a = {"dataset_id": "D", "file_uid": "f", "file": "img", "ann_index": 0, "geometry_uid": "g", "annotation_type": "box", "image_path": "image/a/b/c/d/e/f/img.dcm", "path_mask": "/mask/a/b/c/d/e/f/g.png", "path_original_mask": None, "min_x": 5, "min_y": 0, "max_x": 5, "max_y": 10, "shape_w": 8, "shape_h": 20, "declared_w": 8, "declared_h": 21, "region_count": 2, "family": "focal"}
    b = a | {"geometry_uid": "h", "ann_index": 1, "path_mask": "mask/a/b/c/d/e/f/h.png", "annotation_type": "brush", "shape_w": None, "shape_h": None, "declared_w": None, "declared_h": None, "max_x": 9}
    ddl = "dataset_id string, file_uid string, file string, ann_index int, geometry_uid string, annotation_type string, image_path string, path_mask string, path_original_mask string, min_x long, min_y long, max_x long, max_y long, shape_w int, shape_h int, declared_w int, declared_h int, region_count int, family string"
    ann = spark.createDataFrame([tuple(x[c.split()[0]] for c in ddl.split(", ")) for x in (a, b)], ddl)
    m = dict(dataset_id="D", file_uid="f", geometry_uid="g", role="mask", exists=True, read_error=None, ndim=3, n_channels=3, dtype="uint16", height=20, width=8, value_min=7, value_max=255, unique_values=[7, 255], truncated=False, fg_pixels=99, fg_ratio=0.97, bbox={"min_x": 5, "min_y": 0, "max_x": 6, "max_y": 10}, n_components=2, component_areas=[90, 9], component_areas_mm2=[25.0, 5.0], area_mm2=30.0, mask_hash="x", lat_containment=0.9, lat_outside_mm2=150.0, filled_iou_vs_mask=1.0, difference_ratio=0.0, reference_status="available")
    n = m | dict(geometry_uid="h", exists=False, role="mask")
    masks = spark.createDataFrame([m, n], MASKS_DDL)
    files = spark.createDataFrame([("f", True, 21, 8, "bad header", 2, 1, "available")], FILES_DDL)
    pairs = spark.createDataFrame([("D", "f", "g", "h", 1.0, 1.0, 1.0, True, True, True), ("D", "f", "g", "h", 0.5, 0.99, 0.5, False, False, True)], PAIRS_DDL)
    images = spark.createDataFrame([("D", "f", "annotated"), ("D", "e", "negative_case"), ("D", "k", "unannotated_view"), ("D", "o", "unannotated_orphan")], "dataset_id string, file_uid string, image_class string")
    return checks.Context(ann, masks, files, pairs, images)


def test_checks(spark):
    found = checks.run(_context(spark))
    got = {}
    for r in found.collect():
        got.setdefault(r["check_id"], []).append((r["geometry_uid"], r["severity"], r["status"]))
    assert got["M01_MASK_RESOLUTION"] == [("g", "error", "checked")]
    assert len(got["M01_MASK_RESOLUTION_JSON"]) == 1
    assert {"M02_MASK_NOT_GRAYSCALE", "M02_MASK_NOT_8BIT", "M03_MASK_NOT_BINARY", "M03_MASK_INVERTED", "M04_MASK_FULL"} <= set(got)
    assert got["M05_FILE_MISSING"] == [("h", "error", "checked")] and len(got["M05_FILE_UNREADABLE"]) == 1
    assert got["M06_PATH_LEADING_SLASH"] == [("g", "warning", "checked")] and "M06_PATH_UNEXPECTED_DEPTH" not in got and "M06_PATH_NAME_MISMATCH" not in got
    assert got["M07_BBOX_DEGENERATE"] == [("g", "error", "checked")]
    assert got["M07_BBOX_OUT_OF_IMAGE"] == [("h", "info", "cannot_determine")]
    assert got["M07_SIZE_FIELDS_NULL"] == [("h", "info", "not_applicable")]
    assert got["M08_JSON_BBOX_MISMATCH"] == [("g", "warning", "checked")] and "M08_REGION_COUNT_MISMATCH" not in got
    assert {k: len(v) for k, v in got.items() if k.startswith("M09")} == {"M09_NEGATIVE_CASE": 1, "M09_UNANNOTATED_VIEW": 1, "M09_UNANNOTATED_SERIES": 1}
    assert sorted(got["D01_EXACT_DUPLICATE"]) == [("g", "error", "checked"), ("h", "error", "checked")]
    assert [s for _, s, _ in got["D04_CONTAINED_DIFFERENT_LABEL"]] == ["info", "info"]
    assert got["S03_SUSPICIOUSLY_SMALL"] == [("g", "info", "checked")] and len(got["S03_STRAY_COMPONENT"]) == 1
    assert got["S05_OUTSIDE_BODY"] == [("g", "warning", "checked")]
    assert checks.executed(checks.Context(_context(spark).annotations)) == ["M06", "M07"]


def test_summaries(spark):
    df = spark.createDataFrame([(x,) for x in (5, 1, 3, 2)], "v int").withColumn("g", F.lit("g"))
    assert rows(rollups.upper_median(df, ["g"], "v")) == [("g", 3)]
    assert json.dumps(rows(rollups.width_buckets(df, "v", [0, 2, 4]))) == "[[0, 1], [1, 2], [2, 1]]"
    assert rows(rollups.top_and_other(df, "v", 1)) == [("1", 1), ("other", 3)]


def test_review(spark):
    ddl = "uid string, kind string, status string, tags array<string>, n_reasons int, display_adjusted string, dataset_id string, image_class string, series_image_index int"
    items = spark.createDataFrame([
        ("a", "image", "pending", ["spot_check"], 1, None, "e", "x", 0), ("b", "annotation", "pending", ["auto:s03_stray_component"], 0, "x", "d", None, 0), ("c", "annotation", "keep", None, 2, None, "d", None, 0),
        ("d", "image", "keep", ["spot_check", "flag:needs_report"], 0, None, "d", "x", 0), ("s", "annotation", "keep", ["system:schema_seed"], 9, None, "d", None, 0),
    ], ddl)
    names = review.register_views(items)
    seen = {n: [r["uid"] for r in spark.table(n).collect()] for n in names}
    assert len(names) == 12 and seen["review_pending_images"] == ["a"] and seen["review_pending_annotations"] == ["b"] and seen["review_tiny_region"] == ["b"] and seen["review_broken_box"] == ["b"]
    assert seen["review_spot_check_unannotated"] == ["d", "a"] and seen["review_needs_report_first"] == ["d", "a", "b", "c", "s"] and seen["review_flagged_for_report"] == ["d"] and seen["review_reasoned_decisions"] == ["c"]
    assert dict(rows(review.view_counts(items)))["reasoned_decisions"] == 1 and len(seen["review_all"]) == 5
    df = spark.createDataFrame([("small|zz", ["reason:x"], "y"), ("", ["reason:x", "review:later", "review:keep"], "y"), (None, None, "y|none"), ("none", ["status:keep"], None)], "f string, t array<string>, l string")
    got = [r[0] for r in df.select(review.effective_reasons(F.col("f"), F.col("t"), F.col("l"), ["x", "y", "small"])).collect()]
    assert got == ["small", "x", "y", "none"]
    assert [r[0] for r in df.select(review.effective_status(F.lit(None).cast("string"), F.col("t"))).collect()] == ["pending", "keep", "pending", "pending"]
    assert [r[0] for r in df.select(review.effective_status(F.lit("pending"), F.col("t"))).collect()] == ["pending", "keep", "pending", "pending"]
    assert df.select(review.effective_reasons(F.lit("review_required|older_duplicate|invalid_duplicate"), F.col("t"), F.col("l"))).first()[0] == "invalid_duplicate|older_duplicate"
    clock = spark.createDataFrame([("bad", "010203.5"), ("235959", None), (None, None)], "a string, b string")
    assert [r[0] for r in clock.select(review.clock_seconds(F.col("a"), F.col("b"))).collect()] == [3723.5, 86399.0, None]
    assert [r[0] for r in spark.createDataFrame([(5,), (65,), (-7200,), (90000,), (None,)], "s int").select(review.elapsed_text(F.col("s"))).collect()] == ["5 seconds", "1 minutes", "2 hours", "1 days", None]
    boxes = spark.createDataFrame([(10, 10, 12, 50, 100), (10, 10, 40, 50, 100), (-150, 0, 20, 50, 100), (250, 10, 251, 50, 100), (-50, 0, 140, 50, 100), (0, 0, 9, 9, 0), (0, 0, 9, 9, None)], "a int, b int, c int, d int, w int")
    got = [b and (round(b["x"], 9), round(b["y"], 9), round(b["w"], 9), round(b["h"], 9), b["reason"], b["original"]) for b, in boxes.select(review.display_box(*[F.col(c) for c in "abcdw"], F.lit(100))).collect()]
    assert got == [
        (0.1, 0.1, 0.08, 0.4, "degenerate_widened_for_display", [10, 10, 12, 50]), (0.1, 0.1, 0.3, 0.4, None, None), (-0.5, 0.0, 1.5, 0.5, "out_of_image_clamped_for_display", [-150, 0, 20, 50]),
        (1.5, 0.1, 0.08, 0.4, "out_of_image_clamped_for_display", [250, 10, 251, 50]), (-0.5, 0.0, 1.9, 0.5, None, None), None, None]
    assert rows(review.dictionary_codes(items, "status", ["uid"])) == [("keep", 1), ("pending", 0)]
    assert review.run_gate({"checks_partial": True, "measurements": {"n_files": 3, "n_measured": 1}}) == ["not all checks were run", "2 files are not measured"] and review.run_gate({"measurements": {"scan_required": False, "n_files": 3}}) == []
    proof = spark.createDataFrame([(1, ["a"], ["b", "a"])], "schema_version int, explicit_negative_normal array<string>, explicit_negative_report array<string>")
    assert rows(review.protected_ids(proof)) == [("a",), ("b",)]
    with pytest.raises(Exception, match="evidence version"):
        review.protected_ids(proof.withColumn("schema_version", F.lit(2))).collect()
    with pytest.raises(ValueError):
        review.one_fingerprint(items.withColumnRenamed("uid", "fingerprint"))
    assert rows(review.searched(items, {"kind": "annotation"}, "B", ["uid"]).select("uid")) == [("b",)]
    assert "| pending | 2 |" in reports.markdown("t", {"s": items.groupBy("status").count()}) and json.loads(reports.payload({"s": items.select("uid")}))["s"][0] == {"uid": "a"}
    assert reports.page(items, [F.col("uid")], 1, 2).first()["uid"] == "c"


def test_cross_dataset(spark):
    r = lambda ds, uid, image, label, content, stamp, export, place: (ds, uid, image, label, content, stamp, export, place)
    records = spark.createDataFrame([
        r("A", "g1", "i1", "x", "m1", 5, 1, 3), r("B", "g2", "i1", "x", "m1", 7, 2, 4),  # the newer one stays, whatever its uid
        r("A", "g3", "i2", "x", "m2", 5, 2, 1), r("B", "g3", "i2", "x", "m2", 5, 1, 2), r("C", "g3", "i2", "x", "m2", 5, 3, 9),  # equal stamps: the oldest export
        r("A", "g4", "i3", "x", "m3", 5, 1, 5), r("B", "g4", "i3", "x", "m3", 5, 1, 6),  # a tie
        r("A", "g5", "i4", "x", "m4", 5, 1, 7), r("B", "g5", "i4", "y", "m4", 6, 1, 8),  # other labels under one uid
        r("A", "g6", "i5", "x", "m5", None, 1, 10), r("B", "g6", "i5", "x", "m5", 5, 2, 11), r("A", "g7", "i6", "x", "m6", 1, 1, 12), r("A", "g8", "i6", "x", "m6", 2, 1, 13),
    ], "dataset_id string, geometry_uid string, image_path string, label_key string, content string, stamp int, export int, place int")
    decisions, found = checks.cross_dataset(records)
    got = {(d["dataset_id"], d["geometry_uid"]): (d["decision"], d["kept_uid"], d["related_uid"], d["group_id"]) for d in decisions.collect()}
    assert got == {
        ("A", "g3"): ("exclude", "g3", "g3", "XDUP_0001"), ("B", "g3"): ("keep", "g3", None, "XDUP_0001"), ("C", "g3"): ("exclude", "g3", "g3", "XDUP_0001"),
        ("A", "g1"): ("exclude", "g2", "g2", "XDUP_0002"), ("B", "g2"): ("keep", "g2", None, "XDUP_0002"),
    }
    n = {(x["check_id"], x["dataset_id"], x["geometry_uid"]) for x in found.collect()}
    tie, wrong, copy = "D05_CROSS_DATASET_DUPLICATE_TIE", "D05_CROSS_DATASET_MISMATCH", "D05_CROSS_DATASET_DUPLICATE"
    assert n == {(copy, "A", "g1"), (copy, "B", "g2"), *[(copy, d, "g3") for d in "ABC"], (tie, "A", "g4"), (tie, "B", "g4"), (wrong, "A", "g5"), (wrong, "B", "g5"), (tie, "A", "g6"), (tie, "B", "g6")}
    assert found.count() == 12 and {x["severity"] for x in found.filter(F.col("check_id").isin(copy, wrong)).collect()} == {"error"}
    assert checks.without_excluded(records, decisions).count() == records.count() - 3


def test_cross_dataset_versions_and_missing_contents(spark):
    ddl = "dataset_id string, geometry_uid string, image_path string, label_key string, content string, stamp int, export int, place int"
    records = spark.createDataFrame([
        ("A", "g1", "i1", "x", "c1", 1, 1, 1), ("A", "g1", "i1", "x", "c2", 2, 1, 2), ("B", "g1", "i1", "x", "c1", 3, 1, 3),  # of two versions, one differs
        ("A", "g2", "i2", "x", None, 1, 1, 4), ("B", "g2", "i2", "x", None, 2, 1, 5),  # missing contents are equal
        ("A", "g3", "i3", None, "m", 1, 1, 6), ("B", "g4", "i3", None, "m", 2, 1, 7), ("A", "g5", "i4", "x", None, 1, 1, 8), ("B", "g5", "i4", "x", "m", 2, 1, 9),
        ("A", "g6", None, "x", "m", 1, 1, 10), ("B", "g6", None, "x", "m", 2, 1, 11),
    ], ddl)
    decisions, found = checks.cross_dataset(records)
    assert {(d["geometry_uid"], d["dataset_id"], d["decision"]) for d in decisions.collect()} == {("g1", "A", "exclude"), ("g1", "B", "keep"), ("g2", "A", "exclude"), ("g2", "B", "keep"), ("g3", "A", "exclude"), ("g4", "B", "keep")}
    wrong = sorted((r["geometry_uid"], r["dataset_id"], r["detail"]["other_dataset"]) for r in found.filter("check_id = 'D05_CROSS_DATASET_MISMATCH'").collect())
    assert wrong == [("g1", "A", "B"), ("g1", "B", "A"), ("g5", "A", "B"), ("g5", "B", "A")]
    assert checks.cross_dataset(records.limit(0))[1].count() == 0


def test_cross_dataset_comes_before_the_checks(spark):
    base = _context(spark)
    one = base.annotations.filter("geometry_uid = 'g'").withColumns({"image_path": F.lit("image/x.dcm"), "label_keys": F.array(F.lit("l")), "stamp": F.lit(1), "export_stamp": F.lit(1)})
    ctx = checks.Context(one.unionByName(one.withColumns({"dataset_id": F.lit("E"), "geometry_uid": F.lit("k"), "stamp": F.lit(2), "path_mask": F.lit("mask/k.png")})), base.masks)
    assert "D05" not in checks.executed(ctx)
    boxes, _ = checks.resolve_cross_dataset(checks.Context(ctx.annotations))
    assert [r["geometry_uid"] for r in boxes.annotations.collect()] == ["k"]  # without masks, equal boxes are copies
    resolved, decisions = checks.resolve_cross_dataset(ctx)
    assert decisions.count() == 0 and resolved.annotations.count() == 2  # one has a mask, the other has none
    twin = base.masks.filter("geometry_uid = 'g'").withColumns({"dataset_id": F.lit("E"), "geometry_uid": F.lit("k")})
    resolved, decisions = checks.resolve_cross_dataset(checks.Context(ctx.annotations, base.masks.unionByName(twin)))
    assert {(d["dataset_id"], d["decision"]) for d in decisions.collect()} == {("D", "exclude"), ("E", "keep")}
    found = checks.run(resolved, only=["D05", "M07"])
    assert {(r["check_id"], r["geometry_uid"]) for r in found.collect()} == {("D05_CROSS_DATASET_DUPLICATE", "g"), ("D05_CROSS_DATASET_DUPLICATE", "k"), ("M07_BBOX_DEGENERATE", "k")}


def test_conflicts_stop(spark):
    one = spark.createDataFrame([("d", "k", "keep", "1")], "dataset_id string, key string, decision string, stamp string")
    other = spark.createDataFrame([("d", "k", "exclude", "1"), (None, "z", "keep", "1")], one.schema)
    with pytest.raises(Exception, match="no stamp decides"):
        merges.fold_stores([one, other], ["dataset_id", "key"], "decision", "stamp").collect()
    later = other.withColumn("stamp", F.lit("2"))
    assert rows(merges.fold_stores([one, later], ["dataset_id", "key"], "decision", "stamp")) == [("d", "k", "exclude", "2")]


def test_case_labels(spark):
    from adjudica.functions.samples import case_labels

    lab = "array<struct<code_system: string, code_text_eng: string>>"
    f, normal = lambda *names: [("Findings", n) for n in names], [("No Findings", "normal")]
    df = spark.createDataFrame([(f("pneumothorax"), normal), (f("nodule"), normal), (f("bulla_bleb", "pleural_effusion"), []), ([], normal), ([], []), (normal, None), (f("nodule"), [])], f"ann_labels {lab}, case_labels {lab}")
    names = ["abnormal_finding_status", "pneumothorax_case", "bulla_bleb_status", "pleural_effusion_status", "case_evidence"]
    got = [tuple(r) for r in df.select(*[case_labels()[n].alias(n) for n in names]).collect()]
    negative, open_ = "explicit_negative_normal", "unconfirmed"
    assert got == [
        ("present", True, "unknown", "unknown", "explicit_positive_annotation"), ("present", False, "unknown", "unknown", negative), ("present", False, "present", "present", open_),
        ("absent", False, "unknown", "absent", negative), ("unknown", False, "unknown", "unknown", open_), ("absent", False, "unknown", "absent", negative), ("present", False, "unknown", "unknown", open_),
    ]
