"""Masks as runs, distances, regions and the scan of files, on random masks with holes, notches and several parts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from adjudica import config as settings
from adjudica.functions import measure, overlay, raster, runs
from adjudica.operators import checks


def blobs(rng, h, w, n):
    m = np.zeros((h, w), bool)
    for _ in range(n):
        y, x, dy, dx = rng.integers(0, h), rng.integers(0, w), rng.integers(2, max(3, h // 2)), rng.integers(2, max(3, w // 2))
        m[y : y + dy, x : x + dx] ^= True
        if rng.random() < 0.5:
            m[y + 1 : y + dy - 1, x + 1 : x + dx - 1] = False
    return m


@pytest.fixture(scope="module")
def pictures():
    rng = np.random.default_rng(7)
    return [blobs(rng, int(rng.integers(1, 30)), int(rng.integers(1, 30)), int(rng.integers(0, 5))) for _ in range(60)] + [np.zeros((4, 5), bool), np.ones((4, 5), bool)]


def test_runs_there_and_back(pictures):
    for m in pictures:
        found = runs.of_array(m)
        assert (runs.to_array(*m.shape, found) == m).all() and sum(b - a for _, a, b in found) == m.sum() and found == sorted(found)
        assert all((y, b) not in {(v, a) for v, a, _ in found} for y, _, b in found)


def _table(spark, pairs):
    as_mask = lambda m: (m.shape[0], m.shape[1], runs.of_array(m))
    return spark.createDataFrame([(k, as_mask(a), as_mask(b)) for k, (a, b) in enumerate(pairs)], f"k int, a {runs.MASK_DDL}, b {runs.MASK_DDL}")


def test_run_columns_equal_the_arrays(spark, pictures):
    rng = np.random.default_rng(8)
    pairs = [(m, blobs(rng, *m.shape, 3)) for m in pictures] + [(m, m) for m in pictures[:5]] + [(np.zeros((3, 3), bool), np.zeros((3, 3), bool)), (np.ones((3, 4), bool), np.ones((4, 3), bool))]
    a, b = F.col("a"), F.col("b")
    rows = _table(spark, pairs).select(
        "k", runs.area(a).alias("area"), runs.box(a).alias("box"), runs.touches_border(a).alias("border"), runs.intersection(a, b).alias("both"), runs.iou(a, b).alias("iou"), runs.containment(a, b).alias("inside"),
        (runs.digest(a) == runs.digest(b)).alias("same"), runs.row_filled(a).alias("rows"),
    ).collect()
    for r in rows:
        x, y = pairs[r["k"]]
        stats = raster.mask_stats(x)
        assert (r["area"], tuple(r["box"]) if r["box"] else None, r["border"]) == (stats["fg_pixels"], stats["bbox"], stats["touches_border"])
        assert (runs.to_array(*x.shape, r["rows"]["runs"]) == raster.row_filled(x)).all()
        if x.shape != y.shape:
            assert r["both"] is None and r["iou"] is None and r["inside"] is None and not r["same"]
            continue
        assert r["both"] == (x & y).sum() and r["iou"] == raster.iou(x, y) and r["inside"] == raster.containment(x, y) and r["same"] == (x == y).all()


def test_unions_of_runs(spark, pictures):
    rng = np.random.default_rng(9)
    groups = [[blobs(rng, 12, 9, 2) for _ in range(rng.integers(1, 5))] for _ in range(25)] + [[np.zeros((2, 2), bool)]]
    groups[0].append(np.ones((3, 3), bool))  # another shape than the first's
    as_mask = lambda m: (m.shape[0], m.shape[1], runs.of_array(m))
    df = spark.createDataFrame([(g, k, as_mask(m)) for g, some in enumerate(groups) for k, m in enumerate(some)], f"g int, k int, mask {runs.MASK_DDL}")
    got = {r["g"]: r["mask"] for r in runs.merged(df, ["g"], ["k"]).collect()}
    for g, some in enumerate(groups):
        want = raster.merge_masks(some)
        assert (g in got) == (want is not None)
        if want is not None:
            assert runs.of_array(want) == [tuple(r) for r in got[g]["runs"]]
    overlapping = spark.createDataFrame([(1, 0, -3, 4), (1, 0, 2, 6), (1, 0, 2, 3), (1, 0, 7, 99), (1, 5, 0, 2), (1, -1, 0, 2), (1, 1, 3, 3)], "g int, y int, x0 int, x1 int")
    assert [tuple(r) for r in runs.from_rows(overlapping, ["g"], F.lit(3), F.lit(9)).first()["mask"]["runs"]] == [(0, 0, 6), (0, 7, 9)]


def test_masks_of_lines_move_once(spark):
    from conftest import SF

    from adjudica.plans import imaging

    plan = imaging.run_masks(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan


def test_parts_are_joined_some_lists_at_a_time(monkeypatch):
    rng = np.random.default_rng(12)
    lists = [[(int(y), int(x), int(x) + int(w)) for y, x, w in rng.integers((0, 0, 1), (4, 20, 6), (n, 3))] for n in (0, 9, 40, 0, 3, 25, 0)]
    kind = runs.pa.list_(runs.pa.struct([(c, runs.pa.int32()) for c in ("y", "x0", "x1")]))
    as_array = runs.pa.array([[dict(zip(("y", "x0", "x1"), p, strict=True)) for p in some] for some in lists], kind)
    for parts in (1 << 18, 10, 1):
        monkeypatch.setattr(runs, "PARTS", parts)
        got = [[tuple(r.values()) for r in some] for some in runs._islands(as_array).to_pylist()]
        assert got == [runs.of_array(runs.to_array(4, 30, some)) for some in lists]
    assert runs._islands(as_array.slice(2, 3)).to_pylist() == runs._islands(as_array).to_pylist()[2:5]


def test_small_images_have_the_same_distances_and_components(monkeypatch, pictures):
    for m in pictures:
        near = measure.distances(m)
        with monkeypatch.context() as c:
            c.setattr(measure, "DIRECT", 0)
            assert (measure.distances(m) == near).all()
        for diagonal in (True, False):
            labels, n = raster.components(m, diagonal)
            again = np.zeros(m.shape, int)  # a flood from each first pixel
            count = 0
            for y, x in zip(*np.nonzero(m), strict=True):
                if again[y, x]:
                    continue
                count, todo = count + 1, [(y, x)]
                while todo:
                    a, b = todo.pop()
                    if 0 <= a < m.shape[0] and 0 <= b < m.shape[1] and m[a, b] and not again[a, b]:
                        again[a, b] = count
                        todo += [(a + i, b + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if diagonal or not i or not j]
            assert n == count and (labels == again).all()


def test_pictures_are_drawn_by_more_than_one_task(spark):
    image, mask = raster.write_png(np.zeros((3, 3), np.uint8)), (3, 3, [(1, 0, 2)])
    images = spark.createDataFrame([(str(k), str(k), image) for k in range(40)], "file_uid string, name string, content binary")
    masks = spark.createDataFrame([(str(k), 0, mask) for k in range(40)], f"file_uid string, ann_index int, mask {runs.MASK_DDL}")
    drawn = overlay.pictures(images, masks).withColumn("part", F.spark_partition_id())
    assert drawn.select("part").distinct().count() > 1 and drawn.filter("content is not null").count() == 40


def test_pairs_of_runs_equal_pairs_of_pictures(spark):
    rng = np.random.default_rng(10)
    some = [(f"f{k % 3}", f"g{k}", k, blobs(rng, 10, 11, 3)) for k in range(12)] + [("f0", "odd", 99, np.ones((2, 2), bool))]
    png = spark.createDataFrame([(f, g, k, raster.write_png(m.astype(np.uint8))) for f, g, k, m in some], "file_uid string, geometry_uid string, ann_index int, content binary")
    as_runs = spark.createDataFrame([(f, g, k, (m.shape[0], m.shape[1], runs.of_array(m))) for f, g, k, m in some], f"file_uid string, geometry_uid string, ann_index int, mask {runs.MASK_DDL}")
    key = lambda df: sorted(tuple(r[c] for c in ("file_uid", "uid_a", "uid_b", "iou", "containment_a_in_b", "containment_b_in_a", "pixel_identical")) for r in df.collect())
    assert key(raster.measured_pairs(png)) == key(runs.pairs(as_runs)) and runs.pairs(as_runs.limit(0)).count() == 0


def test_distances_are_exact(pictures):
    rng = np.random.default_rng(11)
    far = np.zeros((9, 60), bool)
    far[4, 0] = True
    for m in [*pictures, far, far[:, ::-1], rng.random((25, 25)) < 0.02]:
        got = measure.distances(m)
        if not m.any():
            assert np.isinf(got).all()
            continue
        ys, xs = np.nonzero(m)
        want = np.sqrt(((np.arange(m.shape[0])[:, None, None] - ys) ** 2 + (np.arange(m.shape[1])[None, :, None] - xs) ** 2).min(axis=2))
        assert np.array_equal(got, want)


def _brute_fill(m):
    if m[0, 0]:
        return np.ones_like(m)
    seen, todo = {(0, 0)}, [(0, 0)]
    while todo:
        y, x = todo.pop()
        for a, b in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
            if 0 <= a < m.shape[0] and 0 <= b < m.shape[1] and not m[a, b] and (a, b) not in seen:
                seen.add((a, b))
                todo.append((a, b))
    out = np.ones_like(m)
    for y, x in seen:
        out[y, x] = False
    return out


def test_filled_from_the_corner(pictures):
    for m in pictures:
        assert (measure.filled_from_corner(m) == _brute_fill(m)).all()
    band = np.zeros((4, 7), bool)
    band[:, 3] = True
    assert measure.filled_from_corner(band)[:, 3:].all() and not raster.filled(band)[:, 4:].any()


def test_band_and_region():
    m = np.zeros((6, 8), bool)
    m[2, [1, 4]] = True
    m[4, 5] = True
    band = measure.band_of(m)
    assert band[[0, 1, 2, 3]].tolist() == [[False, True, True, True, True, False, False, False]] * 4 and band[4:].tolist() == [[False] * 5 + [True, False, False]] * 2
    assert not measure.band_of(np.zeros((3, 3), bool)).any()
    assert measure.body_region({"lung": m}, 1.0) is None and measure.body_region({"thorax": m}, None) is None and measure.body_region({"thorax": m & False}, 1.0) is None
    got = measure.body_region({"thorax": m, "lung": np.ones((2, 2), bool)}, 2.0)
    assert got["distance_mm"][2, 6] == 2 * 2.0 and got["region_ratio"] == 4 / 48 and got["band_ratio"] == 24 / 48


def test_reference_sets():
    png = lambda m: raster.write_png(m.astype(np.uint8) * 255)
    good, other = png(np.ones((3, 4))), png(np.ones((4, 4)))
    need = ["lung", "thorax", "mediastinum"]
    status = lambda shape=(3, 4), **c: measure.reference_set(c, need, shape)[0]
    assert status(lung=good, thorax=good, mediastinum=good) == "available" and status() == measure.NONE
    assert status(lung=good, thorax=b"Internal Server Error", mediastinum=other) == measure.CORRUPT
    assert status(lung=good, thorax=other) == measure.SHAPE and status(None, lung=good, thorax=other, mediastinum=good) == "available" and status(lung=good) == measure.LUNG
    assert measure.reference_set({"lung": b"", "thorax": good}, ["thorax"], (3, 4))[0] == "available"  # what isn't required may be broken


def test_scan_of_files(spark):
    rng = np.random.default_rng(12)
    png = lambda m, scale=255: raster.write_png((m * scale).astype(np.uint8))
    a, b = blobs(rng, 20, 20, 3), blobs(rng, 20, 20, 3)
    outline = np.zeros((20, 20), bool)
    outline[3:10, 3:10] = True
    whole = outline.copy()
    outline[4:9, 4:9] = False
    body = np.zeros((20, 20), bool)
    body[5:15, 4:12] = True
    files = spark.createDataFrame([
        ("m/a", png(a)), ("m/b", png(b)), ("m/c", b"no picture"), ("m/w", png(whole)), ("o/w", png(outline)), ("o/b", png(np.ones((3, 3)))), *[(f"{k}/f1", png(body)) for k in measure.KINDS], ("x/f1", bytes(200)),
    ], "path string, content binary")
    images = spark.createDataFrame([("f1", "D", "x/f1", 0.5, 2.0, 20, 20), ("f2", "D", "x/f2", None, None, None, None), ("f3", "D", "x/f3", 1.0, 1.0, 5, 5)], "file_uid string, dataset_id string, path string, spacing_x double, spacing_y double, shape_h int, shape_w int")
    ann = spark.createDataFrame([
        ("f1", "a", 0, "m/a", None, ["x"], 1), ("f1", "b", 1, "m/b", "o/b", ["x"], 1), ("f1", "c", 2, "m/c", "o/w", ["y"], 0), ("f1", "w", 3, "m/w", "o/w", ["y"], 0), ("f2", "d", 0, "m/lost", "o/w", ["x"], 1), ("f2", "e", 1, "m/a", "o/lost", ["x"], 1), ("f2", "n", 2, None, None, ["x"], 1),
    ], "file_uid string, geometry_uid string, ann_index int, path_mask string, path_original_mask string, label_keys array<string>, is_latest int")
    found = measure.scan(images, ann, files, {k: F.concat_ws("/", F.lit(k), F.col("file_uid")) for k in measure.KINDS})
    masks = {(r["geometry_uid"], r["role"]): r for r in found["masks"].collect()}
    assert set(masks) == {("a", "mask"), ("b", "mask"), ("b", "original"), ("c", "mask"), ("w", "mask"), ("w", "original"), ("d", "mask"), ("e", "mask"), ("e", "original")}
    assert masks["c", "mask"]["exists"] and masks["c", "mask"]["read_error"] and not masks["d", "mask"]["exists"] and not masks["e", "original"]["exists"] and masks["b", "original"]["read_error"].startswith("shape")
    stats, m = raster.mask_stats(a), masks["a", "mask"]
    assert (m["fg_pixels"], tuple(m["bbox"]), m["n_components"], m["component_areas"], m["mask_hash"]) == (stats["fg_pixels"], stats["bbox"], stats["n_components"], stats["component_areas"], raster.mask_hash(a))
    assert m["area_mm2"] == stats["fg_pixels"] * 1.0 and m["component_areas_mm2"] == [float(n) for n in stats["component_areas"]] and masks["e", "mask"]["area_mm2"] is None
    mm = np.maximum(np.maximum(4 - np.arange(20), np.arange(20) - 11), 0) * 2.0  # the body is a band of columns
    far = np.broadcast_to(mm, (20, 20))[a]
    assert m["lat_containment"] == (far <= 10).mean() and m["lat_max_mm"] == far.max() and m["reference_status"] == "available"
    assert masks["w", "original"]["filled_iou_vs_mask"] == 1.0 and masks["w", "original"]["difference_pixels"] == 0 and masks["e", "mask"]["reference_status"] == measure.NONE
    pairs = {(r["uid_a"], r["uid_b"]): r for r in found["pairs"].collect()}
    assert set(pairs) == {("a", "b"), ("a", "w"), ("b", "w")} and pairs["a", "b"]["iou"] == raster.iou(a, b) and pairs["a", "b"]["same_label_keys"] and not pairs["a", "w"]["both_latest"]
    files_found = {r["file_uid"]: r for r in found["files"].collect()}
    assert files_found["f1"]["dicom_read_error"] and files_found["f1"]["n_masks"] == 4 and files_found["f1"]["reference_available"] == list(measure.KINDS) and not files_found["f2"]["image_exists"]
    assert (files_found["f3"]["n_annotations"], files_found["f3"]["n_masks"], files_found["f3"]["reference_status"]) == (0, 0, measure.NONE)
    ctx = checks.Context(ann.withColumns({"dataset_id": F.lit("D"), "family": F.lit("focal")}), found["masks"], found["files"], found["pairs"])
    said = {(r["check_id"], r["geometry_uid"]) for r in checks.run(ctx, only=["M05", "S03", "S04", "S05"]).collect()}
    assert {("M05_FILE_MISSING", "d"), ("M05_FILE_UNREADABLE", "c"), ("S03_NO_SPACING", "e")} <= said and ("S04_ORIGINAL_FINAL_DIVERGENCE", "w") not in said
    assert all(df.count() == 0 for df in measure.scan(images.limit(0), ann.limit(0), files.limit(0)).values())


def test_outlines_and_fills(pictures):
    for m in pictures:
        want = np.zeros_like(m)
        for y, x in zip(*np.nonzero(m), strict=True):
            want[y, x] = any(not (0 <= a < m.shape[0] and 0 <= b < m.shape[1] and m[a, b]) for a, b in ((y - 1, x), (y + 1, x), (y, x - 1), (y, x + 1)))
        assert (overlay.outline(m) == want).all()
    image = np.full((8, 8), 100, np.uint8)
    a, b = np.zeros((8, 8), bool), np.zeros((8, 8), bool)
    a[1:6, 1:6], b[3:8, 3:8] = True, True
    got = overlay.drawn(image, [a, b, np.ones((2, 2), bool)])
    assert got[0, 0].tolist() == [100] * 3 and got[1, 1].tolist() == list(overlay.COLOURS[0]) and got[7, 7].tolist() == list(overlay.COLOURS[1])
    once = [int(100 * 0.72 + c * 0.28 + 0.5) for c in overlay.COLOURS[0]]
    assert got[2, 2].tolist() == once and got[4, 4].tolist() == [int(v * 0.72 + c * 0.28 + 0.5) for v, c in zip(once, overlay.COLOURS[1], strict=True)]
    assert overlay.drawn(image, [a], (1, 1, 3, 2)).shape == (2, 3, 3) and overlay.grey(np.array([[0, 1000]], np.uint16))[0].tolist() == [[0] * 3, [255] * 3]
    body = np.zeros((8, 8), bool)
    body[2:5, 2:5] = True
    shown = overlay.band_drawn(image, {"thorax": body}, 1.0)
    assert (shown[:, 2] == overlay.BAND_COLOUR).all() and shown[0, 0].tolist() == [100] * 3 and overlay.band_drawn(image, {}, 1.0) is None


def test_pictures_are_written_once(spark, tmp_path):
    image = raster.write_png(np.full((6, 7), 9, np.uint8))
    images = spark.createDataFrame([("f", "f.png", image), ("g", "g.png", image), ("h", "h.png", b"broken")], "file_uid string, name string, content binary")
    m = np.zeros((6, 7), bool)
    m[2:4, 2:5] = True
    masks = spark.createDataFrame([("f", 0, (6, 7, runs.of_array(m)))], f"file_uid string, ann_index int, mask {runs.MASK_DDL}")
    for expected in ("written", "exists"):
        done = {r["name"]: r["status"] for r in raster.written_files(overlay.pictures(images, masks), str(tmp_path)).collect()}
        assert done == {"f.png": expected, "g.png": expected, "h.png": "empty"}
    assert (raster.read_png((tmp_path / "f.png").read_bytes()) == overlay.drawn(np.full((6, 7), 9, np.uint8), [m])).all()
    cut = overlay.pictures(images.filter("file_uid = 'f'"), masks, margin=1).first()["content"]
    assert raster.read_png(bytes(cut)).shape == (4, 5, 3)


def _pictured(rng, n, h, w, share=0.5):
    """Random masks, the first empty and the second whole."""
    m = rng.random((n, h, w)) < share
    m[0], m[1] = False, True
    return m


@pytest.mark.parametrize("shape", [(1, 1), (1, 9), (7, 1), (5, 8), (12, 12), (45, 43)])
def test_stacks_are_measured_as_single_masks_are(shape):
    rng = np.random.default_rng(sum(shape))
    masks = np.concatenate([_pictured(rng, 6, *shape, share) for share in (0.1, 0.5, 0.8)])
    for diagonal in (True, False):
        labels, counts, areas = raster.components_of(masks, diagonal)
        single = [raster.components(m, diagonal) for m in masks]
        assert all((a == b).all() for a, (b, _) in zip(labels, single, strict=True)) and counts.tolist() == [n for _, n in single]
        assert areas.tolist() == [a for m, n in single for a in np.bincount(m.ravel(), minlength=n + 1)[1:].tolist()]
    assert [s | {"bbox": s["bbox"] and tuple(s["bbox"])} for s in raster.stats_of(masks)] == [raster.mask_stats(m) for m in masks]
    for many, one in ((raster.filled_of, raster.filled), (raster.largest_of, raster.largest_component), (measure.bands_of, measure.band_of)):
        assert all((a == one(m)).all() for a, m in zip(many(masks), masks, strict=True)), one.__name__
    some = masks[masks.any(axis=(1, 2))]
    assert all((a == measure.distances(m)).all() for a, m in zip(measure._distances_of(some), some, strict=True))
    for kind in (np.uint8, np.uint16):
        images = rng.integers(0, 255, (4, *shape), kind)
        files = raster.write_pngs(images)
        assert files == [raster.write_png(i) for i in images] and all((a == b).all() and a.dtype == b.dtype for a, b in zip(raster.read_pngs(files), images, strict=True))


def test_a_spiral_and_a_comb_are_one_component_each():
    comb = np.zeros((41, 81), bool)
    comb[:, ::2], comb[-1] = True, True
    spiral = np.zeros((41, 81), bool)
    for k in range(0, 20, 2):
        spiral[k, max(k - 2, 0) : 81 - k] = spiral[k : 41 - k, 80 - k] = spiral[40 - k, k : 81 - k] = spiral[k + 2 : 41 - k, k] = True
    labels, counts, areas = raster.components_of(np.stack([comb, spiral]), False)
    assert counts.tolist() == [1, 1] and areas.tolist() == [comb.sum(), spiral.sum()] and (labels > 0).sum() == areas.sum()


def test_broken_and_odd_files_among_many():
    import struct
    import zlib

    image = np.arange(60, dtype=np.uint8).reshape(5, 4, 3)
    whole = raster.write_png(image)
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    up = bytes([0, *image[0].ravel()]) + b"".join(bytes([2, *(b.ravel() - a.ravel())]) for a, b in zip(image, image[1:], strict=False))
    parts = [chunk(b"IDAT", zlib.compress(up)[:9]), chunk(b"IDAT", zlib.compress(up)[9:])]
    filtered, split = whole[:33] + chunk(b"IDAT", zlib.compress(up)) + chunk(b"IEND", b""), whole[:33] + b"".join(parts) + chunk(b"IEND", b"")
    short, interlaced = whole[:33] + chunk(b"IDAT", zlib.compress(up[:-5])) + chunk(b"IEND", b""), whole[:28] + b"\1" + whole[29:]
    got = raster.read_pngs([whole, None, filtered, b"", split, b"x" * 80, short, whole[:-20], interlaced, whole])
    assert all((got[k] == image).all() for k in (0, 2, 4, 9)) and all(isinstance(got[k], Exception) for k in (1, 3, 5, 6, 7, 8))
    for data, e in zip([b"", b"x" * 80, short, interlaced], [got[3], got[5], got[6], got[8]], strict=True):
        with pytest.raises(type(e)) as raised:
            raster.read_png(data)
        assert str(raised.value) == str(e)


def test_many_images_are_measured_at_once(monkeypatch):
    rng = np.random.default_rng(4)
    png = lambda m: raster.write_png(m.astype(np.uint8) * 255)
    images = []
    for k in range(120):
        h, w = (9, 8) if k % 2 else (6, 11)
        part = lambda role, n, content, there=True: {"file_uid": str(k), "role": role, "geometry_uid": None if n is None else f"{k}-{n}", "ann_index": n, "there": there, "content": content, "rows": h, "columns": w, "label_key": "x", "is_latest": 1, "spacing_x": 0.5, "spacing_y": None if k % 7 == 0 else 2.0}  # noqa: E731, B023
        masks = _pictured(rng, 5, h, w)
        parts = [part("mask", n, png(masks[n])) for n in range(2, 4 + k % 2)] + [part("original", 2, png(masks[1] if k % 3 else np.ones((2, 2))))]
        parts += [part("mask", 5, None, there=False), part("mask", 6, b"broken")] + ([part("mask", 0, png(masks[0]))] if k % 5 == 0 else [])
        body = np.zeros((h, w), bool)
        body[2:-2, 2 : 4 + k % 3] = True
        images.append(parts + [part(kind, None, b"" if k % 11 == 0 and kind == "thorax" else png(body)) for kind in measure.KINDS if k % 13 or kind == "lung"])
    config = settings.merged(settings.DEFAULTS, {"reference": {"margin_mm": 2.0}})
    calls, stats_of = [], raster.stats_of
    monkeypatch.setattr(raster, "stats_of", lambda masks: calls.append(len(masks)) or stats_of(masks))
    found = measure.image_rows(images, config)
    assert len(calls) <= 3 and sum(calls) > 300  # a call for each shape
    assert found == [measure.image_rows([parts], config)[0] for parts in images]
    for parts, (masks, pairs, file) in zip(images, found, strict=True):
        own = {p["geometry_uid"]: raster.read_png(p["content"]) > 0 for p in parts if p["role"] == "mask" and p["there"] and p["content"] != b"broken"}
        contents = {p["role"]: p["content"] for p in parts if p["role"] in measure.KINDS}
        status, references = measure.reference_set(contents, config["reference"]["required_kinds"], (parts[0]["rows"], parts[0]["columns"]))
        region = measure.body_region(references, parts[0]["spacing_y"]) if status == measure.AVAILABLE else None
        assert file["reference_status"] == status and file["band_ratio"] == (region and region["band_ratio"]) and file["region_ratio"] == (region and region["region_ratio"])
        for row in masks:
            if row["role"] == "mask" and row["geometry_uid"] in own:
                m = own[row["geometry_uid"]]
                stats = raster.mask_stats(m)
                assert {k: row[k] for k in ("fg_pixels", "fg_ratio", "n_components", "component_areas")} == {k: stats[k] for k in ("fg_pixels", "fg_ratio", "n_components", "component_areas")} and row["mask_hash"] == raster.mask_hash(m)
                want = measure.outside(m, region["distance_mm"], 2.0, row["area_mm2"]) if region else dict.fromkeys(("lat_containment", "lat_outside_mm2", "lat_outside_pixels", "lat_max_mm"))
                assert {k: row[k] for k in want} == want
        assert all(p["iou"] == raster.iou(own[p["uid_a"]], own[p["uid_b"]]) and p["containment_a_in_b"] == raster.containment(own[p["uid_a"]], own[p["uid_b"]]) for p in pairs)
    assert sum(r["role"] == "original" and r["filled_pixels"] is not None for m, _, _ in found for r in m) == 80


def test_masks_of_boxes(spark):
    boxes = [(g, left, top, w, h, solid) for g, left, top, w, h, solid in [
        (1, 0, 0, 4, 4, False), (1, 0, 0, 4, 4, False), (1, 2, 1, 5, 2, True), (2, -3, -3, 20, 20, False), (3, -2, 1, 4, 3, False), (4, 7, 0, 5, 9, False), (5, 9, 9, 2, 2, True), (6, 0, 0, 0, 3, True), (7, 5, 4, 1, 1, False), (8, -3, -3, 20, 20, True), (9, -2, -2, 12, 5, False)]]
    got = {r["g"]: r["mask"] for r in runs.from_boxes(spark.createDataFrame(boxes, "g int, left int, top int, w int, h int, solid boolean"), ["g"], 6, 8).collect()}
    want: dict[int, np.ndarray] = {}
    for g, left, top, w, h, solid in boxes:
        y, x = np.ogrid[:6, :8]
        inside = (y >= top) & (y < top + h) & (x >= left) & (x < left + w)
        edge = (y == top) | (y == top + h - 1) | (x == left) | (x == left + w - 1)
        want[g] = want.get(g, np.zeros((6, 8), bool)) | inside & (edge | solid)
    assert {g: [tuple(r) for r in m["runs"]] for g, m in got.items()} == {g: runs.of_array(m) for g, m in want.items() if m.any()}
    assert all((m["height"], m["width"]) == (6, 8) for m in got.values())


def test_stacked_runs_are_the_arrays_of_each(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(6)
    lists = [[(int(y), int(x), int(x + d)) for y, x, d in zip(rng.integers(-2, 8, n), rng.integers(-4, 9, n), rng.integers(-1, 9, n), strict=True)] for n in rng.integers(0, 7, 40)]
    kind = pa.list_(pa.struct([("y", pa.int32()), ("x0", pa.int32()), ("x1", pa.int32())]))
    column = pa.array([[dict(zip(("y", "x0", "x1"), r, strict=True)) for r in some] for some in lists] + [None], kind)
    for parts in (1 << 18, 90):
        monkeypatch.setattr(runs, "PARTS", parts)
        for a, b in ((0, 41), (3, 17)):
            assert all((m == runs.to_array(6, 7, some)).all() for m, some in zip(runs.stacked(6, 7, column.slice(a, b - a)), [*lists, []][a:b], strict=True))
    assert runs.shares([5, 1, 1, 9, 2, 2], 4) == [(0, 1), (1, 3), (3, 4), (4, 6)] and runs.shares([], 4) == []


def test_pictures_drawn_together_are_those_drawn_alone(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(8)
    images, lists, shapes, ends, want = [], [], [], [], []
    for k in range(60):
        h, w = [(5, 9), (12, 12), (5, 9), (3, 4)][k % 4]
        image = rng.integers(0, 900, (h, w)).astype(np.uint16) if k % 5 == 0 else rng.integers(0, 255, (h, w) if k % 7 else (h, w, 3)).astype(np.uint8)
        masks = [rng.random((h, w) if n != 2 else (h + 1, w)) < 0.4 for n in range(k % 9)]
        images.append(ValueError("broken") if k % 11 == 0 else image)
        lists += [[dict(zip(("y", "x0", "x1"), r, strict=True)) for r in runs.of_array(m)] for m in masks]
        shapes += [m.shape for m in masks]
        ends.append(len(lists))
        want.append((image if image.ndim == 2 else image.max(axis=2), masks) if k % 11 else None)
    kind = pa.list_(pa.struct([("y", pa.int32()), ("x0", pa.int32()), ("x1", pa.int32())]))
    calls, drawn_of = [], overlay.drawn_of
    monkeypatch.setattr(overlay, "drawn_of", lambda some, own: calls.append(len(some)) or drawn_of(some, own))
    for margin in (None, 1):
        calls.clear()
        made = overlay._pictures(list(images), pa.array(lists, kind), np.array(shapes), np.array(ends), margin)
        assert len(calls) == 3 and [m is None for m in made] == [x is None for x in want]
        for png, x in zip(made, want, strict=True):
            if x is not None:
                image, masks = x
                boxes = [b for m in masks if m.shape == image.shape and (b := raster.bounds(m))] if margin is not None else []
                box = raster.crop_box(boxes, margin, image.shape[1], image.shape[0]) if boxes else None
                assert (raster.read_png(png) == overlay.drawn(image, masks, box)).all()
