"""Raster kernels against plain definitions."""

import numpy as np
import pytest

from adjudica.functions import raster as R


def _flood(mask, diagonal):
    seen, n = np.zeros(mask.shape, dtype=int), 0
    steps = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a or b) and (diagonal or not (a and b))]
    for start in zip(*np.nonzero(mask), strict=True):
        if seen[start]:
            continue
        n += 1
        todo = [start]
        while todo:
            y, x = todo.pop()
            if 0 <= y < mask.shape[0] and 0 <= x < mask.shape[1] and mask[y, x] and not seen[y, x]:
                seen[y, x] = n
                todo += [(y + a, x + b) for a, b in steps]
    return seen, n


@pytest.mark.parametrize("seed", range(6))
def test_against_flood(seed):
    random = np.random.default_rng(seed)
    m = random.random((17, 23)) < (0.3 + 0.1 * (seed % 3))
    want, n = _flood(m, True)
    got, k = R.labelled(m)
    assert k == n and len({(a, b) for a, b in zip(got.ravel().tolist(), want.ravel().tolist(), strict=True)}) == n + 1
    padded = np.pad(~m, 1, constant_values=True)
    outside = _flood(padded, False)[0]
    assert (R.filled(m) == ~(outside == outside[0, 0])[1:-1, 1:-1]).all()
    ys, xs = np.nonzero(m)
    want = np.sqrt(((np.arange(17)[:, None, None] - ys) ** 2 + (np.arange(23)[None, :, None] - xs) ** 2).min(axis=2))
    assert np.allclose(R.distance_outside(m), want)


def test_masks():
    a, b, none = np.zeros((10, 10), bool), np.zeros((10, 10), bool), np.zeros((10, 10), bool)
    a[1:5, 1:5], b[3:7, 3:7] = True, True
    assert R.iou(a, b) == 4 / 28 and R.iou(none, none) == 1.0 and R.containment(none, a) == 1.0 and R.containment(a, b) == 0.25
    assert R.merge_masks([a, b, np.ones((2, 2))]).sum() == 28 and R.merge_masks([none]) is None and R.merge_masks([]) is None
    s = R.mask_stats(a | np.eye(10, dtype=bool)[::-1])
    assert s["touches_border"] and s["bbox"] == (0, 0, 9, 9) and R.mask_stats(none)["bbox"] is None
    assert R.mask_hash(a) != R.mask_hash(b) and R.mask_hash(a) == R.mask_hash(a.copy())
    assert R.outside_body(none, a, 1, 1, 0) == {"containment": 1.0, "outside_pixels": 0, "outside_mm2": 0.0, "max_mm": 0.0}
    o = R.outside_body(b, a, 0.5, 0.5, 0.5)
    assert o["outside_pixels"] < 12 and 0 < o["containment"] < 1
    assert R.crop_box([(2, 2, 3, 3), (5, 1, 6, 9)], 2, 10, 10) == (0, 0, 8, 9) and R.lung_rect((0, 0, 1, 1), None) is None
    assert R.lung_rect((0, 1, 2, 3), (4, 0, 5, 9)) == (0, 0, 6, 10) and R.pixels_to_mm2(4, None, 1) is None
    assert R.row_filled(np.array([[1, 0, 1, 0]])).tolist() == [[True, True, True, False]]
    assert R.extrapolated_rows(np.array([[0, 0], [1, 0], [0, 0], [0, 1], [0, 0]], bool)).tolist() == [[True, False], [True, False], [True, False], [False, True], [False, True]]
    assert R.largest_component(a).sum() == 16


def test_png_and_hashes():
    random = np.random.default_rng(1)
    for kind in (np.uint8, np.uint16):
        image = random.integers(0, np.iinfo(kind).max, (9, 13)).astype(kind)
        assert (R.read_png(R.write_png(image)) == image).all()
    assert R.measure(b"junk")["read_error"] and R.measure(None)["read_error"]
    big = random.integers(0, 255, (64, 64)).astype(np.uint8)
    t = np.array(R.thumbnail(big))
    assert abs(t @ t - 1) < 1e-9 and len(R.difference_hash(big)) == 16 and R.windowed(big).dtype == np.uint8


def test_measured(spark):
    a, b = np.zeros((10, 10), np.uint8), np.zeros((10, 10), np.uint8)
    a[1:5, 1:5], b[3:7, 3:7] = 255, 255
    df = spark.createDataFrame([("f", "a", 0, bytearray(R.write_png(a))), ("f", "b", 1, bytearray(R.write_png(b))), ("f", "c", 2, bytearray(b"x"))], "file_uid string, geometry_uid string, ann_index int, content binary")
    got = {r["geometry_uid"]: r["m"] for r in R.measured(df).collect()}
    assert got["a"]["fg_pixels"] == 16 and got["a"]["unique_values"] == [0, 255] and got["c"]["read_error"] and got["c"]["fg_pixels"] is None
    p = R.measured_pairs(df).collect()
    assert len(p) == 1 and abs(p[0]["iou"] - 4 / 28) < 1e-12 and not p[0]["pixel_identical"]


def test_original_difference():
    final = np.zeros((8, 8), dtype=bool)
    final[2:6, 2:6] = True
    brush = final.copy()
    brush[3:5, 3:5] = False  # an outline
    assert R.original_difference(brush, final) == {"filled_pixels": 16, "filled_iou_vs_mask": 1.0, "difference_pixels": 0, "difference_ratio": 0.0}
    brush[2, 2:6] = False  # open: its inside is background
    got = R.original_difference(brush, final)
    assert got["filled_pixels"] == 8 and got["difference_pixels"] == 8 and got["difference_ratio"] == 0.5
    assert R.original_difference(brush, np.zeros((8, 8), dtype=bool))["difference_ratio"] is None and "read_error" in R.original_difference(brush, final[:4])


def _filtered(raw, kinds, step):
    """Rows of bytes with PNG's filters applied, byte by byte."""
    h, n = raw.shape
    out = np.zeros((h, n + 1), dtype=np.uint8)
    at = lambda y, x: int(raw[y, x]) if y >= 0 and x >= 0 else 0
    for y in range(h):
        out[y, 0] = kinds[y]
        for x in range(n):
            a, b, c = at(y, x - step), at(y - 1, x), at(y - 1, x - step)
            p = a + b - c
            best = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            out[y, x + 1] = (at(y, x) - [0, a, b, (a + b) // 2, best][kinds[y]]) % 256
    return out


def test_png_filters():
    import struct
    import zlib

    g = np.random.default_rng(3)
    for h, w, channels, depth, kinds in [(7, 5, 1, 8, (0, 1, 2, 3, 4)), (5, 9, 3, 8, (0, 1, 2, 3, 4)), (6, 4, 4, 16, (3, 4)), (6, 4, 2, 8, (0, 1, 2)), (1, 1, 1, 16, (4,)), (9, 2, 1, 8, (1, 2))]:
        image = g.integers(0, 256**(depth // 8), (h, w, channels)).astype(np.uint8 if depth == 8 else np.uint16)
        raw = np.frombuffer(image.astype(f">u{depth // 8}").tobytes(), dtype=np.uint8).reshape(h, -1)
        body = _filtered(raw, g.choice(kinds, h), channels * depth // 8)
        chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
        colour = {1: 0, 2: 4, 3: 2, 4: 6}[channels]
        data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, colour, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(body.tobytes())) + chunk(b"IEND", b"")
        got = R.read_png(data)
        assert (got.reshape(h, w, channels) == image).all()
