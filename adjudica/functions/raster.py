"""Raster kernels in numpy (G1–G18, U7), and their Arrow-batched use on binary columns. Arrays never leave a task."""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_AREAS, MAX_VALUES = 32, 8
#: Pixels of pictures that are looked at together.
PIXELS = 1 << 19


def components(mask: np.ndarray, diagonal: bool) -> tuple[np.ndarray, int]:
    """Connected components, numbered from 1 in the order of their first pixels, and how many. Runs of rows are joined by union-find, each row's with those above in one walk."""
    h, w = mask.shape
    padded = np.zeros((h, w + 2), np.int8)
    padded[:, 1:-1] = mask
    edges = np.flatnonzero(np.diff(padded.ravel()))
    starts, ends = edges[::2], edges[1::2]
    rows, begin, end = (starts // (w + 2)).tolist(), (starts % (w + 2)).tolist(), (ends % (w + 2)).tolist()
    parent, near, at = list(range(len(rows))), int(diagonal), 0

    def find(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for k, y in enumerate(rows):
        while rows[at] < y - 1 or rows[at] == y - 1 and end[at] + near <= begin[k]:
            at += 1
        other = at
        while rows[other] == y - 1 and begin[other] < end[k] + near:
            parent[find(other)] = find(k)
            other += 1
    numbers: dict[int, int] = {}
    number = np.array([numbers.setdefault(find(k), len(numbers) + 1) for k in range(len(rows))], np.int32)
    change = np.zeros(h * (w + 2) + 1, np.int32)
    change[starts + 1] = number
    change[ends + 1] -= number
    return np.cumsum(change[:-1], dtype=np.int32).reshape(h, w + 2)[:, 1:-1], len(numbers)


def components_of(masks: np.ndarray, diagonal: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """components() of a stack of masks at once, how many each has, and the areas of all, mask by mask in the order of their numbers.

    Runs that touch are linked, and each takes the first run that it reaches: every round at least halves what isn't joined yet.
    """
    n, h, w = masks.shape
    step = w + 2
    padded = np.zeros((n, h + 1, step), np.int8)  # a blank row keeps the masks apart
    padded[:, :h, 1:-1] = masks
    edges = np.flatnonzero(np.diff(padded.ravel()))
    starts, ends = edges[::2], edges[1::2]
    near = int(diagonal)
    low, high = np.searchsorted(ends, starts - step - near, side="right"), np.searchsorted(starts, ends - step + near, side="left")
    links = np.maximum(high - low, 0)
    a = np.repeat(np.arange(len(starts)), links)
    b = np.arange(len(a)) - np.repeat(np.cumsum(links) - links, links) + np.repeat(low, links)
    first = np.arange(len(starts))
    while len(a):
        np.minimum.at(first, np.maximum(a, b), np.minimum(a, b))
        while (first[first] != first).any():
            first = first[first]
        a, b = first[a], first[b]
        apart = a != b
        a, b = a[apart], b[apart]
    root = first == np.arange(len(first))
    place = np.cumsum(root)[first] - 1  # among the components of all masks
    owner = starts // (step * (h + 1))
    counts = np.bincount(owner[root], minlength=n)
    number = (place + 1 - (np.cumsum(counts) - counts)[owner]).astype(np.int32)
    change = np.zeros(n * (h + 1) * step + 1, np.int32)
    change[starts + 1] = number
    change[ends + 1] -= number
    labels = np.cumsum(change[:-1], dtype=np.int32).reshape(n, h + 1, step)[:, :h, 1:-1]
    return labels, counts, np.bincount(place, weights=ends - starts, minlength=int(counts.sum())).astype(np.int64)


def labelled(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """8-connected components: numbers from 1, and how many."""
    return components(mask, diagonal=True)


def bounds(mask: np.ndarray) -> tuple[int, int, int, int] | None:
    """Inclusive bounds, None for an empty mask."""
    ys, xs = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
    return (int(xs[0]), int(ys[0]), int(xs[-1]), int(ys[-1])) if len(ys) else None


def mask_stats(mask: np.ndarray) -> dict:
    """Foreground, inclusive bounds, component areas from the largest on, and whether the border is touched (G1)."""
    mask = mask.astype(bool)
    fg = int(mask.sum())
    if not fg:
        return {"fg_pixels": 0, "fg_ratio": 0.0, "bbox": None, "n_components": 0, "component_areas": [], "touches_border": False}
    labels, n = labelled(mask)
    areas = sorted(np.bincount(labels.ravel())[1:].tolist(), reverse=True)
    border = bool(mask[0].any() or mask[-1].any() or mask[:, 0].any() or mask[:, -1].any())
    return {"fg_pixels": fg, "fg_ratio": fg / mask.size, "bbox": bounds(mask), "n_components": n, "component_areas": areas[:MAX_AREAS], "touches_border": border}


def stats_of(masks: np.ndarray) -> list[dict]:
    """mask_stats() of a stack of masks."""
    n, h, w = masks.shape
    _, counts, areas = components_of(masks, True)
    order = np.lexsort((-areas, np.repeat(np.arange(n), counts)))
    areas, ends = areas[order].tolist(), np.cumsum(counts).tolist()
    ys, xs = masks.any(axis=2), masks.any(axis=1)
    border = ys[:, 0] | ys[:, -1] | xs[:, 0] | xs[:, -1]
    boxes = zip(xs.argmax(axis=1).tolist(), ys.argmax(axis=1).tolist(), (w - 1 - xs[:, ::-1].argmax(axis=1)).tolist(), (h - 1 - ys[:, ::-1].argmax(axis=1)).tolist(), strict=True)
    out = []
    for fg, many, end, box, touches in zip(masks.sum(axis=(1, 2)).tolist(), counts.tolist(), ends, boxes, border.tolist(), strict=True):
        out.append({"fg_pixels": fg, "fg_ratio": fg / (h * w), "bbox": box if fg else None, "n_components": many, "component_areas": areas[end - many : min(end, end - many + MAX_AREAS)], "touches_border": touches})
    return out


def iou(a: np.ndarray, b: np.ndarray) -> float:
    """Two empty masks are equal."""
    union = np.logical_or(a, b).sum()
    return float(np.logical_and(a, b).sum() / union) if union else 1.0


def containment(inner: np.ndarray, outer: np.ndarray) -> float:
    """An empty mask is inside any."""
    n = inner.astype(bool).sum()
    return float(np.logical_and(inner, outer).sum() / n) if n else 1.0


def mask_hash(mask: np.ndarray) -> str:
    """Equal for equal masks only."""
    return hashlib.blake2b(struct.pack("<II", *mask.shape) + np.packbits(mask.astype(bool)).tobytes(), digest_size=16).hexdigest()


def pixels_to_mm2(pixels, sx, sy):
    """G5; without spacing there is no area."""
    return None if sx is None or sy is None else pixels * sx * sy


def crop_box(boxes: list[tuple[int, int, int, int]], margin: int, width: int, height: int) -> tuple[int, int, int, int]:
    """The union of boxes and a margin, inside the image."""
    x0, y0, x1, y1 = (f(b[i] for b in boxes) for i, f in enumerate((min, min, max, max)))
    return max(0, x0 - margin), max(0, y0 - margin), min(width - 1, x1 + margin), min(height - 1, y1 + margin)


def filled(mask: np.ndarray) -> np.ndarray:
    """The mask with its holes: what background from outside can't reach (G7). Background connects by sides."""
    return components(np.pad(~mask.astype(bool), 1, constant_values=True), diagonal=False)[0][1:-1, 1:-1] != 1


def filled_of(masks: np.ndarray) -> np.ndarray:
    """filled() of a stack of masks."""
    return components_of(np.pad(~masks, ((0, 0), (1, 1), (1, 1)), constant_values=True), False)[0][:, 1:-1, 1:-1] != 1


def row_filled(mask: np.ndarray) -> np.ndarray:
    """Each row from its first to its last pixel."""
    m = mask.astype(bool)
    return np.logical_or.accumulate(m, axis=1) & np.logical_or.accumulate(m[:, ::-1], axis=1)[:, ::-1]


def extrapolated_rows(mask: np.ndarray) -> np.ndarray:
    """Empty rows take the row above that isn't, or else the one below."""
    full = np.flatnonzero(mask.any(axis=1))
    if not len(full):
        return mask.copy()
    at = np.searchsorted(full, np.arange(len(mask)), side="right") - 1
    return mask[full[np.maximum(at, 0)]]


def largest_component(mask: np.ndarray) -> np.ndarray:
    """Of equally large ones the first."""
    labels, n = labelled(mask.astype(bool))
    return labels == 1 + int(np.argmax(np.bincount(labels.ravel(), minlength=n + 1)[1:])) if n else mask.astype(bool)


def largest_of(masks: np.ndarray) -> np.ndarray:
    """largest_component() of a stack of masks."""
    labels, counts, areas = components_of(masks, True)
    owner = np.repeat(np.arange(len(masks)), counts)
    order = np.lexsort((-areas, owner))  # stable: of equal ones the first
    begins = np.cumsum(counts) - counts
    best = np.zeros(len(masks), np.int64)
    some = counts > 0
    best[some] = order[begins[some]] - begins[some] + 1
    return masks & (labels == best[:, None, None])


def distance_outside(region: np.ndarray) -> np.ndarray:
    """Euclidean distance of each pixel to a region, exactly, in pixels (G9): columns first, then rows.

    A pixel's distance along its row can't be more than what it has already, so the walk ends at the greatest distance left.
    """
    h, w = region.shape
    far = float((h + w) ** 2)
    d = np.where(region, 0.0, far)
    for y in range(1, h):
        d[y] = np.where(region[y], 0.0, np.minimum(far, (np.sqrt(d[y - 1]) + 1) ** 2))
    for y in range(h - 2, -1, -1):
        d[y] = np.minimum(d[y], np.minimum(far, (np.sqrt(d[y + 1]) + 1) ** 2))
    out = d.copy()
    for k in range(1, w):
        if k * k >= out.max(initial=0.0):
            break
        np.minimum(out[:, k:], d[:, :-k] + k * k, out=out[:, k:])
        np.minimum(out[:, :-k], d[:, k:] + k * k, out=out[:, :-k])
    return np.sqrt(out)


def outside_body(mask: np.ndarray, region: np.ndarray, spacing_x: float, spacing_y: float, margin_mm: float) -> dict:
    """How much of a mask lies within a margin of a region (G9); an empty mask lies wholly inside."""
    m = mask.astype(bool)
    if not m.any():
        return {"containment": 1.0, "outside_pixels": 0, "outside_mm2": 0.0, "max_mm": 0.0}
    mm = distance_outside(region.astype(bool)) * spacing_y
    out = m & (mm > margin_mm)
    return {"containment": float(1 - out.sum() / m.sum()), "outside_pixels": int(out.sum()), "outside_mm2": float(out.sum() * spacing_x * spacing_y), "max_mm": float(mm[m].max())}


def original_difference(brush: np.ndarray, final: np.ndarray) -> dict:
    """How a stroke's filled outline differs from the final mask (G13); other shapes can't be compared."""
    if brush.shape != final.shape:
        return {"read_error": f"shape {brush.shape} != final {final.shape}"}
    whole, m = filled(brush), final.astype(bool)
    difference, size = int((whole ^ m).sum()), int(m.sum())
    return {"filled_pixels": int(whole.sum()), "filled_iou_vs_mask": iou(whole, m), "difference_pixels": difference, "difference_ratio": difference / size if size else None}


def merge_masks(masks: list[np.ndarray]) -> np.ndarray | None:
    """The union of masks of one shape, the first one's; others are left out; nothing if it is empty."""
    same = [m.astype(bool) for m in masks if m.shape == masks[0].shape] if masks else []
    out = np.logical_or.reduce(same) if same else None
    return out if out is not None and out.any() else None


def binarized(image: np.ndarray) -> np.ndarray:
    """Foreground of an image: its alpha of 2 or 4 channels, the largest of 3."""
    if image.ndim == 3:
        image = image[..., -1] if image.shape[2] in (2, 4) else image.max(axis=2)
    return image > 0


def lung_rect(left: tuple | None, right: tuple | None) -> tuple | None:
    """The union of both lungs' boxes, its far edges exclusive; none without both."""
    if left is None or right is None:
        return None
    return min(left[0], right[0]), min(left[1], right[1]), max(left[2], right[2]) + 1, max(left[3], right[3]) + 1


def windowed(image: np.ndarray, low: float = 1.0, high: float = 99.0) -> np.ndarray:
    """An 8-bit preview, stretched between percentiles."""
    a, b = np.percentile(image, [low, high])
    return (np.clip((image - a) / max(b - a, 1e-9), 0, 1) * 255).astype(np.uint8)


def shrunk(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Means over a grid of cells."""
    ys, xs = (np.linspace(0, n, k + 1).astype(int) for n, k in ((image.shape[0], height), (image.shape[1], width)))
    sums = np.add.reduceat(np.add.reduceat(image.astype(np.float64), np.minimum(ys[:-1], image.shape[0] - 1), axis=0), np.minimum(xs[:-1], image.shape[1] - 1), axis=1)
    return sums / (np.maximum(np.diff(ys), 1)[:, None] * np.maximum(np.diff(xs), 1)[None, :])


def difference_hash(image: np.ndarray, side: int = 8) -> str:
    """Bits that tell whether a cell is brighter than its left neighbour."""
    s = shrunk(image, side, side + 1)
    return np.packbits(s[:, 1:] > s[:, :-1]).tobytes().hex()


def thumbnail(image: np.ndarray, side: int = 32) -> list[float]:
    """A normalised thumbnail whose dot products are correlations."""
    s = shrunk(image, side, side).ravel()
    s = s - s.mean()
    n = np.sqrt((s**2).sum())
    return (s / n if n else s).tolist()


def write_png(image: np.ndarray) -> bytes:
    """An 8- or 16-bit PNG, grey, or of three channels (SK12)."""
    depth, colour = 8 * image.dtype.itemsize, 2 if image.ndim == 3 else 0
    raw = b"".join(b"\0" + row.astype(f">u{depth // 8}").tobytes() for row in image)
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", image.shape[1], image.shape[0], depth, colour, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def write_pngs(images: np.ndarray) -> list[bytes]:
    """write_png() of each image of a stack."""
    n, h, w = images.shape[:3]
    depth, colour = 8 * images.dtype.itemsize, 2 if images.ndim == 4 else 0
    own = images.astype(f">u{depth // 8}").reshape(n, h, -1).view(np.uint8)
    raw = np.zeros((n, h, own.shape[2] + 1), np.uint8)
    raw[:, :, 1:] = own
    head = b"IHDR" + struct.pack(">IIBBBBB", w, h, depth, colour, 0, 0, 0)
    head = b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + head + struct.pack(">I", zlib.crc32(head))
    tail = struct.pack(">I4sI", 0, b"IEND", zlib.crc32(b"IEND"))
    out = []
    for one in raw.reshape(n, -1):
        body = b"IDAT" + zlib.compress(one)
        out.append(b"".join((head, (len(body) - 4).to_bytes(4, "big"), body, zlib.crc32(body).to_bytes(4, "big"), tail)))
    return out


def _unfiltered(raw: np.ndarray, kinds: np.ndarray, step: int) -> np.ndarray:
    """Bytes of a PNG's rows (h x w * step) without their filters (0 to 4 a row).

    Rows that look left or up only are sums. Where a row needs both, the image is walked by anti-diagonals of pixels: all
    that a pixel looks at lies on the two before its own.
    """
    h, n = raw.shape
    if not np.isin(kinds, (3, 4)).any():
        out = raw.copy()
        for y in range(h):
            if kinds[y] == 1:
                out[y] = np.cumsum(raw[y].reshape(-1, step), axis=0, dtype=np.uint8).reshape(-1)
            elif kinds[y] == 2 and y:
                out[y] += out[y - 1]
        return out
    w = n // step
    pixels = raw.reshape(h, w, step)
    walk = np.zeros((w + h + 1, h + 1, step), dtype=np.int16)  # by diagonal + 2 and row + 1; what lies outside stays 0
    kind = kinds.astype(np.int16)[:, None]
    rows = np.arange(h)
    for k in range(w + h - 1):
        lo, hi = max(0, k - w + 1), min(h, k + 1)
        left, up, corner = walk[k + 1, lo + 1 : hi + 1], walk[k + 1, lo:hi], walk[k, lo:hi]
        by_left, by_up, by_corner = np.abs(up - corner), np.abs(left - corner), np.abs(left + up - 2 * corner)
        nearest = np.where((by_left <= by_up) & (by_left <= by_corner), left, np.where(by_up <= by_corner, up, corner))
        own = kind[lo:hi]
        guess = np.where(own == 4, nearest, np.where(own == 3, (left + up) >> 1, np.where(own == 2, up, np.where(own == 1, left, 0))))
        y = rows[lo:hi]
        walk[k + 2, lo + 1 : hi + 1] = (pixels[y, k - y] + guess) & 255
    y, x = np.ogrid[:h, :w]
    return walk[x + y + 2, y + 1].astype(np.uint8).reshape(h, n)


def read_png(data: bytes) -> np.ndarray:
    """A PNG of 8 or 16 bits a channel without interlacing (SC16)."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, body, head = 8, b"", None
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + n]
        head, body = (struct.unpack(">IIBBBBB", part), body) if kind == b"IHDR" else (head, body + part * (kind == b"IDAT"))
        at += 12 + n
    w, h, depth, colour, _, _, interlaced = head
    if interlaced or depth not in (8, 16):
        raise ValueError("unsupported PNG")
    channels = {0: 1, 2: 3, 4: 2, 6: 4}[colour]
    step, raw = channels * depth // 8, np.frombuffer(zlib.decompress(body), dtype=np.uint8).reshape(h, -1)
    out = _unfiltered(raw[:, 1:], raw[:, 0], step)
    image = out.reshape(h, w, channels) if depth == 8 else out.view(">u2").astype(np.uint16).reshape(h, w, channels)
    return image[..., 0] if channels == 1 else image


def declared_pixels(data: bytes | None) -> int:
    """Pixels by a PNG's header; none of what has no header."""
    return int.from_bytes(data[16:20], "big") * int.from_bytes(data[20:24], "big") if data and data[12:16] == b"IHDR" else 0


def _read(data: bytes | None):
    try:
        return read_png(data or b"")
    except Exception as e:  # noqa: BLE001  whatever a broken file does, it is broken
        return e


def read_pngs(files: list[bytes | None]) -> list:
    """read_png() of each file, or the error that it raises. Files of one head that have one part and no filters are read at once."""
    out, alike = [None] * len(files), {}
    for k, data in enumerate(files):
        n = int.from_bytes(data[33:37], "big") if data else 0
        if data and data[:8] == b"\x89PNG\r\n\x1a\n" and data[8:16] == b"\0\0\0\rIHDR" and data[37:41] == b"IDAT" and data[49 + n : 53 + n] == b"IEND" and len(data) == n + 57:
            try:
                alike.setdefault(data[16:29], []).append((k, zlib.decompress(data[41 : 41 + n])))
                continue
            except zlib.error:
                pass
        out[k] = _read(data)
    for head, found in alike.items():
        w, h, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", head)
        channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour, 0)
        size = w * channels * depth // 8
        whole = [(k, raw) for k, raw in found if len(raw) == h * (size + 1)] if size and h and not interlaced and depth in (8, 16) else []
        rows = np.frombuffer(b"".join([raw for _, raw in whole]), np.uint8).reshape(len(whole), h, size + 1) if whole else None
        plain = ~rows[:, :, 0].any(axis=1) if whole else np.zeros(0, bool)
        if plain.any():
            images = np.ascontiguousarray(rows[plain, :, 1:])
            images = images.reshape(-1, h, w, channels) if depth == 8 else images.view(">u2").astype(np.uint16).reshape(-1, h, w, channels)
            images = images[..., 0] if channels == 1 else images
            for k, image in zip([k for (k, _), p in zip(whole, plain.tolist(), strict=True) if p], images, strict=True):
                out[k] = image
        for k, _ in found:
            out[k] = _read(files[k]) if out[k] is None else out[k]
    return out


STATS_DDL = "ndim int, n_channels int, dtype string, height int, width int, fg_pixels long, fg_ratio double, bbox struct<min_x:int,min_y:int,max_x:int,max_y:int>, n_components int, component_areas array<long>, unique_values array<int>, truncated boolean, mask_hash string, read_error string"


def measure(data: bytes | None) -> dict:
    """All measurements of one PNG mask; a file that can't be read gives its error, not a failure."""
    blank = dict.fromkeys([c.split(" ")[0] for c in STATS_DDL.replace(", ", "|").replace("struct<", "struct|").split("|") if " " in c])
    try:
        image = read_png(data)
    except Exception as e:  # noqa: BLE001
        return blank | {"read_error": str(e)[:200]}
    mask, values = binarized(image), np.unique(image)
    stats = mask_stats(mask)
    box = dict(zip(("min_x", "min_y", "max_x", "max_y"), stats["bbox"], strict=True)) if stats["bbox"] else None
    return blank | {
        "ndim": image.ndim, "n_channels": 1 if image.ndim == 2 else image.shape[2], "dtype": str(image.dtype), "height": image.shape[0], "width": image.shape[1],
        "fg_pixels": stats["fg_pixels"], "fg_ratio": stats["fg_ratio"], "bbox": box, "n_components": stats["n_components"], "component_areas": stats["component_areas"],
        "unique_values": values[:MAX_VALUES].astype(int).tolist(), "truncated": len(values) > MAX_VALUES, "mask_hash": mask_hash(mask),
    }


def measured(files: DataFrame, content: str = "content") -> DataFrame:
    """files with m, a struct of measurements of each PNG mask."""

    @F.pandas_udf(STATS_DDL)
    def stats(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(x) for x in s], columns=[c.strip().split(" ")[0] for c in ("ndim", "n_channels", "dtype", "height", "width", "fg_pixels", "fg_ratio", "bbox", "n_components", "component_areas", "unique_values", "truncated", "mask_hash", "read_error")])

    return files.withColumn("m", stats(F.col(content)))


PAIR_DDL = "file_uid string, uid_a string, uid_b string, iou double, containment_a_in_b double, containment_b_in_a double, pixel_identical boolean"


def measured_pairs(masks: DataFrame) -> DataFrame:
    """All pairs of one image's masks (J3, A40): each mask is decoded once. masks has file_uid, geometry_uid, ann_index, content.

    An image's masks are few by nature; they come together in one task.
    """

    def pairs(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["ann_index", "geometry_uid"])
        images = []
        for uid, data in zip(frame["geometry_uid"], frame["content"], strict=True):
            try:
                images.append((uid, binarized(read_png(data))))
            except Exception:  # noqa: BLE001, S112
                continue
        rows = []
        for i, (u, a) in enumerate(images):
            for v, b in images[i + 1 :]:
                if a.shape == b.shape:
                    rows.append((frame["file_uid"].iloc[0], u, v, iou(a, b), containment(a, b), containment(b, a), bool((a == b).all())))
        return pd.DataFrame(rows, columns=["file_uid", "uid_a", "uid_b", "iou", "containment_a_in_b", "containment_b_in_a", "pixel_identical"])

    return masks.select("file_uid", "geometry_uid", "ann_index", "content").groupBy("file_uid").applyInPandas(pairs, PAIR_DDL)


def written_files(files: DataFrame, folder: str, force: bool = False) -> DataFrame:
    """Writes name and content (bytes) of each row into a folder that all executors mount (SK12); name and status.

    A status is written, exists (left alone but by force), empty (no content) or the error. A file appears whole, by a
    rename, so that a task that runs twice does no harm. Names stay below the folder. Nothing is written before the
    result is used, and it should be used once.
    """

    def rows(stream):
        import os
        import uuid

        home = os.path.realpath(folder)
        for batch in stream:
            names, states = batch.column("name").to_pylist(), []
            for name, content in zip(names, batch.column("content").to_pylist(), strict=True):
                target = os.path.realpath(os.path.join(home, name or ""))
                try:
                    if content is None:
                        states.append("empty")
                    elif not name or not target.startswith(home + os.sep):
                        states.append("error: not below the folder")
                    elif os.path.exists(target) and not force:
                        states.append("exists")
                    else:
                        os.makedirs(os.path.dirname(target), exist_ok=True)
                        part = f"{target}.{uuid.uuid4().hex}.part"
                        with open(part, "wb") as f:
                            f.write(content)
                        os.replace(part, target)
                        states.append("written")
                except OSError as e:
                    states.append(f"error: {e.strerror}")
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(states, pa.string())], names=["name", "status"])

    return files.select(F.col("name").cast("string").alias("name"), F.col("content").cast("binary").alias("content")).mapInArrow(rows, "name string, status string")
