"""Pictures of images with their masks and bands (G19, SK17): outlines and blended fills in numpy, written by executors, each file once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.functions import measure, raster, runs

#: Colours of masks in their order, repeating (fixed values), and how much of the colour a filled pixel has.
COLOURS = ((0xE4, 0x1A, 0x1C), (0x37, 0x7E, 0xB8), (0x4D, 0xAF, 0x4A), (0xFF, 0x7F, 0x00), (0x98, 0x4E, 0xA3), (0xA6, 0x56, 0x28))
FILL, BAND_FILL = 0.28, 0.45
BAND_COLOUR = (0xFF, 0xFF, 0x00)


def _inside(padded: np.ndarray) -> np.ndarray:
    return padded[..., :-2, 1:-1] & padded[..., 2:, 1:-1] & padded[..., 1:-1, :-2] & padded[..., 1:-1, 2:]


def outline(mask: np.ndarray) -> np.ndarray:
    """The pixels of a mask that have a side on its outside, or on the image's edge; those around its holes too."""
    m = mask.astype(bool)
    return m & ~_inside(np.pad(m, 1))


def grey(image: np.ndarray) -> np.ndarray:
    """An image as three equal 8-bit channels; one of more bits is stretched from its least to its greatest value."""
    x = image.astype(np.float64)
    if image.dtype != np.uint8:
        low, high = float(x.min()), float(x.max())
        x = (x - low) / (high - low) * 255 if high > low else np.zeros_like(x)
    return np.repeat(np.floor(x + 0.5)[..., None], 3, axis=2)


def _filled(canvas: np.ndarray, mask: np.ndarray, colour: tuple, share: float) -> None:
    canvas[mask] = np.floor(canvas[mask] * (1 - share) + np.array(colour, float) * share + 0.5)


def drawn(image: np.ndarray, masks: list[np.ndarray], box: tuple | None = None) -> np.ndarray:
    """Red, green and blue of an image with its masks: fills in their order, then all outlines. Masks of another shape are left out; box cuts out a part."""
    canvas = grey(image)
    same = [(m.astype(bool), COLOURS[k % len(COLOURS)]) for k, m in enumerate(masks) if m.shape == image.shape]
    for m, colour in same:
        _filled(canvas, m, colour, FILL)
    for m, colour in same:
        canvas[outline(m)] = colour
    x0, y0, x1, y1 = box or (0, 0, image.shape[1] - 1, image.shape[0] - 1)
    return canvas[y0 : y1 + 1, x0 : x1 + 1].astype(np.uint8)


def drawn_of(images: np.ndarray, masks: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """drawn() of a stack of 8-bit grey images; masks has, for each place in the order of an image's masks, which images have one there of their shape, and those masks."""
    out = np.empty((*images.shape, 3), np.uint8)
    levels = np.arange(256.0)
    edges = [own & ~_inside(np.pad(own, ((0, 0), (1, 1), (1, 1)))) for _, own in masks]
    for c in range(3):
        canvas = images.copy()
        for k, (at, own) in enumerate(masks):
            blend = np.floor(levels * (1 - FILL) + float(COLOURS[k % len(COLOURS)][c]) * FILL + 0.5).astype(np.uint8)  # what a fill makes of each value
            part = canvas[at]
            canvas[at] = np.where(own, blend[part], part)
        for k, ((at, _), edge) in enumerate(zip(masks, edges, strict=True)):
            part = canvas[at]
            canvas[at] = np.where(edge, np.uint8(COLOURS[k % len(COLOURS)][c]), part)
        out[..., c] = canvas
    return out


def band_drawn(image: np.ndarray, references: dict[str, np.ndarray], spacing_y: float | None) -> np.ndarray | None:
    """An image with the band beside which nothing of a body is; None without a body (SK17)."""
    region = measure.body_region(references, spacing_y)
    if region is None or region["distance_mm"].shape != image.shape:
        return None
    canvas, band = grey(image), region["distance_mm"] == 0
    _filled(canvas, band, BAND_COLOUR, BAND_FILL)
    canvas[outline(band)] = BAND_COLOUR
    return canvas.astype(np.uint8)


def _pictures(images: list, lists: pa.Array, shapes: np.ndarray, ends: np.ndarray, margin: int | None) -> list[bytes | None]:
    """A PNG of each image with its masks; none of an error. lists has the runs of all masks, image by image, and ends where an image's end; images of one shape are drawn at once."""
    out: list[bytes | None] = [None] * len(images)
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    owner = np.repeat(np.arange(len(images)), ends - begins)
    alike: dict[tuple, list[int]] = {}
    for k, image in enumerate(images):
        if isinstance(image, np.ndarray):
            if image.ndim == 3:
                images[k] = image = image.max(axis=2)
            alike.setdefault(image.shape, []).append(k)
    for (h, w), found in alike.items():
        place = np.full(len(images), -1)
        place[found] = np.arange(len(found))
        stack = np.stack([images[k] if images[k].dtype == np.uint8 else grey(images[k])[..., 0].astype(np.uint8) for k in found])
        same = np.flatnonzero((place[owner] >= 0) & (shapes[:, 0] == h) & (shapes[:, 1] == w))
        masks, image = runs.stacked(h, w, lists.take(pa.array(same))), place[owner[same]]
        nth = same - begins[owner[same]]
        whole = drawn_of(stack, [(image[nth == k], masks[nth == k]) for k in range(int(nth.max(initial=-1)) + 1)])
        boxes: list[list] = [[] for _ in found]
        if margin is not None:
            for k, m in zip(image.tolist(), masks, strict=True):
                boxes[k] += [b] if (b := raster.bounds(m)) else []
        if not any(boxes):
            for k, png in zip(found, raster.write_pngs(whole), strict=True):
                out[k] = png
            continue
        for k, picture, some in zip(found, whole, boxes, strict=True):
            x0, y0, x1, y1 = raster.crop_box(some, margin, w, h) if some else (0, 0, w - 1, h - 1)
            out[k] = raster.write_png(picture[y0 : y1 + 1, x0 : x1 + 1])
    return out


def pictures(images: DataFrame, masks: DataFrame, margin: int | None = None) -> DataFrame:
    """name and content, a PNG, of each image with its masks; raster.written_files() writes them and leaves alone what is there.

    images: file_uid, name and content (a grey PNG); masks: file_uid, ann_index and mask (runs). With a margin the picture is cut to the masks' bounds
    and so much around. An image that can't be read has no content; one without masks is drawn as it is. An image and its masks meet in one task.
    """
    # drawing costs far more than its bytes tell, so a fixed number of tasks shares it
    parts = int(masks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = masks.repartition(parts, "file_uid").select(F.col("file_uid").alias("_f"), F.struct("ann_index", "mask").alias("_m")).groupBy("_f").agg(F.array_sort(F.collect_list("_m")).alias("masks"))
    both = images.repartition(parts, "file_uid").select("file_uid", F.col("name").cast("string").alias("name"), "content").join(kept, F.col("file_uid") == F.col("_f"), "left").select("name", "content", F.transform(F.coalesce("masks", F.array()), lambda m: m["mask"]).alias("masks"))

    def draw(stream):
        for batch in stream:
            names, files = batch.column("name"), batch.column("content").to_pylist()
            lists = batch.column("masks")
            ends = np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))
            own = lists.flatten()
            shapes = np.stack([np.asarray(own.field(c).fill_null(0)).astype(np.int64) for c in ("height", "width")], axis=1)
            pixels = np.concatenate([[0], np.cumsum(shapes[:, 0] * shapes[:, 1])])[np.concatenate([[0], ends])]
            sizes = [max(raster.declared_pixels(f), n) for f, n in zip(files, np.diff(pixels).tolist(), strict=True)]
            for a, b in runs.shares(sizes, raster.PIXELS):
                start = int(ends[a - 1]) if a else 0
                made = _pictures(raster.read_pngs(files[a:b]), own.field("runs").slice(start, int(ends[b - 1]) - start), shapes[start : ends[b - 1]], ends[a:b] - start, margin)
                yield pa.RecordBatch.from_arrays([names.slice(a, b - a), pa.array(made, pa.binary())], names=["name", "content"])

    return both.mapInArrow(draw, "name string, content binary")
