"""Masks as sorted runs of their rows: measures and comparisons as column expressions, unions in Arrow batches.

A mask is a struct of height, width and runs; a run is (y, x0, x1) with x1 exclusive. Runs of a row neither overlap nor touch,
so equal masks have equal runs. A mask of ten million pixels with a smooth outline is a few thousand numbers.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUNS_DDL = "array<struct<y:int,x0:int,x1:int>>"
MASK_DDL = f"struct<height:int,width:int,runs:{RUNS_DDL}>"


def of_array(mask: np.ndarray) -> list[tuple[int, int, int]]:
    """The runs of an array."""
    edges = np.diff(mask.astype(np.int8), axis=1, prepend=0, append=0)
    (y, x0), (_, x1) = np.nonzero(edges == 1), np.nonzero(edges == -1)
    return list(zip(y.tolist(), x0.tolist(), x1.tolist(), strict=True))


def to_array(height: int, width: int, runs) -> np.ndarray:
    """The array of runs, overlapping ones too; what lies outside the shape is cut off."""
    edge = np.zeros((height, width + 1), np.int32)
    for y, x0, x1 in runs:
        if 0 <= y < height and x0 < x1:
            edge[y, min(max(x0, 0), width)] += 1
            edge[y, min(max(x1, 0), width)] -= 1
    return np.cumsum(edge, axis=1)[:, :width] > 0


def stacked(height: int, width: int, lists: pa.Array) -> np.ndarray:
    """to_array() of each list of runs, for masks of one shape."""
    out = np.empty((len(lists), height, width), bool)
    for a, b in shares([height * width] * len(lists), PARTS):
        own = lists.slice(a, b - a)
        parts, n = own.flatten(), b - a
        y, x0, x1 = (np.asarray(parts.field(c)).astype(np.int64) for c in ("y", "x0", "x1"))
        owner = np.repeat(np.arange(n), np.asarray(own.value_lengths().fill_null(0)))
        kept = (y >= 0) & (y < height) & (x0 < x1)
        row, size = (owner * height + y)[kept] * (width + 1), n * height * (width + 1)
        begins, ends = (np.bincount(row + np.clip(x[kept], 0, width), minlength=size) for x in (x0, x1))
        out[a:b] = np.cumsum((begins - ends).reshape(n, height, width + 1), axis=2)[:, :, :width] > 0
    return out


def shares(sizes: list[int], most: int) -> list[tuple[int, int]]:
    """Bounds of slices that hold up to so much each, or one that is larger."""
    cuts, held = [0], 0
    for k, size in enumerate(sizes):
        if k > cuts[-1] and held + size > most:
            cuts.append(k)
            held = 0
        held += size
    return list(zip(cuts, [*cuts[1:], len(sizes)], strict=True)) if sizes else []


def from_boxes(boxes: DataFrame, by: list[str], height: int, width: int, name: str = "mask") -> DataFrame:
    """A mask for each group of boxes (columns by, left, top, w, h and solid), which may overlap, touch and repeat; one that isn't solid is its frame, a pixel wide.

    Boxes are gathered, not their rows of pixels, and equal ones once: numpy makes the rows of many masks and joins them. What lies outside the shape is cut off; a group without any pixel has no mask.
    """
    left, top, right, bottom, solid = F.col("left"), F.col("top"), F.col("left") + F.col("w"), F.col("top") + F.col("h"), F.coalesce(F.col("solid").cast("boolean"), F.lit(False))
    seen = (F.col("w") > 0) & (F.col("h") > 0) & (right > 0) & (left < width) & (bottom > 0) & (top < height)
    side = solid | (left >= 0) | (right <= width) | (top >= 0) | (bottom <= height)  # a frame all around the shape has no pixel in it
    box = F.struct(*[F.col(c).cast("int").alias(c) for c in ("left", "top", "w", "h")], solid.alias("solid"))
    whole = boxes.filter(seen & side).groupBy(*by).agg(F.collect_set(box).alias("_boxes"))
    return whole.select(*by, F.struct(F.lit(height).alias("height"), F.lit(width).alias("width"), _boxed(height, width)("_boxes").alias("runs")).alias(name))


@lru_cache(maxsize=8)
def _boxed(height: int, width: int):
    """A column function: boxes as the sorted runs of their rows."""

    def joined(lists: pa.Array) -> pa.Array:
        sizes = (np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64) * 2 * height).tolist()
        return pa.concat_arrays([_box_runs(lists.slice(a, b - a), height, width) for a, b in shares(sizes, PARTS) or [(0, 0)]])

    return F.arrow_udf(joined, RUNS_DDL)


def _box_runs(lists: pa.Array, height: int, width: int) -> pa.Array:
    boxes = lists.flatten()
    left, top, w, h = (np.asarray(boxes.field(c)).astype(np.int64) for c in ("left", "top", "w", "h"))
    solid = boxes.field("solid").to_numpy(zero_copy_only=False).astype(bool)
    first = np.clip(top, 0, height)
    many = np.clip(top + h, 0, height) - first
    box = np.repeat(np.arange(len(top)), many)
    y = np.arange(len(box)) - np.repeat(np.cumsum(many) - many, many) + first[box]
    x0, x1 = left[box], (left + w)[box]
    hollow = ~(solid[box] | (y == top[box]) | (y == (top + h)[box] - 1))  # two parts, a pixel each
    x0, x1 = np.concatenate([x0, x1[hollow] - 1]), np.concatenate([np.where(hollow, x0 + 1, x1), x1[hollow]])
    box, y = np.concatenate([box, box[hollow]]), np.concatenate([y, y[hollow]])
    x0, x1 = np.maximum(x0, 0), np.minimum(x1, width)
    kept = x0 < x1
    mask = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0)))[box[kept]]
    return _joined_parts(len(lists), mask, y[kept], x0[kept], x1[kept])


def from_rows(rows: DataFrame, by: list[str], height: Column, width: Column, name: str = "mask") -> DataFrame:
    """A mask for each group of rows (columns by, y, x0, x1), which may overlap, touch and repeat: gaps and islands in each row of pixels.

    Rows that begin alike are one before a mask is gathered; numpy joins the parts of many masks at once. Parts outside the shape are cut off; rows left empty make no run, and a group
    without any run no mask.
    """
    cut = rows.select(*by, F.col("y").cast("int").alias("y"), F.greatest(F.col("x0"), F.lit(0)).cast("int").alias("x0"), F.least(F.col("x1"), width).cast("int").alias("x1"), height.cast("int").alias("_h"), width.cast("int").alias("_w"))
    cut = cut.filter("x0 < x1 and y >= 0 and y < _h").groupBy(*by, "_h", "_w", "y", "x0").agg(F.max("x1").alias("x1"))  # the longest of those that begin alike
    whole = cut.groupBy(*by, "_h", "_w").agg(F.collect_list(F.struct("y", "x0", "x1")).alias("_runs"))
    return whole.select(*by, F.struct(F.col("_h").alias("height"), F.col("_w").alias("width"), _joined()("_runs").alias("runs")).alias(name))


@lru_cache(maxsize=1)
def _joined():
    """A column function: parts of rows, which may overlap and touch, as sorted runs. A batch of masks is joined at once."""
    return F.arrow_udf(_islands, RUNS_DDL)


#: Parts that are joined at once.
PARTS = 1 << 18


def _islands(lists: pa.Array) -> pa.Array:
    """The runs of each list of parts, some lists at a time: as many as have PARTS parts, or one that has more."""
    before = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64).cumsum() // PARTS
    cuts = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), len(lists)]
    return pa.concat_arrays([_islands_of(lists.slice(a, b - a)) for a, b in zip(cuts, cuts[1:], strict=False)])


def _islands_of(lists: pa.Array) -> pa.Array:
    parts, ends = lists.flatten(), np.asarray(lists.value_lengths().fill_null(0)).cumsum()
    mask = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    return _joined_parts(len(ends), mask, *(np.asarray(parts.field(c)).astype(np.int64) for c in ("y", "x0", "x1")))


def _joined_parts(masks: int, mask: np.ndarray, y: np.ndarray, x0: np.ndarray, x1: np.ndarray) -> pa.Array:
    """The runs of each of so many masks, of parts and whose they are."""
    order = np.lexsort((x0, y, mask))
    mask, y, x0, x1 = mask[order], y[order], x0[order], x1[order]
    row = np.cumsum((np.diff(mask, prepend=-1) != 0) | (np.diff(y, prepend=-1) != 0))
    far = int(x1.max(initial=0)) + 2  # rows stand so far apart that none reaches the next
    reach = np.maximum.accumulate(row * far + x1) if len(x1) else x1
    new = np.ones(len(x0), bool)
    new[1:] = (row * far + x0)[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(x0)) - 1 if len(x0) else first
    runs = [v.astype(np.int32) for v in (y[first], x0[first], (reach - row * far)[last])]
    offsets = np.searchsorted(mask[first], np.arange(masks + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(v) for v in runs], names=["y", "x0", "x1"]))


def merged(masks: DataFrame, by: list[str], order: list[str], mask: str = "mask") -> DataFrame:
    """The union of each group's masks (U7): of the shape of the first by order; others are left out, and an empty union makes none."""
    first = masks.groupBy(*[F.col(b).alias(f"_g_{b}") for b in by]).agg(F.min_by(F.struct(f"{mask}.height", f"{mask}.width"), F.struct(*order)).alias("_shape"))
    on = F.lit(True)
    for b in by:
        on = on & F.col(b).eqNullSafe(F.col(f"_g_{b}"))
    same = masks.join(first, on).filter((F.col(f"{mask}.height") == F.col("_shape.height")) & (F.col(f"{mask}.width") == F.col("_shape.width")))
    rows = same.select(*by, "_shape", F.explode(f"{mask}.runs").alias("_r")).select(*by, "_shape", "_r.*")
    return from_rows(rows, by, F.col("_shape.height"), F.col("_shape.width"), mask)


def area(mask: Column) -> Column:
    """Foreground pixels."""
    return F.aggregate(mask["runs"], F.lit(0).cast("long"), lambda n, r: n + r["x1"] - r["x0"])


def box(mask: Column) -> Column:
    """Inclusive bounds, null for an empty mask."""
    low = lambda c: F.array_min(F.transform(mask["runs"], lambda r: r[c]))
    high = lambda c: F.array_max(F.transform(mask["runs"], lambda r: r[c]))
    return F.when(F.size(mask["runs"]) > 0, F.struct(low("x0").alias("min_x"), low("y").alias("min_y"), (high("x1") - 1).alias("max_x"), high("y").alias("max_y")))


def touches_border(mask: Column) -> Column:
    return F.exists(mask["runs"], lambda r: (r["y"] == 0) | (r["y"] == mask["height"] - 1) | (r["x0"] == 0) | (r["x1"] == mask["width"]))


def same_shape(a: Column, b: Column) -> Column:
    return (a["height"] == b["height"]) & (a["width"] == b["width"])


def intersection(a: Column, b: Column) -> Column:
    """Pixels of both masks of one shape, null for two shapes: the ends of all runs in order, and how much lies inside both."""

    def ends(mask: Column, first: int, second: int) -> Column:
        at = lambda r, c: r["y"].cast("long") * mask["width"] + r[c]
        end = lambda r, c, sign: F.struct(at(r, c).alias("at"), F.lit(sign * first).alias("a"), F.lit(sign * second).alias("b"))
        return F.flatten(F.transform(mask["runs"], lambda r: F.array(end(r, "x0", 1), end(r, "x1", -1))))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).cast("long").alias("n"))

    def step(s: Column, e: Column) -> Column:
        inside = F.when((s["a"] > 0) & (s["b"] > 0), e["at"] - s["at"]).otherwise(F.lit(0).cast("long"))
        return F.struct(e["at"].alias("at"), (s["a"] + e["a"]).alias("a"), (s["b"] + e["b"]).alias("b"), (s["n"] + inside).alias("n"))

    both = F.aggregate(F.array_sort(F.concat(ends(a, 1, 0), ends(b, 0, 1))), start, step, lambda s: s["n"])
    return F.when(same_shape(a, b), both)


def iou(a: Column, b: Column) -> Column:
    """Two empty masks are equal."""
    both, every = intersection(a, b), area(a) + area(b)
    return F.when(every == 0, F.when(same_shape(a, b), 1.0)).otherwise(both / (every - both))


def containment(inner: Column, outer: Column) -> Column:
    """An empty mask is inside any."""
    return F.when(area(inner) == 0, F.when(same_shape(inner, outer), 1.0)).otherwise(intersection(inner, outer) / area(inner))


def digest(mask: Column) -> Column:
    """Equal for equal masks only (G4): of the shape and the runs."""
    runs = F.array_join(F.transform(mask["runs"], lambda r: F.concat_ws(",", r["y"], r["x0"], r["x1"])), ";")
    return F.sha2(F.concat_ws("|", mask["height"], mask["width"], runs), 256)


def row_filled(mask: Column) -> Column:
    """Each row from its first to its last pixel."""
    every = mask["runs"]
    last = F.size(every) - 1
    begins = F.filter(every, lambda r, i: (i == 0) | (F.get(every, i - 1)["y"] != r["y"]))  # runs are sorted, so a row's stand together
    ends = F.filter(every, lambda r, i: (i == last) | (F.get(every, i + 1)["y"] != r["y"]))
    run = lambda a, b: F.struct(a["y"].alias("y"), a["x0"].alias("x0"), b["x1"].alias("x1"))
    return F.struct(mask["height"].alias("height"), mask["width"].alias("width"), F.zip_with(begins, ends, run).alias("runs"))


def crop_box(boxes: Column, margin: int, width: Column, height: Column) -> Column:
    """The union of boxes and a margin, inside the image."""
    low = lambda c: F.greatest(F.array_min(F.transform(boxes, lambda b: b[c])) - margin, F.lit(0))
    high = lambda c, end: F.least(F.array_max(F.transform(boxes, lambda b: b[c])) + margin, end - 1)
    return F.struct(low("min_x").alias("min_x"), low("min_y").alias("min_y"), high("max_x", width).alias("max_x"), high("max_y", height).alias("max_y"))


def pairs(masks: DataFrame, mask: str = "mask") -> DataFrame:
    """All pairs of one image's masks of equal shape (J3): file_uid, uid_a, uid_b and how they overlap. masks has file_uid, geometry_uid, ann_index.

    An image's masks meet by a join on the image; what it makes is the pairs that are asked for.
    """
    side = lambda k: masks.select(F.col("file_uid").alias(f"_f{k}"), F.struct("ann_index", "geometry_uid").alias(f"_o{k}"), F.col(mask).alias(f"_m{k}"))
    a, b = F.col("_ma"), F.col("_mb")
    both = side("a").join(side("b"), (F.col("_fa") == F.col("_fb")) & (F.col("_oa") < F.col("_ob")) & same_shape(a, b)).withColumn("_n", intersection(a, b)).withColumns({"_sa": area(a), "_sb": area(b)})
    share = lambda n, of: F.when(F.col(of) == 0, 1.0).otherwise(F.col(n) / F.col(of))
    every = F.col("_sa") + F.col("_sb") - F.col("_n")
    return both.select(
        F.col("_fa").alias("file_uid"), F.col("_oa.geometry_uid").alias("uid_a"), F.col("_ob.geometry_uid").alias("uid_b"), F.when(every == 0, 1.0).otherwise(F.col("_n") / every).alias("iou"),
        share("_n", "_sa").alias("containment_a_in_b"), share("_n", "_sb").alias("containment_b_in_a"), (a["runs"] == b["runs"]).alias("pixel_identical"), F.col("_n").alias("intersection_pixels"), every.alias("union_pixels"),
    )
