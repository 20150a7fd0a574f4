"""Checks: each turns records and measurements into issues.

A check is a function of a Context that returns rows of ISSUE; CHECKS lists them in registry order. Inputs are the
tables annotations, masks, files and pairs with the columns named in schema.py; no check reads files.
Statuses are never folded: checked, cannot_determine and not_applicable stay apart.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica import config as settings
from adjudica.operators import scale, survivors
from adjudica.storage import written

ISSUE = ["check_ord", "check_id", "category", "severity", "status", "dataset_id", "file_uid", "geometry_uid", "cannot_determine_reason", "detail"]


@dataclass
class Context:
    annotations: DataFrame  # in scope
    masks: DataFrame | None = None
    files: DataFrame | None = None
    pairs: DataFrame | None = None
    images: DataFrame | None = None
    cross: DataFrame | None = None  # issues across datasets, see resolve_cross_dataset()
    config: dict = field(default_factory=lambda: settings.DEFAULTS)
    roots: dict[str, str] = field(default_factory=lambda: {"image_path": "image", "path_mask": "mask", "path_original_mask": "mask"})
    depth: int = 8


def issues(df: DataFrame, check_id: str | Column, category: str, severity: str | Column, status: str | Column = "checked", reason: Column | None = None, details: Column | None = None, **detail: Column) -> DataFrame:
    """Rows of ISSUE; detail keeps its keys sorted, details is a map of its own."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    pairs = [c for k in sorted(detail) for c in (F.lit(k), detail[k].cast("string"))]
    has = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    return df.select(
        F.lit(0).alias("check_ord"), lit(check_id).alias("check_id"), F.lit(category).alias("category"), lit(severity).alias("severity"), lit(status).alias("status"),
        has("dataset_id").alias("dataset_id"), has("file_uid").alias("file_uid"), has("geometry_uid").alias("geometry_uid"),
        (reason if reason is not None else F.lit(None)).cast("string").alias("cannot_determine_reason"),
        (details if details is not None else F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("detail"),
    )


def kind(when: Column, check_id: str, severity: str | Column, status: str = "checked", reason: Column | None = None, **detail: Column) -> Column:
    """What found() makes a row of where the condition holds, else null."""
    pairs = [c for k in sorted(detail) for c in (F.lit(k), detail[k].cast("string"))]
    told = severity if isinstance(severity, Column) else F.lit(severity)
    text = (reason if reason is not None else F.lit(None)).cast("string")
    return F.when(when, F.struct(
        F.lit(check_id).alias("check_id"), told.alias("severity"), F.lit(status).alias("status"), text.alias("reason"),
        (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string,string>").alias("detail")))


def found(df: DataFrame, category: str, *kinds: Column, more: Column | None = None) -> DataFrame:
    """Rows of ISSUE for every kind() that holds, in one pass over df however many kinds there are; more is an array of kinds."""
    every = F.array(*kinds) if more is None else F.concat(F.array(*kinds), F.coalesce(more, F.array()))
    rows = df.withColumn("_i", F.explode(F.filter(every, lambda i: i.isNotNull())))
    return issues(rows, F.col("_i.check_id"), category, F.col("_i.severity"), F.col("_i.status"), F.col("_i.reason"), F.col("_i.detail"))


def measured(ctx: Context, role: str, readable: bool = True) -> DataFrame:
    """Annotations with their mask's measurement of a role (J1, F8); missing and unreadable ones are two states."""
    m = ctx.masks.filter(F.col("role") == role)
    if readable:
        m = m.filter("exists and read_error is null")
    m = m.select(F.col("dataset_id").alias("_d"), F.col("geometry_uid").alias("_g"), F.struct(*[c for c in ctx.masks.columns if c not in ("dataset_id", "geometry_uid", "file_uid")]).alias("m"))
    return ctx.annotations.join(m, (F.col("dataset_id") == F.col("_d")) & (F.col("geometry_uid") == F.col("_g")))


def with_file(df: DataFrame, ctx: Context, how: str = "left") -> DataFrame:
    f = ctx.files.select(F.col("file_uid").alias("_f"), F.struct(*[c for c in ctx.files.columns if c != "file_uid"]).alias("f"))
    return df.join(f, F.col("file_uid") == F.col("_f"), how)


def mask_kinds(ctx: Context) -> list[tuple[str, Column, str, str, str, Column | None, dict[str, Column]]]:
    """Of M01 to M05, what they find of masks: check, condition, check id, severity, status, reason and detail."""
    m = ctx.config["mask"]
    there = F.col("m.exists") & F.col("m.read_error").isNull()
    final, original = there & (F.col("m.role") == "mask"), there & (F.col("m.role") == "original")
    known = F.col("f.dicom_rows").isNotNull() & F.col("f.dicom_columns").isNotNull() if ctx.files is not None else F.lit(False)
    resized = (F.col("m.height") != F.col("f.dicom_rows")) | (F.col("m.width") != F.col("f.dicom_columns")) if ctx.files is not None else F.lit(False)
    odd = F.size(F.array_except("m.unique_values", F.array(*[F.lit(v) for v in m["expected_values"]]))) > 0
    inverted = (F.coalesce("m.value_min", F.lit(0)) != 0) & (F.col("m.fg_ratio") > m["inverted_ratio"])
    empty = F.coalesce((F.col("m.fg_pixels") == 0) | (F.size("m.unique_values") == 1), F.lit(False))
    ratio, role = {"fg_ratio": F.col("m.fg_ratio")}, F.col("m.role").isin("mask", "original")
    return [
        ("M01", final & known & resized, "M01_MASK_RESOLUTION", "error", "checked", None, {"height": F.col("m.height"), "width": F.col("m.width")}),
        ("M01", final & ~known, "M01_MASK_RESOLUTION", "info", "cannot_determine", F.lit("no_dicom_header"), {}),
        ("M02", final & (F.col("m.ndim") != 2), "M02_MASK_NOT_GRAYSCALE", "error", "checked", None, {"ndim": F.col("m.ndim")}),
        ("M02", final & (F.col("m.dtype") != "uint8"), "M02_MASK_NOT_8BIT", "error", "checked", None, {"dtype": F.col("m.dtype")}),
        ("M02", original & (F.col("m.ndim") != 2) & ~F.col("m.n_channels").isin(2, 4), "M02_ORIGINAL_AMBIGUOUS_CHANNELS", "info", "checked", None, {"channels": F.col("m.n_channels")}),
        ("M03", final & (odd | F.col("m.truncated")), "M03_MASK_NOT_BINARY", "error", "checked", None, {}),
        ("M03", final & inverted, "M03_MASK_INVERTED", "warning", "checked", None, {}),
        ("M04", final & empty, "M04_MASK_EMPTY", "error", "checked", None, ratio),
        ("M04", final & ~empty & (F.col("m.fg_ratio") > m["full_ratio"]), "M04_MASK_FULL", "warning", "checked", None, ratio),
        ("M05", role & ~F.col("m.exists"), "M05_FILE_MISSING", "error", "checked", None, {"file": F.col("m.role")}),
        ("M05", role & F.coalesce("m.exists", F.lit(True)) & F.col("m.read_error").isNotNull(), "M05_FILE_UNREADABLE", "error", "checked", None, {"file": F.col("m.role")}),
    ]


def mask_issues(ctx: Context, *names: str) -> DataFrame:
    """What the checks of these names find of masks, by one join and one pass however many they are; a check's issues have its place.

    A row becomes the numbers of the kinds that hold; what else an issue tells is made of the number, so nothing is made that isn't asked for.
    """
    kinds = [k for k in mask_kinds(ctx) if k[0] in names]
    m = ctx.masks.select(F.col("dataset_id").alias("_d"), F.col("geometry_uid").alias("_g"), F.struct(*[c for c in ctx.masks.columns if c not in ("dataset_id", "geometry_uid", "file_uid")]).alias("m"))
    df = ctx.annotations.join(m, (F.col("dataset_id") == F.col("_d")) & (F.col("geometry_uid") == F.col("_g")))
    if "M01" in names:
        df = with_file(df, ctx)
    held = F.array_remove(F.array(*[F.when(k[1], i).otherwise(-1) for i, k in enumerate(kinds)]), -1)
    rows = df.withColumn("_k", F.explode(held))

    def told(value) -> Column:
        out = None
        for i, k in enumerate(kinds):
            out = F.when(F.col("_k") == i, value(k)) if out is None else out.when(F.col("_k") == i, value(k))
        return out

    def detail(k) -> Column:
        pairs = [c for name in sorted(k[6]) for c in (F.lit(name), k[6][name].cast("string"))]
        return (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string,string>")

    at = {name: i for i, (name, _, _) in enumerate(CHECKS)}
    found = issues(rows, told(lambda k: F.lit(k[2])), "machine", told(lambda k: F.lit(k[3])), told(lambda k: F.lit(k[4])), told(lambda k: k[5] if k[5] is not None else F.lit(None).cast("string")), told(detail))
    order = F.lit(0)
    for name in names:
        order = F.when(F.col("check_id").startswith(f"{name}_"), placed(name, at[name])).otherwise(order)
    return found.withColumn("check_ord", order.cast("int"))


def mask_resolution(ctx: Context) -> DataFrame:
    return mask_issues(ctx, "M01")


def declared_resolution(ctx: Context) -> DataFrame:
    df = with_file(ctx.annotations, ctx, "inner").filter("f.dicom_rows is not null")
    fields = F.explode(F.array(
        F.struct(F.lit("series.shape").alias("name"), F.col("shape_h").alias("h"), F.col("shape_w").alias("w")),
        F.struct(F.lit("annotation.size").alias("name"), F.col("declared_h").alias("h"), F.col("declared_w").alias("w")),
    ))
    df = df.withColumn("x", fields).filter("x.h is not null and x.w is not null and (x.h <> f.dicom_rows or x.w <> f.dicom_columns)")
    return issues(df, "M01_MASK_RESOLUTION_JSON", "machine", "warning", field=F.col("x.name"))


def mask_channels(ctx: Context) -> DataFrame:
    return mask_issues(ctx, "M02")


def mask_binary(ctx: Context) -> DataFrame:
    return mask_issues(ctx, "M03")


def mask_not_empty(ctx: Context) -> DataFrame:
    return mask_issues(ctx, "M04")


def files_exist(ctx: Context) -> DataFrame:
    return mask_issues(ctx, "M05").unionByName(images_exist(ctx))


def images_exist(ctx: Context) -> DataFrame:
    """What M05 finds of images, an issue each at the first annotation."""
    first = Window.partitionBy("file_uid").orderBy("ann_index")
    one = ctx.annotations.withColumn("_r", F.row_number().over(first)).filter("_r = 1").drop("_r")
    state = F.when(~F.col("f.image_exists"), "M05_FILE_MISSING").when(F.col("f.dicom_read_error").isNotNull(), "M05_FILE_UNREADABLE")
    df = with_file(one, ctx, "inner").withColumn("kind", state).filter("kind is not null")
    return issues(df, F.col("kind"), "machine", "error", file=F.lit("dicom"))


def _paths(ctx: Context) -> DataFrame:
    fields = F.array(*[F.struct(F.lit(k).alias("name"), F.col(k).alias("path"), F.lit(v).alias("root")) for k, v in ctx.roots.items()])
    return ctx.annotations.withColumn("p", F.explode(fields)).filter("p.path is not null").withColumn("parts", path_parts(F.col("p.path")))


def path_parts(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda x: x != "")


def stem(path: Column) -> Column:
    """The file name without its last suffix; a leading dot is no suffix."""
    return F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"^(.+?)(\.[^.]*)?$", 1)


def path_format(ctx: Context) -> DataFrame:
    df = _paths(ctx)
    rel = F.col("p.path")
    a = issues(df.filter(rel.startswith("/")), "M06_PATH_LEADING_SLASH", "machine", "warning", field=F.col("p.name"))
    b = issues(df.filter(F.get("parts", F.lit(0)) != F.col("p.root")), "M06_PATH_UNEXPECTED_ROOT", "machine", "error", field=F.col("p.name"))
    c = issues(df.filter(F.size("parts") != ctx.depth), "M06_PATH_UNEXPECTED_DEPTH", "machine", "warning", depth=F.size("parts"), field=F.col("p.name"))
    expected = F.when(F.col("p.name") == "image_path", F.col("file")).otherwise(F.col("geometry_uid"))
    d = issues(df.filter(stem(rel) != expected), "M06_PATH_NAME_MISMATCH", "machine", "error", field=F.col("p.name"))
    return reduce(DataFrame.unionByName, [a, b, c, d])


def bbox_geometry(ctx: Context) -> DataFrame:
    df = ctx.annotations
    a = issues(df.filter("annotation_type <> 'brush' and (min_x >= max_x or min_y >= max_y)"), "M07_BBOX_DEGENERATE", "machine", "error")
    shaped = df.filter("shape_w is not null and shape_h is not null and (min_x < 0 or min_y < 0 or max_x > shape_w or max_y > shape_h)")
    b = issues(shaped, "M07_BBOX_OUT_OF_IMAGE", "machine", "error")
    c = issues(df.filter("shape_w is null or shape_h is null"), "M07_BBOX_OUT_OF_IMAGE", "machine", "info", "cannot_determine", F.lit("no_series_shape"))
    d = issues(df.filter("declared_w is null or declared_h is null"), "M07_SIZE_FIELDS_NULL", "machine", "info", "not_applicable")
    return reduce(DataFrame.unionByName, [a, b, c, d])


def json_consistency(ctx: Context) -> DataFrame:
    df = measured(ctx, "mask").filter("m.bbox is not null")
    declared = F.struct(*[F.col(c).cast("int").alias(c) for c in ("min_x", "min_y", "max_x", "max_y")])
    a = issues(df.filter(~F.col("m.bbox").eqNullSafe(declared)), "M08_JSON_BBOX_MISMATCH", "machine", "warning")
    b = issues(df.filter(F.col("region_count") != F.col("m.n_components")), "M08_REGION_COUNT_MISMATCH", "machine", "warning", components=F.col("m.n_components"))
    return a.unionByName(b)


def unannotated_images(ctx: Context) -> DataFrame:
    """By image class (C15); images has class."""
    k = F.col("image_class")
    check = F.when(k == "negative_case", "M09_NEGATIVE_CASE").when(k == "unannotated_view", "M09_UNANNOTATED_VIEW").otherwise("M09_UNANNOTATED_SERIES")
    df = ctx.images.filter(k != "annotated").withColumn("geometry_uid", F.lit(None).cast("string"))
    return issues(df, check, "machine", F.when(k == "negative_case", "info").otherwise("warning"), F.when(k == "negative_case", "not_applicable").otherwise("checked"))


def pair_kind(iou: Column, contained: Column, identical: Column, config: dict) -> Column:
    """exact, near or contained, else null."""
    d = config["duplicate"]
    return F.when(identical | (iou >= 1), "exact").when(iou >= d["iou_near"], "near").when(contained >= d["containment"], "contained")


def pair_sides(pairs: DataFrame) -> DataFrame:
    """Two rows for each pair, one per side (C17): geometry_uid and related_uid."""
    sides = F.explode(F.array(F.struct(F.col("uid_a").alias("own"), F.col("uid_b").alias("other")), F.struct(F.col("uid_b").alias("own"), F.col("uid_a").alias("other"))))
    return pairs.withColumn("_s", sides).withColumn("geometry_uid", F.col("_s.own")).withColumn("related_uid", F.col("_s.other")).drop("_s")


def duplicates(ctx: Context) -> DataFrame:
    most = F.greatest("containment_a_in_b", "containment_b_in_a")
    df = ctx.pairs.withColumn("kind", pair_kind(F.col("iou"), most, F.col("pixel_identical"), ctx.config)).filter("kind is not null").withColumn("most", most)
    same = F.col("same_label_keys")
    check = (
        F.when((F.col("kind") == "exact") & same, "D01_EXACT_DUPLICATE").when(F.col("kind") == "exact", "D02_EXACT_MASK_LABEL_CONFLICT")
        .when((F.col("kind") == "near") & same, "D03_NEAR_DUPLICATE").when(F.col("kind") == "near", "D03_OVERLAPPING_DIFFERENT_FINDING")
        .when(same, "D04_CONTAINED_DUPLICATE").otherwise("D04_CONTAINED_DIFFERENT_LABEL")
    )
    severity = (
        F.when(F.col("kind") == "exact", F.when(same & ~F.col("both_latest"), "info").otherwise("error"))
        .when((F.col("kind") == "contained") & ~same, "info").otherwise("warning")
    )
    sided = pair_sides(df.withColumn("check", check).withColumn("sev", severity))
    scope = ctx.annotations.select("dataset_id", F.col("file_uid").alias("_f"), F.col("geometry_uid").alias("_g"))
    sided = sided.drop("dataset_id").join(scope, (F.col("file_uid") == F.col("_f")) & (F.col("geometry_uid") == F.col("_g")))
    return issues(sided, F.col("check"), "duplicate", F.col("sev"), containment=F.bround("most", 6), iou=F.bround("iou", 6), related_uid=F.col("related_uid"))


def cross_dataset(records: DataFrame, images: str = "image_path") -> tuple[DataFrame, DataFrame]:
    """Decisions and issues of annotations that several datasets hold of one image.

    records: dataset_id, geometry_uid, image_path, label_key, content (the mask's hash, else the box), stamp, export (when
    the source document was written) and place (the order of records). Equal labels and contents of one image are copies,
    in whatever datasets they are but one. A group keeps the newest, or of equal stamps the oldest export, and the others go;
    what neither decides is a tie for review. One geometry uid with other labels or contents is a mismatch, and joins nothing.

    Copies meet by their key, not in pairs: a representative of each dataset stands for the equal ones. Contents that are
    missing on both sides are equal, as are missing labels; a record without image meets none. Where a dataset holds one uid
    in several versions, each version is compared with each of another dataset. Decisions have
    dataset_id, geometry_uid, decision, reason, kept_uid, related_uid and group_id; issues the columns of ISSUE besides.
    """
    uid = F.struct("dataset_id", "geometry_uid")
    records = records.filter(F.col(images).isNotNull()).withColumn("_uid", uid)
    copy = [images, "label_key", "content"]
    spread = records.groupBy(*copy).agg(F.min("dataset_id").alias("_low"), F.max("dataset_id").alias("_high"), F.min("place").alias("_first")).filter("_low <> _high")
    group = scale.numbered(spread, ["_first"], "_nth").select(*[F.col(c).alias(f"_{c}") for c in copy], F.format_string("XDUP_%04d", F.col("_nth") + 1).alias("group_id"))
    on = F.lit(True)
    for c in copy:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    members = records.join(group, on).drop(*[f"_{c}" for c in copy])
    chosen = written(survivors.survivor(members, ["group_id"], "stamp", "export", "_uid").select("dataset_id", "geometry_uid", "_uid", "group_id", "survivor", "outcome"), "cross-dataset")
    stays = F.col("_uid") == F.col("survivor")
    decided = chosen.filter("survivor is not null")
    decisions = decided.select(
        "dataset_id", "geometry_uid", F.when(stays, "keep").otherwise("exclude").alias("decision"),
        F.when(stays, "newest_of_cross_dataset_duplicate_group").otherwise("cross_dataset_duplicate").alias("reason"),
        F.col("survivor.geometry_uid").alias("kept_uid"), F.when(~stays, F.col("survivor.geometry_uid")).alias("related_uid"), "group_id",
    )
    other = F.struct(F.col("survivor.dataset_id").alias("dataset_id"), F.col("survivor.geometry_uid").alias("geometry_uid"))
    both = F.explode(F.array(F.struct(F.col("_uid").alias("own"), other.alias("other")), F.struct(other.alias("own"), F.col("_uid").alias("other"))))
    sides = decided.filter(~stays).select("group_id", both.alias("_s")).select("_s.own.*", F.col("_s.other.geometry_uid").alias("related_uid"), F.col("_s.other.dataset_id").alias("other_dataset"), "group_id")
    ties = chosen.filter("survivor is null").select("dataset_id", "geometry_uid", "group_id", F.col("outcome").alias("why"))
    found = issues(sides, "D05_CROSS_DATASET_DUPLICATE", "duplicate", "error", group=F.col("group_id"), other_dataset=F.col("other_dataset"), related_uid=F.col("related_uid"))
    found = found.unionByName(issues(ties, "D05_CROSS_DATASET_DUPLICATE_TIE", "duplicate", "warning", group=F.col("group_id"), undecidable_reason=F.col("why")))
    wrong = cross_dataset_versions(records, images)
    return decisions, found.unionByName(issues(wrong, "D05_CROSS_DATASET_MISMATCH", "duplicate", "error", other_dataset=F.col("other_dataset"), related_uid=F.col("related_uid")))


def cross_dataset_versions(records: DataFrame, images: str = "image_path") -> DataFrame:
    """dataset_id, geometry_uid, related_uid and other_dataset: versions of one uid and image that differ between two datasets, a row a side.

    A version is a label and a content; equal records of a dataset are one version. What one uid's versions list is as long
    as the table has versions of it, and what comes out are their pairs, as asked.
    """
    versions = records.groupBy(F.col(images).alias("_image"), F.col("geometry_uid").alias("_geo"), "dataset_id", "label_key", "content").agg(F.count("*").alias("_n"))
    all_of = F.collect_list(F.struct("dataset_id", F.struct("label_key", "content").alias("_key")))
    several = versions.groupBy("_image", "_geo").agg(all_of.alias("_all"), F.min("dataset_id").alias("_low"), F.max("dataset_id").alias("_high")).filter("_low <> _high")
    differs = F.filter("_all", lambda x: (x["dataset_id"] != F.col("_own.dataset_id")) & (~x["_key"].eqNullSafe(F.col("_own._key"))))
    wrong = several.select("_geo", "_all", F.explode("_all").alias("_own")).withColumn("_x", F.explode(differs))
    return wrong.select(F.col("_own.dataset_id").alias("dataset_id"), F.col("_geo").alias("geometry_uid"), F.col("_geo").alias("related_uid"), F.col("_x.dataset_id").alias("other_dataset"))


def cross_records(ctx: Context) -> DataFrame:
    """What cross_dataset() compares, of a context's annotations: the final mask's hash is the content, without one the box.

    annotations has image_path, label_keys (an array), stamp and export_stamp besides; place is the order of files and annotations in them.
    """
    box = F.concat(F.lit("box:"), F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("min_x", "min_y", "max_x", "max_y")]))
    content = box
    found = ctx.annotations
    if ctx.masks is not None:
        masks = ctx.masks.filter("role = 'mask' and mask_hash is not null").groupBy(F.col("dataset_id").alias("_d"), F.col("geometry_uid").alias("_g")).agg(F.max("mask_hash").alias("_hash"))
        found = found.join(masks, (F.col("dataset_id") == F.col("_d")) & (F.col("geometry_uid") == F.col("_g")), "left")
        content = F.coalesce(F.concat(F.lit("mask:"), F.col("_hash")), box)
    keys = F.array_join(F.sort_array("label_keys"), "|")
    return found.select("dataset_id", "geometry_uid", "image_path", keys.alias("label_key"), content.alias("content"), "stamp", F.col("export_stamp").alias("export"), F.struct("file_uid", "ann_index").alias("place"))


def resolve_cross_dataset(ctx: Context) -> tuple[Context, DataFrame]:
    """The context that all checks look at, without the copies that another dataset's annotation stands for, and the automatic decisions.

    This comes before any check: the losers are hidden from them, and what was found is reported by the check D05.
    """
    decisions, found = cross_dataset(cross_records(ctx))
    decisions = written(decisions, "cross-decisions")
    return replace(ctx, annotations=without_excluded(ctx.annotations, decisions), cross=written(found, "cross-issues")), decisions


def cross_dataset_issues(ctx: Context) -> DataFrame:
    """D05, as resolve_cross_dataset() found them."""
    return ctx.cross.select(*ISSUE)


def without_excluded(annotations: DataFrame, decisions: DataFrame) -> DataFrame:
    """The annotations that other checks look at: copies that another dataset's stand for are left out."""
    gone = decisions.filter("decision = 'exclude'").select("dataset_id", "geometry_uid")
    return annotations.join(gone, ["dataset_id", "geometry_uid"], "left_anti")


def tiny(ctx: Context) -> DataFrame:
    t = ctx.config["tiny"]
    df = measured(ctx, "mask")
    area = F.col("m.area_mm2")
    known, band = area.isNotNull(), small_band(area, F.col("family"), ctx.config)
    a = kind(~known, "S03_NO_SPACING", "info", "cannot_determine", F.lit("no_spacing"))
    b = kind(known & (area < t["annotation_mm2"]), "S03_TINY_ANNOTATION", "warning", area=area)
    c = kind(known & (area >= t["annotation_mm2"]) & band.isNotNull(), "S03_SUSPICIOUSLY_SMALL", F.when(band == "below_floor", "warning").otherwise("info"), band=band)
    stray = lambda part: ~((part >= t["stray_mm2"]) & (part / area >= t["stray_ratio"]))
    parts = F.transform("m.component_areas_mm2", lambda part, at: kind(stray(part), "S03_STRAY_COMPONENT", "warning", component=at))
    return found(df, "suspicious", a, b, c, more=F.when(known & (F.col("m.n_components") > 1), parts))


def small_band(area: Column, family: Column, config: dict) -> Column:
    """below_floor, review_band or null by the floor of a family."""
    s = config["small"]
    floor = F.lit(None).cast("double")
    for name, value in s["by_class"].items():
        floor = F.when(family == name, float(value)).otherwise(floor)
    return F.when(area < floor, "below_floor").when(area < floor * s["band_factor"], "review_band")


def divergence(ctx: Context) -> DataFrame:
    df = measured(ctx, "original").filter("m.filled_iou_vs_mask < 1")
    severity = F.when(F.col("m.difference_ratio") < ctx.config["divergence"]["negligible_ratio"], "info").otherwise("warning")
    return issues(df, "S04_ORIGINAL_FINAL_DIVERGENCE", "suspicious", severity, iou=F.bround("m.filled_iou_vs_mask", 6))


def outside_body(ctx: Context) -> DataFrame:
    o, lat = ctx.config["outside_body"], F.col("m.lat_containment")
    df = measured(ctx, "mask")
    severity = F.when(lat < o["error"], "error").when((lat < o["warn"]) & (F.col("m.lat_outside_mm2") > o["min_mm2"]), "warning").when(lat < 1, "info")
    a = kind(lat.isNull(), "S05_REFERENCE_UNAVAILABLE", "info", "cannot_determine", F.col("m.reference_status"))
    return found(df, "suspicious", a, kind(severity.isNotNull(), "S05_OUTSIDE_BODY", severity, containment=F.bround(lat, 6)))


#: In registry order; what each needs of a context. A new check is a function and a line here.
CHECKS: list[tuple[str, Callable[[Context], DataFrame], tuple[str, ...]]] = [
    ("M01", mask_resolution, ("masks", "files")), ("M01_JSON", declared_resolution, ("files",)), ("M02", mask_channels, ("masks",)),
    ("M03", mask_binary, ("masks",)), ("M04", mask_not_empty, ("masks",)), ("M05", files_exist, ("masks", "files")), ("M06", path_format, ()),
    ("M07", bbox_geometry, ()), ("M08", json_consistency, ("masks",)), ("M09", unannotated_images, ("images",)), ("D01", duplicates, ("pairs",)), ("D05", cross_dataset_issues, ("cross",)),
    ("S03", tiny, ("masks",)), ("S04", divergence, ("masks",)), ("S05", outside_body, ("masks",)),
]


#: Ids of one check in the order in which it finds them, where that is not the alphabet's (fixed values).
FOUND = {
    "M03": ("M03_MASK_NOT_BINARY", "M03_MASK_INVERTED"), "M06": ("M06_PATH_LEADING_SLASH", "M06_PATH_UNEXPECTED_ROOT", "M06_PATH_UNEXPECTED_DEPTH", "M06_PATH_NAME_MISMATCH"),
    "D01": ("D01_EXACT_DUPLICATE", "D02_EXACT_MASK_LABEL_CONFLICT", "D03_NEAR_DUPLICATE", "D03_OVERLAPPING_DIFFERENT_FINDING", "D04_CONTAINED_DUPLICATE", "D04_CONTAINED_DIFFERENT_LABEL"),
    "S03": ("S03_NO_SPACING", "S03_TINY_ANNOTATION", "S03_SUSPICIOUSLY_SMALL", "S03_STRAY_COMPONENT"),
}


def placed(name: str, at: int) -> Column:
    """check_ord of a check's issues: its place in the registry, then that of the id, so that rollups name ids and partners as they were found."""
    ids = F.array(*[F.lit(i) for i in FOUND.get(name, ())]).cast("array<string>")
    return (F.lit(at * 100) + F.coalesce(F.array_position(ids, F.col("check_id")), F.lit(0))).cast("int")


def run(ctx: Context, only: list[str] = (), skip: list[str] = ()) -> DataFrame:
    """All issues of the chosen checks whose tables are there; check_ord is the place in the registry and in the check.

    A check without its tables can't run and gives nothing: executed() tells which did.
    """
    chosen = executed(ctx, only, skip)
    masks = [name for name in ("M01", "M02", "M03", "M04", "M05") if name in chosen]
    parts = [mask_issues(ctx, *masks)] if masks else []
    for i, (name, f, _) in enumerate(CHECKS):
        if name in chosen and (name not in masks or name == "M05"):
            parts.append((images_exist if name == "M05" else f)(ctx).withColumn("check_ord", placed(name, i)))
    return reduce(DataFrame.unionByName, parts)


def executed(ctx: Context, only: list[str] = (), skip: list[str] = ()) -> list[str]:
    return [name for name, _, needs in CHECKS if all(getattr(ctx, n) is not None for n in needs) and (not only or name in only) and name not in skip]
