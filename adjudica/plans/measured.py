"""The checks, labels, masks, stores and review helpers as queries over measurement tables made of the driver's tables.

A line is an annotation, its order the image, its return flag the dataset. Measurements are made of its numbers, so that
SQL can say what each check must find.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica import config as settings
from adjudica import ids
from adjudica.functions import raster, samples
from adjudica.operators import checks, contracts, ladders, merges, policy, reports, review, rollups
from adjudica.plans.queries import _t, query
from adjudica.sources import artifacts
from adjudica.storage import scratch_path

_LINES = """
WITH a AS (SELECT l_orderkey AS o, l_linenumber AS n, min(l_quantity)::DOUBLE AS q, min(round(l_discount * 100))::BIGINT AS d, min(round(l_tax * 100))::BIGINT AS t, min(l_partkey) AS p, min(l_suppkey) AS s, min(l_returnflag) AS ds FROM lineitem GROUP BY 1, 2)"""


def _lines(spark, sf) -> DataFrame:
    """The lines of orders, dealt by order: what is grouped by order or by mask afterwards moves no more."""
    least = lambda c, k: F.min(c).alias(k)
    percent = lambda c, k: F.min(F.round(F.col(c) * 100)).cast("long").alias(k)
    line = _t(spark, sf, "lineitem").repartition("l_orderkey").groupBy(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"))
    return line.agg(F.min(F.col("l_quantity").cast("double")).alias("q"), percent("l_discount", "d"), percent("l_tax", "t"), least("l_partkey", "p"), least("l_suppkey", "s"), least("l_returnflag", "ds"))


def _context(spark, sf) -> checks.Context:
    a = _lines(spark, sf)
    uid, file_uid = F.concat_ws("-", "o", "n"), F.col("o").cast("string")
    family = F.when(F.col("p") % 3 == 0, "focal").when(F.col("p") % 3 == 1, "localized").otherwise("regional")
    annotations = a.select(
        F.col("ds").alias("dataset_id"), file_uid.alias("file_uid"), uid.alias("geometry_uid"), F.col("n").alias("ann_index"), family.alias("family"), F.when(F.col("n") % 2 == 0, "brush").otherwise("rect").alias("annotation_type"),
        F.when(F.col("d") != 5, 100).alias("shape_w"), F.when(F.col("d") != 5, 100).alias("shape_h"), F.when(F.col("t") != 4, 90 + F.col("d")).alias("declared_w"), F.when(F.col("t") != 4, 100).alias("declared_h"),
        (F.col("q") - 3).cast("long").alias("min_x"), F.lit(0).cast("long").alias("min_y"), (F.col("q") + F.col("n") * 10 - 15).cast("long").alias("max_x"), F.lit(50).cast("long").alias("max_y"), F.col("n").cast("int").alias("region_count"),
    )
    box = F.struct((F.col("q") - 3).cast("int").alias("min_x"), F.lit(0).alias("min_y"), (F.col("q") + F.col("n") * 10 - 15 + F.when(F.col("d") == 7, 1).otherwise(0)).cast("int").alias("max_x"), F.lit(50).alias("max_y"))
    values = F.when(F.col("q") == 2, F.array(F.lit(0))).when(F.col("t") == 3, F.array(F.lit(0), F.lit(7), F.lit(255))).otherwise(F.array(F.lit(0), F.lit(255)))
    area = F.when(F.col("t") != 2, F.col("q") * 4)
    mask = dict(
        exists=F.col("q") != 1, read_error=F.when(F.col("t") == 8, "bad"), ndim=F.when(F.col("n") == 7, 3).otherwise(2), n_channels=(F.col("s") % 5).cast("int"), dtype=F.when(F.col("d") == 10, "uint16").otherwise("uint8"),
        height=(100 + F.col("p") % 50 / 49).cast("int"), width=F.lit(100), value_min=F.when(F.col("d") == 0, 1).otherwise(0), fg_ratio=F.col("d") / 10.0, unique_values=values, truncated=F.col("t") == 5,
        fg_pixels=F.greatest(F.col("q") - 4, F.lit(0)).cast("long"), bbox=box, n_components=(F.col("n") % 4 + 1).cast("int"), component_areas_mm2=F.when(F.col("t") != 2, F.array(F.col("q") * 3, F.col("q"))), area_mm2=area,
        lat_containment=F.when(F.col("t") != 1, 1 - F.col("d") * 3 / 100.0), lat_outside_mm2=F.col("q") * 10, filled_iou_vs_mask=1 - F.col("d") / 100.0, difference_ratio=F.col("d") / 5000.0, reference_status=F.lit("no_reference"),
    )
    masks = a.select(F.col("ds").alias("dataset_id"), file_uid.alias("file_uid"), uid.alias("geometry_uid"), F.explode(F.array(F.lit("mask"), F.lit("original"))).alias("role"), *[c.alias(k) for k, c in mask.items()])
    files = a.groupBy(file_uid.alias("file_uid")).agg((F.min("q") > 2).alias("image_exists"), F.when(F.max("p") % 10 != 0, 100).alias("dicom_rows"), F.when(F.max("p") % 10 != 0, 100).alias("dicom_columns"), F.when(F.max("s") % 20 == 0, "bad").alias("dicom_read_error"))
    return checks.Context(annotations=annotations, masks=masks, files=files)


def _found(ctx: checks.Context, *names: str) -> DataFrame:
    return checks.run(ctx, only=list(names)).groupBy("check_id", "severity", "status").agg(F.count("*").alias("n"))


_FILES = """,
f AS (SELECT o AS fo, min(q) > 2 AS there, CASE WHEN max(p) % 10 <> 0 THEN 100 END AS r, CASE WHEN max(s) % 20 = 0 THEN 'bad' END AS err FROM a GROUP BY 1),
m AS (SELECT a.*, f.*, CAST(floor(100 + p % 50 / 49.0) AS INT) AS h FROM a JOIN f ON o = fo WHERE q <> 1 AND t <> 8)"""


@query(_LINES + _FILES + """, x AS (
SELECT 'M01_MASK_RESOLUTION' AS check_id, 'error' AS severity, 'checked' AS status FROM m WHERE r IS NOT NULL AND h <> r UNION ALL
SELECT 'M01_MASK_RESOLUTION', 'info', 'cannot_determine' FROM m WHERE r IS NULL UNION ALL
SELECT 'M01_MASK_RESOLUTION_JSON', 'warning', 'checked' FROM a JOIN f ON o = fo WHERE r IS NOT NULL AND t <> 4 AND d <> 10 UNION ALL
SELECT 'M02_MASK_NOT_GRAYSCALE', 'error', 'checked' FROM m WHERE n = 7 UNION ALL SELECT 'M02_MASK_NOT_8BIT', 'error', 'checked' FROM m WHERE d = 10 UNION ALL
SELECT 'M02_ORIGINAL_AMBIGUOUS_CHANNELS', 'info', 'checked' FROM m WHERE n = 7 AND s % 5 NOT IN (2, 4) UNION ALL
SELECT 'M03_MASK_NOT_BINARY', 'error', 'checked' FROM m WHERE (t = 3 AND q <> 2) OR t = 5 UNION ALL SELECT 'M03_MASK_INVERTED', 'warning', 'checked' FROM m WHERE d = 0 AND d / 10.0 > 0.5 UNION ALL
SELECT 'M04_MASK_EMPTY', 'error', 'checked' FROM m WHERE q <= 4 UNION ALL SELECT 'M04_MASK_FULL', 'warning', 'checked' FROM m WHERE q > 4 AND d = 10 UNION ALL
SELECT CASE WHEN q = 1 THEN 'M05_FILE_MISSING' ELSE 'M05_FILE_UNREADABLE' END, 'error', 'checked' FROM a, (VALUES (1), (2)) WHERE q = 1 OR t = 8 UNION ALL
SELECT CASE WHEN NOT there THEN 'M05_FILE_MISSING' ELSE 'M05_FILE_UNREADABLE' END, 'error', 'checked' FROM f WHERE NOT there OR err IS NOT NULL)
SELECT check_id, severity, status, count(*) AS n FROM x GROUP BY ALL""")
def mask_checks(spark, sf):
    """Checks of masks and files, missing and unreadable ones apart."""
    return _found(_context(spark, sf), "M01", "M01_JSON", "M02", "M03", "M04", "M05")


@query(_LINES + """, x AS (
SELECT 'M07_BBOX_DEGENERATE' AS check_id, 'error' AS severity, 'checked' AS status FROM a WHERE n % 2 = 1 AND q - 3 >= q + n * 10 - 15 UNION ALL
SELECT 'M07_BBOX_OUT_OF_IMAGE', 'error', 'checked' FROM a WHERE d <> 5 AND (q - 3 < 0 OR q + n * 10 - 15 > 100) UNION ALL SELECT 'M07_BBOX_OUT_OF_IMAGE', 'info', 'cannot_determine' FROM a WHERE d = 5 UNION ALL
SELECT 'M07_SIZE_FIELDS_NULL', 'info', 'not_applicable' FROM a WHERE t = 4 UNION ALL
SELECT 'M08_JSON_BBOX_MISMATCH', 'warning', 'checked' FROM a WHERE q <> 1 AND t <> 8 AND d = 7 UNION ALL SELECT 'M08_REGION_COUNT_MISMATCH', 'warning', 'checked' FROM a WHERE q <> 1 AND t <> 8 AND n <> n % 4 + 1)
SELECT check_id, severity, status, count(*) AS n FROM x GROUP BY ALL""")
def box_checks(spark, sf):
    """Boxes that are degenerate, out of the image, or other than their mask says."""
    return _found(_context(spark, sf), "M07", "M08")


@query(_LINES + """, m AS (SELECT *, q * 4 AS area, CASE p % 3 WHEN 0 THEN 20.0 WHEN 1 THEN 50.0 ELSE 150.0 END AS floor, 1 - d * 3 / 100.0::DOUBLE AS lat FROM a WHERE q <> 1 AND t <> 8), x AS (
SELECT 'S03_NO_SPACING' AS check_id, 'info' AS severity, 'cannot_determine' AS status FROM m WHERE t = 2 UNION ALL SELECT 'S03_TINY_ANNOTATION', 'warning', 'checked' FROM m WHERE t <> 2 AND area < 20 UNION ALL
SELECT 'S03_SUSPICIOUSLY_SMALL', CASE WHEN area < floor THEN 'warning' ELSE 'info' END, 'checked' FROM m WHERE t <> 2 AND area >= 20 AND area < floor * 3 UNION ALL
SELECT 'S03_STRAY_COMPONENT', 'warning', 'checked' FROM m, (VALUES (3), (1)) v(k) WHERE t <> 2 AND n % 4 + 1 > 1 AND NOT (q * k >= 20 AND q * k / area >= 0.01) UNION ALL
SELECT 'S04_ORIGINAL_FINAL_DIVERGENCE', CASE WHEN d / 5000.0 < 0.001 THEN 'info' ELSE 'warning' END, 'checked' FROM m WHERE d > 0 UNION ALL
SELECT 'S05_REFERENCE_UNAVAILABLE', 'info', 'cannot_determine' FROM m WHERE t = 1 UNION ALL
SELECT 'S05_OUTSIDE_BODY', CASE WHEN lat < 0.8 THEN 'error' WHEN lat < 0.98 AND q * 10 > 100 THEN 'warning' ELSE 'info' END, 'checked' FROM m WHERE t <> 1 AND lat < 1)
SELECT check_id, severity, status, count(*) AS n FROM x GROUP BY ALL""")
def suspicious_checks(spark, sf):
    """Areas by the floor of their family, stray components, divergence, outside the body."""
    return _found(_context(spark, sf), "S03", "S04", "S05")


@query(_LINES + """, b AS (SELECT o, max(n) AS k FROM a GROUP BY 1), p AS (
SELECT o, i AS ia, j AS ib, (i * 7 + j * 3 + o) % 100 / 100.0 AS iou, (i * 31 + j * 17 + o) % 101 / 100.0 AS c, (o + i + j) % 2 = 0 AS same, (o + i) % 3 <> 0 AS latest FROM b, range(1, k + 1) x(i), range(1, k + 1) y(j) WHERE i < j),
k AS (SELECT *, CASE WHEN iou >= 0.99 THEN 'exact' WHEN iou >= 0.95 THEN 'near' WHEN c >= 0.98 THEN 'contained' END AS kind FROM p),
s AS (SELECT *, CASE kind WHEN 'exact' THEN CASE WHEN same THEN 'D01_EXACT_DUPLICATE' ELSE 'D02_EXACT_MASK_LABEL_CONFLICT' END WHEN 'near' THEN CASE WHEN same THEN 'D03_NEAR_DUPLICATE' ELSE 'D03_OVERLAPPING_DIFFERENT_FINDING' END
  ELSE CASE WHEN same THEN 'D04_CONTAINED_DUPLICATE' ELSE 'D04_CONTAINED_DIFFERENT_LABEL' END END AS check_id,
  CASE kind WHEN 'exact' THEN CASE WHEN same AND NOT latest THEN 'info' ELSE 'error' END WHEN 'near' THEN 'warning' ELSE CASE WHEN same THEN 'warning' ELSE 'info' END END AS severity FROM k WHERE kind IS NOT NULL)
SELECT check_id, severity, count(*) AS n FROM s JOIN a ON a.o = s.o AND a.n IN (ia, ib) GROUP BY ALL""")
def duplicate_checks(spark, sf):
    """Pairs of one image by how they overlap and whether their labels agree, an issue a side."""
    ctx = _context(spark, sf)
    k = _lines(spark, sf).groupBy("o").agg(F.max("n").alias("k"))
    p = k.withColumn("i", F.explode(F.sequence(F.lit(1), "k"))).withColumn("j", F.explode(F.sequence(F.lit(1), "k"))).filter("i < j")
    iou, most = (F.col("i") * 7 + F.col("j") * 3 + F.col("o")) % 100 / 100.0, (F.col("i") * 31 + F.col("j") * 17 + F.col("o")) % 101 / 100.0
    uid = lambda c: F.concat_ws("-", "o", c)
    ctx.pairs = p.select(
        F.lit("D").alias("dataset_id"), F.col("o").cast("string").alias("file_uid"), uid("i").alias("uid_a"), uid("j").alias("uid_b"), iou.alias("iou"), most.alias("containment_a_in_b"), F.lit(0.0).alias("containment_b_in_a"),
        (iou >= 0.99).alias("pixel_identical"), ((F.col("o") + F.col("i") + F.col("j")) % 2 == 0).alias("same_label_keys"), ((F.col("o") + F.col("i")) % 3 != 0).alias("both_latest"),
    )
    return checks.run(ctx, only=["D01"]).groupBy("check_id", "severity").agg(F.count("*").alias("n"))


#: What SQL says of each check's policy; issues come from the table.
_POLICY_SQL = """
CASE WHEN check_id IN ('D05_CROSS_DATASET_DUPLICATE_TIE', 'D05_CROSS_DATASET_MISMATCH') THEN 'review' WHEN starts_with(check_id, 'D01') OR starts_with(check_id, 'D05') OR regexp_matches(check_id, '^M0[1-5]_') THEN 'auto'
     WHEN check_id IN ('M07_BBOX_DEGENERATE', 'M07_BBOX_OUT_OF_IMAGE') THEN 'review' WHEN regexp_matches(check_id, '^M0[678]_') THEN 'informational' ELSE 'review' END"""
#: Checks that selectors name: modules, single checks, and one that no check has.
_ONLY, _SKIP = ["m01", "M02_MASK_NOT_8BIT", " m03 ", "M07", "S03", "S05", "X99"], ["M07_SIZE_FIELDS_NULL", "S05"]


@query(_LINES + """, x AS (
SELECT 'M01_MASK_RESOLUTION' AS check_id, CASE WHEN d = 0 THEN 'cannot_determine' ELSE 'checked' END AS status FROM a WHERE p % 5 = 0 UNION ALL SELECT 'M02_MASK_NOT_8BIT', 'checked' FROM a WHERE d = 10 UNION ALL
SELECT 'M02_MASK_NOT_GRAYSCALE', 'checked' FROM a WHERE n = 7 UNION ALL SELECT 'M03_MASK_NOT_BINARY', 'checked' FROM a WHERE t = 3 UNION ALL SELECT 'M07_BBOX_DEGENERATE', 'checked' FROM a WHERE q < 3 UNION ALL
SELECT 'M07_BBOX_OUT_OF_IMAGE', CASE WHEN d = 5 THEN 'cannot_determine' ELSE 'checked' END FROM a WHERE d > 4 UNION ALL SELECT 'M07_SIZE_FIELDS_NULL', 'not_applicable' FROM a WHERE t = 4 UNION ALL
SELECT 'S03_NO_SPACING', 'cannot_determine' FROM a WHERE t = 2 UNION ALL SELECT 'S05_OUTSIDE_BODY', 'checked' FROM a WHERE d > 1)
SELECT check_id, status, policy, status = 'checked' AND policy = 'review' AS asks, count(*) AS n FROM (SELECT *, """ + _POLICY_SQL + """ AS policy FROM x) GROUP BY ALL""")
def check_policies(spark, sf):
    """What the findings of the table's checks lead to, the closest selector deciding, and which of them ask for review."""
    found = _policy_issues(spark, sf)
    names = [r[0] for r in found.select("check_id").distinct().collect()]  # as many as the registry has
    df = found.withColumn("policy", policy.policy_column(F.col("check_id"), names, settings.DEFAULTS["policy"]))
    df = df.withColumn("asks", policy.review_required(F.col("policy"), F.col("status"), settings.DEFAULTS["cannot_determine_as_review_required"]))
    return df.groupBy("check_id", "status", "policy", "asks").agg(F.count("*").alias("n"))


def _policy_issues(spark, sf) -> DataFrame:
    a = _lines(spark, sf)
    n, d, t, p, q = (F.col(c) for c in "ndtpq")
    checked = F.lit("checked")
    found = [
        ("M01_MASK_RESOLUTION", p % 5 == 0, F.when(d == 0, "cannot_determine").otherwise("checked")), ("M02_MASK_NOT_8BIT", d == 10, checked), ("M02_MASK_NOT_GRAYSCALE", n == 7, checked), ("M03_MASK_NOT_BINARY", t == 3, checked),
        ("M07_BBOX_DEGENERATE", q < 3, checked), ("M07_BBOX_OUT_OF_IMAGE", d > 4, F.when(d == 5, "cannot_determine").otherwise("checked")), ("M07_SIZE_FIELDS_NULL", t == 4, F.lit("not_applicable")),
        ("S03_NO_SPACING", t == 2, F.lit("cannot_determine")), ("S05_OUTSIDE_BODY", d > 1, checked),
    ]
    cases = F.array(*[F.when(when, F.struct(F.lit(c).alias("check_id"), status.alias("status"))) for c, when, status in found])
    return a.select(F.explode(F.filter(cases, lambda x: x.isNotNull())).alias("x")).select("x.*")


@query(_LINES + """, x AS (
SELECT 'M01_MASK_RESOLUTION' AS check_id FROM a WHERE p % 5 = 0 UNION ALL SELECT 'M02_MASK_NOT_8BIT' FROM a WHERE d = 10 UNION ALL SELECT 'M02_MASK_NOT_GRAYSCALE' FROM a WHERE n = 7 UNION ALL SELECT 'M03_MASK_NOT_BINARY' FROM a WHERE t = 3 UNION ALL
SELECT 'M07_BBOX_DEGENERATE' FROM a WHERE q < 3 UNION ALL SELECT 'M07_BBOX_OUT_OF_IMAGE' FROM a WHERE d > 4 UNION ALL SELECT 'M07_SIZE_FIELDS_NULL' FROM a WHERE t = 4 UNION ALL SELECT 'S03_NO_SPACING' FROM a WHERE t = 2 UNION ALL SELECT 'S05_OUTSIDE_BODY' FROM a WHERE d > 1)
SELECT check_id, count(*) AS n FROM x WHERE regexp_matches(check_id, '^(M01|M02|M03|S03)_') GROUP BY ALL""")
def check_selection(spark, sf):
    """Findings of the checks that selectors choose, by module or by name, in any case; a selector of one check takes its whole module along as the rules of rank 1 say."""
    found = _policy_issues(spark, sf)
    names = [r[0] for r in found.select("check_id").distinct().collect()]
    return found.filter(F.col("check_id").isin(policy.selected(sorted(names), _ONLY, _SKIP))).groupBy("check_id").agg(F.count("*").alias("n"))


@query("""
WITH f AS (SELECT o_orderkey AS o, bool_or(l_linenumber = 3) AS px, bool_or(l_linenumber = 5) AS bulla, bool_or(l_linenumber = 6) AS effusion, bool_or(l_linenumber = 4) AS nodule, any_value(o_custkey % 2 = 0) AS normal
  FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1),
g AS (SELECT *, coalesce(px OR bulla OR effusion OR nodule, false) AS found FROM f)
SELECT CASE WHEN found THEN 'present' WHEN normal THEN 'absent' ELSE 'unknown' END AS abnormal, coalesce(px, false) AS px_case, CASE WHEN bulla THEN 'present' ELSE 'unknown' END AS bulla,
  CASE WHEN effusion THEN 'present' WHEN normal AND NOT found THEN 'absent' ELSE 'unknown' END AS effusion,
  CASE WHEN px THEN 'explicit_positive_annotation' WHEN normal THEN 'explicit_negative_normal' ELSE 'unconfirmed' END AS evidence, count(*) AS n FROM g GROUP BY ALL""")
def case_label_rules(spark, sf):
    """Labels of images by their annotations and their case; absence of annotations is no evidence."""
    name = F.when(F.col("l_linenumber") == 3, "pneumothorax").when(F.col("l_linenumber") == 5, "bulla_bleb").when(F.col("l_linenumber") == 6, "pleural_effusion").when(F.col("l_linenumber") == 4, "nodule")
    label = lambda system, c: F.struct(F.lit(system).alias("code_system"), c.alias("code_text_eng"))
    found = _t(spark, sf, "lineitem").select("l_orderkey", name.alias("name")).filter("name is not null").groupBy("l_orderkey").agg(F.collect_set(label("Findings", F.col("name"))).alias("ann_labels"))
    images = _t(spark, sf, "orders").join(found, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    images = images.withColumn("case_labels", F.when(F.col("o_custkey") % 2 == 0, F.array(label("No Findings", F.lit("normal")))))
    made = samples.case_labels()
    names = {"abnormal_finding_status": "abnormal", "pneumothorax_case": "px_case", "bulla_bleb_status": "bulla", "pleural_effusion_status": "effusion", "case_evidence": "evidence"}
    return images.select(*[made[k].alias(v) for k, v in names.items()]).groupBy(*names.values()).agg(F.count("*").alias("n"))


@query(_LINES + """, r AS (SELECT o, n, s % 6 AS x0, p % 6 AS y0, 1 + n % 3 AS w, CAST(1 + q % 3 AS BIGINT) AS h FROM a WHERE n <= 2),
j AS (SELECT a.o, a.x0 AS ax, a.y0 AS ay, a.w AS aw, a.h AS ah, b.x0 AS bx, b.y0 AS b_y, b.w AS bw, b.h AS bh,
  greatest(0, least(a.x0 + a.w, b.x0 + b.w) - greatest(a.x0, b.x0)) * greatest(0, least(a.y0 + a.h, b.y0 + b.h) - greatest(a.y0, b.y0)) AS i FROM r a JOIN r b ON a.o = b.o AND a.n = 1 AND b.n = 2)
SELECT o, (aw * ah)::BIGINT AS fg, ax::BIGINT AS min_x, (ay + ah - 1)::BIGINT AS max_y, 1::BIGINT AS components, i::DOUBLE / (aw * ah + bw * bh - i) AS iou, i::DOUBLE / (aw * ah) AS inside, ax = bx AND ay = b_y AND aw = bw AND ah = bh AS same,
  (aw * ah + bw * bh - i)::BIGINT AS merged, (aw * ah)::BIGINT AS filled, (aw * ah)::BIGINT AS rows_filled, greatest(aw * ah, 0)::BIGINT AS largest, greatest(0, least(ax, bx) - 1)::BIGINT AS crop_x, least(7, greatest(ax + aw - 1, bx + bw - 1) + 1)::BIGINT AS crop_x1,
  aw * ah * 0.5 AS mm2, (aw * ah + bw * bh - 2 * i)::BIGINT AS difference, true AS png FROM j""")
def rect_masks(spark, sf):
    """G1, G2, G3, G4, G5, G6, G7, G8, G10, G13, G15, U7, SC16, SK12, A25: rectangles as masks, measured, compared, merged and filled."""
    r = _lines(spark, sf).filter("n <= 2").select("o", "n", F.array((F.col("s") % 6).cast("long"), (F.col("p") % 6).cast("long"), (1 + F.col("n") % 3).cast("long"), (1 + F.col("q") % 3).cast("long")).alias("r"))
    pairs = r.filter("n = 1").select("o", F.col("r").alias("a")).join(r.filter("n = 2").select("o", F.col("r").alias("b")), "o")

    def measured(frames):
        import numpy as np

        def mask(v):
            m = np.zeros((8, 8), dtype=bool)
            m[v[1] : v[1] + v[3], v[0] : v[0] + v[2]] = True
            return m

        def outline(m):
            inner = m.copy()
            inner[1:-1, 1:-1] &= m[:-2, 1:-1] & m[2:, 1:-1] & m[1:-1, :-2] & m[1:-1, 2:]
            inner[[0, -1], :], inner[:, [0, -1]] = False, False
            return m & ~inner

        def row(o, va, vb):
            a, b = mask(va), mask(vb)
            stats = raster.mask_stats(a)
            boxes = [(v[0], v[1], v[0] + v[2] - 1, v[1] + v[3] - 1) for v in (va, vb)]
            crop = raster.crop_box(boxes, 1, 8, 8)
            image = (a * 255).astype(np.uint8)
            change = raster.original_difference(outline(a), b)
            return (
                o, int(stats["fg_pixels"]), int(stats["bbox"][0]), int(stats["bbox"][3]), int(stats["n_components"]), raster.iou(a, b), raster.containment(a, b), raster.mask_hash(a) == raster.mask_hash(b),
                int(raster.merge_masks([a, b]).sum()), int(raster.filled(outline(a)).sum()), int(raster.row_filled(outline(a)).sum()), int(raster.largest_component(a).sum()), int(crop[0]), int(crop[2]), raster.pixels_to_mm2(int(a.sum()), 1.0, 0.5),
                int(change["difference_pixels"]), bool((raster.binarized(raster.read_png(raster.write_png(image))) == a).all()),
            )

        for f in frames:
            yield pd.DataFrame([row(o, a, b) for o, a, b in zip(f["o"], f["a"], f["b"], strict=True)], columns=names)

    ddl = "o long, fg long, min_x long, max_y long, components long, iou double, inside double, same boolean, merged long, filled long, rows_filled long, largest long, crop_x long, crop_x1 long, mm2 double, difference long, png boolean"
    names = [c.split(" ")[0] for c in ddl.split(", ")]
    return pairs.mapInPandas(measured, ddl)


@query("""
WITH i AS (SELECT o_orderkey AS uid, CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'keep' END AS status, CASE WHEN o_orderpriority LIKE '1%' THEN 'M01|S03' WHEN o_orderpriority LIKE '2%' THEN 'S03' ELSE 'none' END AS detected, CASE WHEN o_custkey % 5 = 0 THEN 'S05' ELSE 'none' END AS unverified FROM orders),
l AS (SELECT DISTINCT l_orderkey AS uid FROM lineitem WHERE l_quantity > 48)
SELECT 'unverified' AS what, count(*) AS n FROM i WHERE unverified <> 'none' UNION ALL SELECT 'searched', count(*) FROM i WHERE status = 'pending' AND detected IN ('M01|S03', 'S03') AND contains(uid::VARCHAR, '7') UNION ALL
SELECT 'targets', count(*) FROM i WHERE status = 'pending' OR uid IN (SELECT uid FROM l) UNION ALL SELECT 'cases', count(*) FROM i WHERE uid IN (SELECT uid FROM l) UNION ALL
SELECT 'page', count(*) FROM (SELECT uid FROM i ORDER BY uid LIMIT 120 OFFSET 240)""")
def review_filters(spark, sf):
    """What a reviewer looks at: open rows, searches, images with pending annotations, a page of them."""
    p = F.col("o_orderpriority")
    i = _t(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("uid"), "o_orderkey", F.when(F.col("o_orderstatus") == "P", "pending").otherwise("keep").alias("status"),
        F.when(p.startswith("1"), "M01|S03").when(p.startswith("2"), "S03").otherwise("none").alias("detected_checks"), F.when(F.col("o_custkey") % 5 == 0, "S05").otherwise("none").alias("unverified_checks"),
    )
    line = _t(spark, sf, "lineitem").filter("l_quantity > 48").select(F.col("l_orderkey").cast("string").alias("uid")).distinct()
    parts = {
        "unverified": review.unverified(i), "searched": review.searched(i, {"status": "pending"}, "7", ["uid"], "S03"), "targets": review.review_targets(i, i.filter("status = 'pending'"), line, "uid"),
        "cases": review.cases_with(i, line, "uid"), "page": reports.page(i, [F.col("o_orderkey")], 2),
    }
    out = None
    for what, df in parts.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "n")
        out = one if out is None else out.union(one)
    return out


@query("""
WITH e AS (SELECT event_id, event_id % 200000 AS s, CASE event_id % 4 WHEN 0 THEN 'older_duplicate|review_required|invalid_duplicate' WHEN 1 THEN 'review_required' ELSE NULL END AS field, CASE event_id % 3 WHEN 0 THEN ['reason:lateral_view', 'x'] ELSE [] END AS tags FROM events)
SELECT event_id, CASE WHEN s >= 86400 THEN (s // 86400) || ' days' WHEN s >= 3600 THEN (s // 3600) || ' hours' WHEN s >= 60 THEN (s // 60) || ' minutes' ELSE s || ' seconds' END AS elapsed,
  CASE WHEN event_id % 4 = 0 THEN 'invalid_duplicate|older_duplicate' WHEN event_id % 3 = 0 THEN 'lateral_view' ELSE 'none' END AS reasons,
  (event_id % 24 * 3600 + event_id % 60 * 60 + event_id % 60)::DOUBLE AS clock, CASE WHEN s % 400 < 50 THEN -0.5 WHEN s % 400 > 350 THEN 1.5 ELSE (s % 400 - 150) / 100.0::DOUBLE END AS box_x, CASE WHEN event_id % 2 = 0 THEN 0.08 ELSE 0.2 END::DOUBLE AS box_w,
  CASE WHEN s % 400 < 50 OR s % 400 > 350 THEN 'out_of_image_clamped_for_display' WHEN event_id % 2 = 0 THEN 'degenerate_widened_for_display' END AS box_reason FROM e""")
def review_texts(spark, sf):
    """Reasons in the vocabulary's order, elapsed times, clock times and display boxes."""
    i = F.col("event_id")
    s = i % 200000
    field = F.when(i % 4 == 0, "older_duplicate|review_required|invalid_duplicate").when(i % 4 == 1, "review_required")
    tags = F.when(i % 3 == 0, F.array(F.lit("reason:lateral_view"), F.lit("x"))).otherwise(F.array().cast("array<string>"))
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    x = s % 400 - 150
    box = review.display_box(x, F.lit(0), x + i % 2 * 20, F.lit(50), F.lit(100), F.lit(100))
    return _t(spark, sf, "events").select(
        "event_id", review.elapsed_text(s).alias("elapsed"), review.effective_reasons(field, tags, F.lit(None).cast("string")).alias("reasons"),
        review.clock_seconds(F.lit("bad"), F.concat(two(i % 24), two(i % 60), two(i % 60))).alias("clock"), box["x"].alias("box_x"), box["w"].alias("box_w"), box["reason"].alias("box_reason"),
    )


@query("SELECT event_type AS value, (row_number() OVER (ORDER BY min(event_id), event_type) - 1)::BIGINT AS code FROM events GROUP BY 1")
def vocabulary_codes(spark, sf):
    """Dictionary codes by first appearance."""
    return review.dictionary_codes(_t(spark, sf, "events"), "event_type", ["event_id"])


@query("SELECT 'engineer-set-' || n_name || '-20260102_030405.json' AS source, n_name AS dataset, n_name || '::a/' || n_nationkey AS stable, n_name || '::' || lower(n_name) AS annotation, substr(lower(n_name), 1, 8) AS short, 2026 AS year FROM nation")
def identities(spark, sf):
    """Identities of datasets, images and annotations, and export stamps, by names."""
    name = F.col("n_name")
    source = F.concat(F.lit("engineer-set-"), name, F.lit("-20260102_030405.json"))
    uid = ids.annotation_uid(name, F.lower(name))
    return _t(spark, sf, "nation").select(
        source.alias("source"), ids.dataset_of(source).alias("dataset"), ids.stable_file_uid(ids.dataset_of(source), F.lit("a"), F.col("n_nationkey").cast("string")).alias("stable"), uid.alias("annotation"),
        ids.short_uid(uid).alias("short"), F.year(ids.export_stamp(source)).alias("year"),
    )


@query("""
SELECT p_partkey, CASE WHEN p_retailprice = 0 THEN 0.0 WHEN p_retailprice >= 1000 THEN round_even(p_retailprice, 0) WHEN p_retailprice >= 100 THEN round_even(p_retailprice, 1) ELSE round_even(p_retailprice, 2) END::DOUBLE AS price,
  p_partkey % 4 <> 0 AND p_size % 2 = 0 AS has_spacing FROM part""")
def rounded_values(spark, sf):
    """Four significant digits, and spacings that are known and positive."""
    x = F.when(F.col("p_partkey") % 4 != 0, 0.5)
    space = samples.spacing(samples.effective_spacing(F.lit(None).cast("double"), x), F.when(F.col("p_size") % 2 == 0, 0.5).otherwise(0.0))
    return _t(spark, sf, "part").select("p_partkey", rollups.significant(F.col("p_retailprice").cast("double")).alias("price"), space.isNotNull().alias("has_spacing"))


@query("""
SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderpriority END, '') AS priority, o_custkey FROM orders WHERE o_custkey % 3 = 0""")
def table_round_trip(spark, sf):
    """SK3, SK4, SK9, SC11, SC18, SK1, SC10: a table with blanks for nulls is written as CSV and read again; a cache keeps rows of whole files."""
    o = _t(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("priority"), "o_custkey")
    path = scratch_path(spark, "table")
    artifacts.write_table(o, path, ["o_orderkey"])
    read = artifacts.read_csv(spark, path).select(F.col("o_orderkey").cast("long").alias("o_orderkey"), F.coalesce("priority", F.lit("")).alias("priority"), F.col("o_custkey").cast("long").alias("o_custkey"))
    cache = scratch_path(spark, "cache")
    read.select(F.col("o_orderkey").cast("string").alias("file_uid"), "priority", "o_custkey").write.json(cache)
    whole = o.filter("o_custkey % 3 = 0").select(F.col("o_orderkey").cast("string").alias("file_uid"))
    kept = artifacts.read_cache(spark, cache, "file_uid string, priority string, o_custkey long", whole)
    return kept.select(F.col("file_uid").cast("long").alias("o_orderkey"), F.coalesce("priority", F.lit("")).alias("priority"), "o_custkey")


@query(_LINES + """, d AS (SELECT a.*, CASE WHEN q > 40 THEN 'keep' WHEN q > 30 THEN 'exclude' WHEN q > 20 THEN 'pending' ELSE 'uncertain' END AS decision FROM a)
SELECT (SELECT count(*) FROM d WHERE decision IN ('keep', 'uncertain'))::BIGINT AS built, (SELECT count(*) FROM d WHERE decision = 'pending' AND p % 2 = 0)::BIGINT AS late_reviews,
  (SELECT count(DISTINCT o) FROM a WHERE q > 10 AND o NOT IN (SELECT o FROM a WHERE q > 45))::BIGINT AS missing, (SELECT count(*) FROM a WHERE d > 5 AND t IS NOT NULL)::BIGINT AS mismatches""")
def build_rules(spark, sf):
    """What a build takes, verdicts that break their contract, files that are missing, values that differ."""
    a = _lines(spark, sf)
    q = F.col("q")
    d = a.withColumn("decision", F.when(q > 40, "keep").when(q > 30, "exclude").when(q > 20, "pending").otherwise("uncertain"))
    d = d.withColumn("review_status", F.when((F.col("decision") == "pending") & (F.col("p") % 2 == 0), "not_needed").otherwise("pending")).withColumn("source", F.lit("default")).withColumn("reviewer", F.lit(None).cast("string"))
    d = d.withColumn("reason", F.lit("x")).withColumn("unverified_checks", F.lit("none"))
    one = lambda df, name: df.agg(F.count("*").alias(name))
    broken = contracts.violations(d.filter("decision = 'pending'"), contracts.decision_rules(), ["o", "n"]).filter("rule = 'not_needed_is_final'")
    missing = merges.missing_from(a.filter("q > 10").select("o").distinct(), a.filter("q > 45").select("o"), ["o"])
    key = a.select(F.concat_ws("-", "o", "n").alias("k"), F.col("d").alias("v"))
    other = key.withColumn("v", F.when(F.col("v") > 5, F.col("v") + 1).otherwise(F.col("v")))
    out = one(ladders.kept_rows(d, "decision", "exclude", "keep"), "built")
    for df in (one(broken, "late_reviews"), one(missing, "missing"), one(contracts.mismatches(key, other, "k", ["v"]), "mismatches")):
        out = out.crossJoin(df)  # one row each
    return out


@query("""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e, array_to_string(list_transform(embedding[1:8], lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS block FROM embeddings),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.block = b.block AND a.vec_id < b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.25),
n AS (SELECT a AS x, b AS y FROM p UNION SELECT b, a FROM p),
o AS (SELECT x, row_number() OVER (ORDER BY coalesce(min(CASE WHEN y < x THEN y END), x), bool_or(y < x), x) AS i FROM n GROUP BY 1),
nb AS (SELECT i, x, list(y) AS ys FROM n JOIN o USING (x) GROUP BY 1, 2)""".replace("WITH v", "WITH RECURSIVE v") + """,
w AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS seen, []::BIGINT[] AS centers UNION ALL
  SELECT w.i + 1, CASE WHEN list_contains(seen, x) THEN seen ELSE list_concat(seen, list_append(ys, x)) END, CASE WHEN list_contains(seen, x) THEN centers ELSE list_append(centers, x) END FROM w JOIN nb ON nb.i = w.i + 1),
c AS (SELECT unnest(centers) AS center FROM (SELECT centers FROM w ORDER BY i DESC LIMIT 1))
SELECT center, center AS node FROM c UNION ALL SELECT center, y FROM c JOIN n ON x = center""")
def near_image_clusters(spark, sf):
    """Near pairs of a block, clustered around centers that come up in order, not transitively."""
    from adjudica.operators.components import star_clusters
    from adjudica.plans.queries import near_dup_blocked

    return star_clusters(near_dup_blocked(spark, sf))
