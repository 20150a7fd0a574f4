"""Enrichment, samples, reports, stores and adapters as queries over the driver's tables, each with its SQL.

An order is an image, its customer the patient, a nation the institution; statuses and reports are made of their numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.functions import samples
from adjudica.operators import build, contracts, distribution, enrichment, export, ladders, merges, review, rollups
from adjudica.plans.queries import _t, query
from adjudica.sources import adapters, artifacts
from adjudica.storage import scratch_path


def _pick(n: Column, *values: str | None) -> Column:
    out = F.lit(values[-1]).cast("string")
    for i in reversed(range(len(values) - 1)):
        out = F.when(n % len(values) == i, F.lit(values[i]).cast("string")).otherwise(out)
    return out


def _pick_sql(n: str, *values: str | None) -> str:
    return f"CASE ({n}) % {len(values)} " + " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'") for i, v in enumerate(values)) + " END"


_SIDES, _THREE = ("left", "right", None), ("present", "absent", "unknown")
_K = {"c": "o_custkey", "d": "o_orderkey", "e": "o_orderkey // 7", "f": "o_custkey // 3", "g": "o_orderkey // 5", "h": "o_custkey // 11"}


def _number(name: str) -> Column:
    column, _, by = _K[name].partition(" // ")
    return F.floor(F.col(column) / int(by)).cast("long") if by else F.col(column)


def _reported(spark, sf) -> DataFrame:
    case = _number("c") % 4 == 0
    report = F.struct(
        F.lit(2).alias("schema_version"), _pick(_number("d"), *_THREE).alias("pneumothorax_status"), F.when(_number("g") % 4 != 0, _pick(_number("g"), *_SIDES)).alias("pneumothorax_side"),
        _pick(_number("h"), *_THREE).alias("bulla_bleb_status"), _pick(_number("f") + _number("d"), *_THREE).alias("pleural_effusion_status"),
        _pick(_number("e"), "text", "no_report", None, "text2").alias("pneumothorax_evidence"), (_number("g") % 3).cast("int").alias("observed_finding_count"),
    )
    return _t(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", case.alias("pneumothorax_case"), F.when(case, "explicit_positive_annotation").when(_number("c") % 4 == 1, "explicit_negative_normal").otherwise("unconfirmed").alias("case_evidence"),
        F.when(case, _pick(_number("e"), *_SIDES)).alias("pneumothorax_side"), _pick(_number("e"), *_THREE).alias("bulla_bleb_status"), _pick(_number("f"), *_THREE).alias("pleural_effusion_status"),
        F.when(_number("g") % 5 != 0, report).alias("report"),
    )


_REPORTED = f"""
WITH b AS (SELECT o_custkey % 4 = 0 AS pcase, CASE o_custkey % 4 WHEN 0 THEN 'explicit_positive_annotation' WHEN 1 THEN 'explicit_negative_normal' ELSE 'unconfirmed' END AS ev,
  CASE WHEN o_custkey % 4 = 0 THEN {_pick_sql(_K["e"], *_SIDES)} END AS side, {_pick_sql(_K["e"], *_THREE)} AS bulla, {_pick_sql(_K["f"], *_THREE)} AS eff, ({_K["g"]}) % 5 <> 0 AS there,
  {_pick_sql(_K["d"], *_THREE)} AS rs, CASE WHEN ({_K["g"]}) % 4 <> 0 THEN {_pick_sql(_K["g"], *_SIDES)} END AS rside, {_pick_sql(_K["h"], *_THREE)} AS rbulla, {_pick_sql("(" + _K["f"] + ") + " + _K["d"], *_THREE)} AS reff,
  {_pick_sql(_K["e"], "text", "no_report", None, "text2")} AS rev, ({_K["g"]}) % 3 AS n FROM orders),
c AS (SELECT *, there AND ev = 'unconfirmed' AND rs = 'present' AS up, there AND ev = 'unconfirmed' AND rs = 'absent' AND coalesce(rev <> 'no_report', false) AND n = 0 AS conf FROM b),
x AS (SELECT pcase OR up AS ncase, CASE WHEN up THEN 'report_positive' WHEN conf THEN 'explicit_negative_report' ELSE ev END AS nev,
  CASE WHEN there AND (pcase OR up) AND side IS NULL THEN rside ELSE side END AS nside, CASE WHEN there AND bulla = 'unknown' THEN rbulla ELSE bulla END AS nbulla, CASE WHEN there AND eff = 'unknown' THEN reff ELSE eff END AS neff,
  CAST(up AS INT) + CAST(conf AS INT) + CAST(there AND (pcase OR up) AND side IS NULL AND rside IS NOT NULL AS INT) + CAST(there AND bulla = 'unknown' AND rbulla <> 'unknown' AS INT) + CAST(there AND eff = 'unknown' AND reff <> 'unknown' AS INT) AS changes,
  CAST(there AND pcase AND rs = 'absent' AS INT) + CAST(there AND ev = 'explicit_negative_normal' AND rs = 'present' AS INT) + CAST(coalesce(there AND (pcase OR up) AND side <> rside, false) AS INT)
  + CAST(there AND bulla <> 'unknown' AND rbulla <> 'unknown' AND bulla <> rbulla AS INT) + CAST(there AND eff <> 'unknown' AND reff <> 'unknown' AND eff <> reff AS INT) AS conflicts,
  CAST(there AND ev = 'explicit_negative_normal' AND rs = 'present' AS INT) + CAST(there AND eff = 'absent' AND reff = 'present' AS INT) AS wins FROM c)"""


@query(_REPORTED + "SELECT ncase AS pneumothorax_case, nev AS case_evidence, nside AS side, nbulla AS bulla, neff AS effusion, changes, conflicts, wins, count(*) AS n FROM x GROUP BY ALL")
def report_enrichment(spark, sf):
    """Labels enriched by reports; what annotations confirm is never weakened."""
    out = enrichment.with_report(_reported(spark, sf))
    wins = F.size(F.filter("conflicts", lambda x: x["reason"] == "explicit_negative_wins"))
    out = out.select("pneumothorax_case", "case_evidence", F.col("pneumothorax_side").alias("side"), F.col("bulla_bleb_status").alias("bulla"), F.col("pleural_effusion_status").alias("effusion"), F.size("changes").alias("changes"), F.size("conflicts").alias("conflicts"), wins.alias("wins"))
    return out.groupBy(*out.columns).agg(F.count("*").alias("n"))


@query(f"""
WITH p AS (SELECT c_custkey AS id, c_custkey % 5 = 0 AS pcase, CASE WHEN c_custkey % 5 = 0 THEN {_pick_sql("c_custkey // 5", *_SIDES)} END AS side, {_pick_sql("c_custkey // 2", *_THREE)} AS bulla, {_pick_sql("c_custkey // 3", *_THREE)} AS eff, c_nationkey AS pix FROM customer WHERE c_acctbal >= 0),
s AS (SELECT c_custkey AS id, c_custkey % 3 = 0 AS pcase, CASE WHEN c_custkey % 2 = 0 THEN 'left' END AS side, {_pick_sql("c_custkey // 7", *_THREE)} AS bulla, {_pick_sql("c_custkey // 4", *_THREE)} AS eff, c_nationkey + 100 AS pix FROM customer WHERE c_acctbal < 5000),
j AS (SELECT p.id IS NOT NULL AS hp, s.id IS NOT NULL AS hs, coalesce(p.id, s.id) % 7 = 0 AS safe, p.pcase AS pc, s.pcase AS sc, p.side AS pside, s.side AS sside, p.bulla AS pb, s.bulla AS sb, p.eff AS pe, s.eff AS se, p.pix AS pp, s.pix AS sp FROM p FULL JOIN s ON p.id = s.id),
k AS (SELECT *, hp AND hs AS both_, hp AND hs AND NOT pc AND sc AND NOT safe AS up FROM j)
SELECT CASE WHEN both_ THEN 'both' WHEN hp THEN 'primary' ELSE 'secondary' END AS origin, CASE WHEN hp THEN pc OR up ELSE sc END AS pcase, CASE WHEN NOT hp THEN sside WHEN both_ AND (pc OR up) AND pside IS NULL THEN sside ELSE pside END AS side,
  CASE WHEN NOT hp THEN sb WHEN both_ AND pb = 'unknown' THEN sb ELSE pb END AS bulla, CASE WHEN NOT hp THEN se WHEN both_ AND pe = 'unknown' THEN se ELSE pe END AS effusion,
  CASE WHEN hp THEN 'p' ELSE 's' END AS pixels_of, CAST(up AS INT) + CAST(both_ AND (pc OR up) AND pside IS NULL AND sside IS NOT NULL AS INT) + CAST(both_ AND pb = 'unknown' AND sb <> 'unknown' AS INT) + CAST(both_ AND pe = 'unknown' AND se <> 'unknown' AS INT) AS changes,
  coalesce(CAST(both_ AND NOT pc AND sc AND safe AS INT), 0) + coalesce(CAST(both_ AND pc AND NOT sc AS INT), 0) + coalesce(CAST(both_ AND (pc OR up) AND pside <> sside AS INT), 0)
  + coalesce(CAST(both_ AND pb <> 'unknown' AND sb <> 'unknown' AND pb <> sb AS INT), 0) + coalesce(CAST(both_ AND pe <> 'unknown' AND se <> 'unknown' AND pe <> se AS INT), 0) AS conflicts, count(*) AS n
FROM k GROUP BY ALL""".replace("CAST(up AS INT) + CAST(both_", "coalesce(CAST(up AS INT), 0) + CAST(both_"))
def sample_enrichment(spark, sf):
    """Two sample sets merged whole; the primary wins, protected negatives stay, pixels are the primary's."""
    c = _t(spark, sf, "customer")
    by = lambda n: F.floor(F.col("c_custkey") / n).cast("long")
    rest = lambda a, b: [_pick(by(a), *_THREE).alias("bulla_bleb_status"), _pick(by(b), *_THREE).alias("pleural_effusion_status")]
    case = F.col("c_custkey") % 5 == 0
    key = F.col("c_custkey").alias("sample_id")
    p = c.filter("c_acctbal >= 0").select(key, case.alias("pneumothorax_case"), F.when(case, _pick(by(5), *_SIDES)).alias("pneumothorax_side"), *rest(2, 3), F.col("c_nationkey").alias("pneumothorax_area_pix2"))
    s = c.filter("c_acctbal < 5000").select(key, (F.col("c_custkey") % 3 == 0).alias("pneumothorax_case"), F.when(F.col("c_custkey") % 2 == 0, "left").alias("pneumothorax_side"), *rest(7, 4), (F.col("c_nationkey") + 100).alias("pneumothorax_area_pix2"))
    m = enrichment.merged_samples(p, s, c.filter("c_custkey % 7 = 0").select(key))
    out = m.select(
        "origin", F.col("pneumothorax_case").alias("pcase"), F.col("pneumothorax_side").alias("side"), F.col("bulla_bleb_status").alias("bulla"), F.col("pleural_effusion_status").alias("effusion"),
        F.when(F.col("pneumothorax_area_pix2") < 100, "p").otherwise("s").alias("pixels_of"), F.size("changes").alias("changes"), F.size("conflicts").alias("conflicts"),
    )
    return out.groupBy(*out.columns).agg(F.count("*").alias("n"))


def _images(spark, sf) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    label = lambda system, name: F.struct(F.lit(system).alias("code_system"), name.cast("string").alias("code_text_eng"))
    box = lambda by: F.struct(*[(k % by + i).cast("int").alias(n) for i, n in enumerate(("min_x", "min_y", "max_x", "max_y"))])
    return _t(spark, sf, "orders").select(
        k.cast("string").alias("file"), F.concat_ws("/", F.lit("/data/in"), F.col("o_orderstatus"), k.cast("string")).alias("image_path"), F.when(c % 3 != 0, c.cast("string")).otherwise("").alias("patient_id"),
        F.concat(F.lit("/data/out/"), k.cast("string"), F.lit(".png")).alias("image_file"), (c % 4 - 1).cast("double").alias("spacing_x"), (k % 3).cast("double").alias("spacing_y"), F.when(k % 2 == 0, 100).alias("shape_w"), F.lit(200).alias("shape_h"),
        F.col("o_orderpriority").alias("institution"), F.when(c % 2 == 0, F.col("o_orderstatus")).otherwise("").alias("manufacturer"), F.concat(F.lit("set_"), _pick(c, "pneumothorax", "non_pneumothorax", "other")).alias("dataset_id"),
        F.array(label("Other", F.lit("x")), label("CRSeriesTypes", F.when(k % 4 == 0, "").when(k % 4 == 1, "PA")), label("CRSeriesTypes", F.lit("AP")), label("Notes", F.when(k % 5 == 0, "normal"))).alias("case_labels"),
        F.when(c % 5 == 0, F.array(label("Findings", F.lit("pneumothorax")))).when(c % 5 == 1, F.array(label("No Findings", F.lit("normal")))).otherwise(F.array(label("Notes", F.lit("normal")))).alias("ann_labels"),
        F.when(k % 3 == 0, F.concat(F.lit("/data/out/m/"), k.cast("string"))).alias("mask_path"), F.when(k % 2 == 0, box(50)).alias("lung_box"), F.when(c % 2 == 0, box(60)).alias("thorax_box"),
    )


def _samples(spark, sf) -> DataFrame:
    return samples.samples(samples.labelled(_images(spark, sf)), "/data/out")


_SAMPLES_SQL = """
WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, * FROM orders), x AS (SELECT k, c, k::VARCHAR AS sample_id, CASE WHEN c % 3 <> 0 THEN c::VARCHAR END AS patient_id, '/data/in/' || o_orderstatus || '/' || k AS dicom_file, k || '.png' AS image_file,
  CASE WHEN c % 4 - 1 > 0 AND k % 3 > 0 THEN (c % 4 - 1)::DOUBLE END AS sx, CASE WHEN k % 2 = 0 THEN 100 END AS w, o_orderpriority AS facility_id, CASE WHEN c % 2 = 0 THEN o_orderstatus END AS vendor_id, CASE WHEN k % 4 = 1 THEN 'PA' ELSE 'AP' END AS view_position,
  c % 5 = 0 AS pneumothorax_case, CASE c % 5 WHEN 0 THEN 'present' WHEN 1 THEN 'absent' ELSE 'unknown' END AS abnormal_finding_status, CASE c % 5 WHEN 1 THEN 'absent' ELSE 'unknown' END AS pleural_effusion_status,
  CASE WHEN k % 3 = 0 THEN 'm/' || k END AS mask, CASE WHEN k % 2 = 0 AND c % 2 = 0 THEN least(k % 50, k % 60) END AS x_min, CASE WHEN k % 2 = 0 AND c % 2 = 0 THEN greatest(k % 50, k % 60) + 4 END AS y_max FROM o)"""


@query(_SAMPLES_SQL + "SELECT sample_id, patient_id, dicom_file, image_file, sx, w, facility_id, vendor_id, view_position, pneumothorax_case, abnormal_finding_status, pleural_effusion_status, mask, x_min, y_max FROM x")
def sample_fields(spark, sf):
    """The 19 fields of a sample, nested ones by a part of them."""
    return _samples(spark, sf).select(
        "sample_id", "patient_id", "dicom_file", "image_file", F.col("pixel_spacing.x").alias("sx"), F.col("image_shape.width").alias("w"), "facility_id", "vendor_id", "view_position", "pneumothorax_case", "abnormal_finding_status",
        "pleural_effusion_status", F.col("pneumothorax_mask.pixel_array").alias("mask"), F.col("lung_rect.x_min").alias("x_min"), F.col("lung_rect.y_max").alias("y_max"),
    )


@query(_SAMPLES_SQL + """, e AS (SELECT *, CASE c % 5 WHEN 0 THEN 'explicit_positive_annotation' WHEN 1 THEN 'explicit_negative_normal' ELSE 'unconfirmed' END AS ev FROM x)
SELECT 'status' AS counter, abnormal_finding_status AS value, count(*) AS n FROM e GROUP BY 2 UNION ALL SELECT 'status_case', abnormal_finding_status || '/' || pneumothorax_case, count(*) FROM e GROUP BY 2 UNION ALL SELECT 'evidence', ev, count(*) FROM e GROUP BY 2 UNION ALL
SELECT * FROM (SELECT 'null', unnest(['patient_id', 'pixel_spacing', 'image_shape', 'vendor_id', 'pneumothorax_mask', 'lung_mask', 'pneumothorax_side', 'lung_rect']), unnest([count(*) FILTER (patient_id IS NULL), count(*) FILTER (sx IS NULL), count(*) FILTER (w IS NULL), count(*) FILTER (vendor_id IS NULL), count(*) FILTER (mask IS NULL), count(*), count(*), count(*) FILTER (x_min IS NULL)]) FROM e) UNION ALL
SELECT 'unlisted', 'Notes/normal', count(*) FROM e WHERE k % 5 = 0 OR c % 5 > 1 UNION ALL SELECT 'named', 'set_pneumothorax', count(*) FROM e WHERE c % 3 = 0 AND c % 5 <> 0""")
def export_counters(spark, sf):
    """Statuses, evidence, empty fields, normal labels that are no evidence, and datasets named after what they lack."""
    images = samples.labelled(_images(spark, sf))
    rows = samples.samples(images, "/data/out")
    fields = ["patient_id", "pixel_spacing", "image_shape", "vendor_id", "pneumothorax_mask", "lung_mask", "pneumothorax_side", "lung_rect"]
    counted = export.counters(rows.join(images.select(F.col("file").alias("sample_id"), "case_evidence"), "sample_id"), fields=fields)
    unlisted = export.unlisted_normals(images, [["No Findings", "normal"]]).select(F.lit("unlisted").alias("counter"), F.col("label").alias("value"), F.col("images").alias("n"))
    return counted.union(unlisted).union(export.named_without_cases(images).select(F.lit("named"), "dataset_id", "n"))


@query(_SAMPLES_SQL + "SELECT sample_id, patient_id, w, pneumothorax_case, abnormal_finding_status, mask FROM x")
def dataset_round_trip(spark, sf):
    """SK7, SC13: samples written as one JSON document in parts by key, and read again line by line."""
    path = scratch_path(spark, "dataset")
    export.write_dataset(_samples(spark, sf), {"content_type": "dataset"}, path)
    ddl = "patient_id STRING, image_shape STRUCT<width: INT>, pneumothorax_case BOOLEAN, abnormal_finding_status STRING, pneumothorax_mask STRUCT<pixel_array: STRING>"
    got = artifacts.read_sample_lines(spark, path, ddl)
    return got.select("sample_id", "patient_id", F.col("image_shape.width").alias("w"), "pneumothorax_case", "abnormal_finding_status", F.col("pneumothorax_mask.pixel_array").alias("mask"))


@query("""WITH y AS (SELECT o_orderkey, (o_orderkey // 5) % 5 <> 0 AS there, """ + _pick_sql("o_orderkey", *_THREE) + """ AS rs FROM orders)
SELECT rs IN ('present', 'absent') AS in_scope, rs AS pneumothorax_status, rs <> 'unknown' AS has_case, CAST(sum(o_orderkey) AS BIGINT) AS keys, count(*) AS n FROM y WHERE there GROUP BY ALL""")
def report_rows(spark, sf):
    """A row for each report, labels of those out of scope null."""
    base = _reported(spark, sf).withColumns({"sample_id": F.col("o_orderkey"), "study": F.col("o_custkey").cast("string"), "abnormal_finding_status": F.lit("unknown")})
    empty = {c: F.lit(None).cast("string") for c in (*export.REPORT_COLUMNS, "study_name", "source_dataset_id", "source_json")}
    given = ["pneumothorax_status", "pleural_effusion_status", "pneumothorax_evidence", "observed_finding_count"]
    full = F.struct(*[F.col(f"report.{c}").alias(c) for c in given], *[v.alias(c) for c, v in empty.items() if c not in given])
    images = base.withColumn("report", F.when(F.col("report").isNotNull(), full))
    rows = export.report_rows(images, base, samples.report_in_scope(F.col("report"), ["present", "absent"]))
    return rows.groupBy("in_scope", "pneumothorax_status", F.col("pneumothorax_case").isNotNull().alias("has_case")).agg(F.sum("sample_id").alias("keys"), F.count("*").alias("n"))


@query("""
WITH i AS (SELECT l_orderkey AS o, l_linenumber AS n, l_linenumber % 2 = 0 AS image, l_orderkey % 4 = 0 AS pending, round(l_discount * 100)::INT AS d, round(l_tax * 100)::INT AS t FROM lineitem), v AS (SELECT
  count(*) AS a, count(*) FILTER (NOT image AND pending) AS b, count(*) FILTER (image AND pending) AS c, count(*) FILTER (NOT image AND d = 1) AS e, count(*) FILTER (NOT image AND d IN (2, 3)) AS f, count(*) FILTER (NOT image AND d = 4) AS g,
  count(*) FILTER (NOT image AND t = 1) AS h, count(*) FILTER (image AND d = 5) AS k, count(*) FILTER (NOT image AND d = 6) AS m, count(*) FILTER (NOT image AND t > 6) AS p, count(*) FILTER (image AND d = 7) AS q FROM i)
SELECT unnest(['all', 'pending_annotations', 'pending_images', 'outside_body', 'tiny_region', 'contained_different_label', 'broken_box', 'flagged_for_report', 'original_final_divergence', 'needs_report_first', 'reasoned_decisions', 'spot_check_unannotated']) AS name,
  unnest([a, b, c, e, f, g, h, k, m, a, p, q]) AS n FROM v""")
def saved_views(spark, sf):
    """F16: how many rows each of the twelve saved views shows."""
    d, t = F.round(F.col("l_discount") * 100).cast("int"), F.round(F.col("l_tax") * 100).cast("int")
    tag = F.lit(None).cast("string")
    for value, name in ((1, review.OUTSIDE), (2, review.TINY[0]), (3, review.TINY[2]), (4, review.NESTED), (5, review.TO_REPORT), (6, review.DIVERGENT), (7, review.SPOT_CHECK)):
        tag = F.when(d == value, name).otherwise(tag)
    items = _t(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("uid"), F.when(F.col("l_linenumber") % 2 == 0, "image").otherwise("annotation").alias("kind"), F.when(F.col("l_orderkey") % 4 == 0, "pending").otherwise("keep").alias("status"),
        F.when(tag.isNotNull(), F.array(tag)).alias("tags"), F.when(t > 6, 1).otherwise(0).alias("n_reasons"), F.when(t == 1, "wider").alias("display_adjusted"), F.col("l_returnflag").alias("dataset_id"), F.lit("x").alias("image_class"), F.lit(0).alias("series_image_index"),
    )
    return review.view_counts(items)


_FOUND = """
WITH i AS (SELECT l_orderkey AS o, l_linenumber AS n, 'C' || round(l_discount * 100)::INT AS chk, l_quantity > 10 AS asks, CASE WHEN l_linenumber % 3 <> 0 THEN l_linenumber END AS geo FROM lineitem)"""


def _found(spark, sf) -> DataFrame:
    check = F.concat(F.lit("C"), F.round(F.col("l_discount") * 100).cast("int").cast("string"))
    geo = F.when(F.col("l_linenumber") % 3 != 0, F.col("l_linenumber"))
    return _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("file_uid"), geo.alias("geometry_uid"), check.alias("check_id"), (F.col("l_quantity") > 10).alias("asks"))


@query(_FOUND + """, k AS (SELECT DISTINCT chk, o, geo FROM i WHERE asks), d AS (SELECT DISTINCT o_orderkey AS o, l_linenumber AS geo, o_custkey, c_nationkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'O')
SELECT chk AS check_id, count(*) AS annotations, count(DISTINCT c_nationkey) AS c_nationkey, count(DISTINCT o_custkey) AS o_custkey FROM k JOIN d USING (o, geo) GROUP BY 1""")
def review_scope(spark, sf):
    """The annotations, institutions and patients that each check's open findings leave to review."""
    d = _t(spark, sf, "orders").join(_t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct(), F.col("o_orderkey") == F.col("l_orderkey")).join(_t(spark, sf, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    d = d.select(F.col("o_orderkey").alias("file_uid"), F.col("l_linenumber").alias("geometry_uid"), F.when(F.col("o_orderstatus") == "O", "pending").otherwise("keep").alias("decision"), "c_nationkey", "o_custkey")
    return ladders.review_scope(_found(spark, sf), d, ["file_uid", "geometry_uid"], ["c_nationkey", "o_custkey"])


@query(_FOUND + """, w AS (SELECT o, list_sort(list(DISTINCT chk)) AS c FROM i WHERE geo IS NULL AND asks GROUP BY 1), a AS (SELECT DISTINCT o_custkey AS s FROM orders WHERE o_orderkey % 3 = 0)
SELECT o_orderkey AS file_uid, coalesce(array_to_string(c, '|'), '') AS detected, s IS NOT NULL AS series_annotated, CASE WHEN o_orderkey % 10 = 0 THEN 'exclude' END AS human_decision FROM orders LEFT JOIN w ON o = o_orderkey LEFT JOIN a ON s = o_custkey""")
def image_inputs(spark, sf):
    """Verdicts by the stable uid, findings of the image as a whole by its uid, and whether its series is annotated."""
    k = F.col("o_orderkey")
    images = _t(spark, sf, "orders").select(F.lit("d").alias("dataset_id"), F.lit("s").alias("study"), F.col("o_custkey").alias("series"), k.alias("file_uid"), F.concat(F.lit("s"), k.cast("string")).alias("stable_file_uid"), F.when(k % 3 == 0, 1).otherwise(0).alias("n_records"))
    human = images.filter("file_uid % 10 = 0").select(F.col("stable_file_uid").alias("key"), F.lit("exclude").alias("decision"), F.lit("x").alias("reason"))
    out = ladders.image_inputs(images, human, _found(spark, sf))
    return out.select("file_uid", F.array_join("detected", "|").alias("detected"), "series_annotated", "human_decision")


@query("""
WITH d AS (SELECT l_orderkey AS k, count(*) FILTER (l_linenumber IN (1, 5)) AS n FROM lineitem GROUP BY 1), e AS (SELECT k, n FROM d WHERE n > 0 UNION ALL SELECT -1, 1),
j AS (SELECT coalesce(o_orderkey, k) AS file_uid, CASE WHEN k IS NULL THEN 'no_decision' WHEN o_orderkey IS NULL THEN 'no_image' WHEN n > 1 THEN 'several_decisions' END AS rule FROM orders FULL JOIN e ON o_orderkey = k)
SELECT * FROM j WHERE rule IS NOT NULL""")
def image_contract(spark, sf):
    """V2: images without a verdict, verdicts without an image, and images with several."""
    d = _t(spark, sf, "lineitem").filter("l_linenumber in (1, 5)").select(F.col("l_orderkey").alias("file_uid")).union(spark.range(1).select((F.col("id") - 1).alias("file_uid")))
    return contracts.image_violations(d, _t(spark, sf, "orders").select(F.col("o_orderkey").alias("file_uid")))


@query("SELECT n_nationkey AS path, sha256(n_name) AS before, CASE WHEN n_regionkey = 1 THEN NULL ELSE sha256(n_name || 'x') END AS after FROM nation WHERE n_regionkey < 3 AND n_regionkey > 0")
def changed_sources(spark, sf):
    """V7: sources that changed or went while a build ran."""
    n = _t(spark, sf, "nation")
    before = n.select(F.col("n_nationkey").alias("path"), F.sha2("n_name", 256).alias("sha256"))
    after = n.filter("n_regionkey <> 1").select(F.col("n_nationkey").alias("path"), F.sha2(F.concat("n_name", F.when(F.col("n_regionkey") == 2, "x").otherwise("")), 256).alias("sha256"))
    return contracts.changed_sources(before, after)


@query("""
WITH f AS (SELECT l_orderkey, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey) AS r FROM lineitem)
SELECT count(*) AS n, count(DISTINCT l_suppkey) AS l_suppkey, count(DISTINCT l_orderkey) AS l_orderkey FROM f WHERE r = 1""")
def counted_once(spark, sf):
    """Each annotation once, by its first row, then the levels it is in."""
    return rollups.counted_once(_t(spark, sf, "lineitem"), "l_partkey", ["l_orderkey", "l_linenumber", "l_suppkey"], ["l_suppkey", "l_orderkey"])


@query("WITH n AS (SELECT l_orderkey, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT l_orderkey, string_agg(l_linestatus || '=' || n, ',' ORDER BY l_linestatus) AS counts FROM n GROUP BY 1")
def counts_by_type(spark, sf):
    """How many annotations of each type an image has, as a map (shown as text)."""
    m = rollups.counts_by_type(_t(spark, sf, "lineitem"), ["l_orderkey"], "l_linestatus")
    return m.select("l_orderkey", F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("counts"))


@query("SELECT count(*) FILTER (o_orderstatus = 'F') AS automatic_exclude, count(*) FILTER (o_orderstatus = 'O') AS automatic_keep, count(*) FILTER (o_orderstatus = 'O') AS duplicate_groups, (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS undecidable FROM orders")
def automatic_summary(spark, sf):
    """Automatic verdicts in numbers."""
    d = _t(spark, sf, "orders").select(F.when(F.col("o_orderstatus") == "F", "exclude").when(F.col("o_orderstatus") == "O", "keep").otherwise("pending").alias("decision"))
    return rollups.automatic_summary(d, _t(spark, sf, "customer").filter("c_acctbal < 0"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 3) ORDER BY 1 LIMIT 50")
def scan_batch(spark, sf):
    """T7, SC20: the first pending images of a resumed scan."""
    done = _t(spark, sf, "lineitem").filter("l_linenumber = 3").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return artifacts.pending(_t(spark, sf, "orders").select("o_orderkey"), done, "o_orderkey", 50)


@query("""
SELECT chk AS check_id, 'cannot_determine' AS status, why AS cannot_determine_reason, count(*) AS n FROM orders, (VALUES ('S05_OUTSIDE_BODY', 'no_lung_reference|thorax_reference|mediastinum_reference')) v(chk, why) GROUP BY ALL""")
def capability_gaps(spark, sf):
    """What an adapter has no evidence for can't be determined."""
    adapter = adapters.NestedAdapter(patterns=[f"{sf}/*.json"])
    rows = _t(spark, sf, "orders").select(F.lit("d").alias("dataset_id"), F.col("o_orderkey").cast("string").alias("file_uid"))
    return adapters.unverifiable(rows, adapter).groupBy("check_id", "status", "cannot_determine_reason").agg(F.count("*").alias("n"))


@query("WITH p AS (SELECT DISTINCT o_custkey FROM orders) SELECT 'once' AS run, count(*) AS kept, (SELECT count(*) FROM customer) - count(*) AS gone FROM p UNION ALL SELECT 'twice', count(*), 0 FROM p")
def prune_twice(spark, sf):
    """V8, U4: pruning twice takes nothing more."""
    files = _t(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    all_ = _t(spark, sf, "customer").select("c_custkey")
    once = merges.pruned(all_, files, ["c_custkey"])
    count = lambda name, kept, before: kept.agg(F.count("*").alias("kept")).crossJoin(merges.empty_containers(before, files, ["c_custkey"]).agg(F.count("*").alias("gone"))).select(F.lit(name).alias("run"), "kept", "gone")
    return count("once", once, all_).union(count("twice", merges.pruned(once, files, ["c_custkey"]), once))


@query("""
WITH b AS (SELECT o_orderkey AS k, CASE WHEN o_custkey % 2 = 0 THEN 'keep' ELSE 'exclude' END AS d, '2026-01-0' || (1 + o_orderkey % 3) AS s FROM orders WHERE o_orderkey % 4 <> 0),
i AS (SELECT o_orderkey AS k, 'keep' AS d, '2026-02-01' AS s FROM orders WHERE o_orderkey % 3 = 0)
SELECT CASE WHEN coalesce(b.k, i.k) % 2 = 0 THEN 'image' ELSE 'annotation' END AS kind, coalesce(i.d, b.d) AS decision, coalesce(i.s, b.s) AS reviewed_at, count(*) AS n FROM b FULL JOIN i ON b.k = i.k GROUP BY ALL""")
def verdict_store(spark, sf):
    """SK8, SC12, U1: verdicts merged into a store, written in order, and read again."""
    o, k = _t(spark, sf, "orders"), F.col("o_orderkey")
    fixed = lambda df, decision, stamp: df.select(F.when(k % 2 == 0, "image").otherwise("annotation").alias("kind"), F.lit("d").alias("dataset_id"), k.cast("string").alias("key"), decision.alias("decision"), F.lit("r").alias("reason"), F.lit("me").alias("reviewer"), stamp.alias("reviewed_at"), F.lit(None).cast("string").alias("comment"), F.lit(None).cast("string").alias("legacy_file_uid"))
    base = fixed(o.filter(k % 4 != 0), F.when(F.col("o_custkey") % 2 == 0, "keep").otherwise("exclude"), F.concat(F.lit("2026-01-0"), (1 + k % 3).cast("string")))
    path = scratch_path(spark, "verdicts")
    artifacts.write_verdicts(base, fixed(o.filter(k % 3 == 0), F.lit("keep"), F.lit("2026-02-01")), path)
    return spark.read.json(f"{path}/json").groupBy("kind", "decision", "reviewed_at").agg(F.count("*").alias("n"))


@query("""
WITH v AS (SELECT o_orderkey AS f, CASE o_orderkey % 6 WHEN 0 THEN 'exclude' WHEN 1 THEN 'pending' ELSE 'keep' END AS iv, o_orderkey % 6 = 0 AS gone, o_orderkey % 6 <> 0 AND o_custkey % 9 = 0 AS dup FROM orders),
a AS (SELECT DISTINCT l_orderkey AS f, l_linenumber AS n, CASE l_linenumber WHEN 1 THEN 'keep' WHEN 2 THEN 'pending' WHEN 3 THEN 'exclude' WHEN 4 THEN 'uncertain' WHEN 5 THEN NULL ELSE 'keep' END AS d FROM lineitem),
g AS (SELECT f, count(*) AS n, count(*) FILTER (d = 'keep' OR d = 'pending') AS k, count(*) FILTER (d = 'keep') AS kept, count(*) FILTER (d = 'exclude') AS ex, count(*) FILTER (d = 'pending') AS pe, count(*) FILTER (d = 'uncertain') AS un, count(*) FILTER (d IS NULL OR d = 'uncertain') AS uk FROM a GROUP BY 1),
j AS (SELECT v.*, NOT gone AND NOT dup AS stays, coalesce(n, 0) AS n, coalesce(k, 0) AS k, kept, ex, pe, un, uk FROM v LEFT JOIN g USING (f))
SELECT count(*) AS images_total, count(*) FILTER (iv = 'pending') AS images_pending, count(*) FILTER (gone) AS images_dropped, count(*) FILTER (dup) AS duplicates_dropped, count(*) FILTER (stays) AS files_total, count(*) FILTER (stays AND n > 0 AND k = 0) AS files_emptied,
  count(*) FILTER (stays AND n = 0) AS files_already_empty, CAST(sum(kept) FILTER (stays) AS BIGINT) AS kept, CAST(sum(ex) FILTER (stays) AS BIGINT) AS excluded, CAST(sum(pe) FILTER (stays) AS BIGINT) AS pending, CAST(sum(un) FILTER (stays) AS BIGINT) AS uncertain, CAST(sum(uk) FILTER (stays) AS BIGINT) AS unknown FROM j""")
def build_numbers(spark, sf):
    """A build with images and annotations taken out, pending ones kept, in numbers."""
    o, k, n = _t(spark, sf, "orders"), F.col("o_orderkey"), F.col("l_linenumber")
    images = o.select(F.lit("s").alias("source_json"), k.alias("file_uid"), *[F.lit("x").alias(c) for c in build.PATH], F.lit("p").alias("image_path"))
    lines = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct().withColumn("annotation_uid", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    said = F.when(n == 2, "pending").when(n == 3, "exclude").when(n == 4, "uncertain").otherwise("keep")
    verdicts = lines.filter(n != 5).select("annotation_uid", said.alias("decision"))
    image_verdicts = o.select(k.alias("file_uid"), F.when(k % 6 == 0, "exclude").when(k % 6 == 1, "pending").otherwise("keep").alias("decision"))
    annotations = lines.select(F.col("l_orderkey").alias("file_uid"), "annotation_uid", n.alias("ann_index"), F.struct("annotation_uid").alias("annotation"))
    return build.build(images, annotations, verdicts, image_verdicts, pending_as="keep", losers=o.filter("o_custkey % 9 = 0").select(k.alias("file_uid")))[1]


_HINTS = {"lateral": review.LATERAL_HINTS, "expiration": review.EXPIRATION_HINTS, "inspiration": review.INSPIRATION_HINTS}


@query("""
WITH t AS (SELECT lower(coalesce(split_part(text, ' ', 1), '') || ' ' || coalesce(split_part(text, ' ', 2), '') || ' ' || coalesce(split_part(text, ' ', 3), '')) AS h, split_part(text, ' ', 2) AS a, doc_id FROM documents WHERE text IS NOT NULL)
SELECT CASE """ + " ".join("WHEN " + " OR ".join(f"contains(h, '{x}')" for x in hints) + f" THEN '{kind}'" for kind, hints in _HINTS.items()) + """ WHEN doc_id % 7 = 0 THEN 'paired_expiration'
  WHEN a <> '' AND doc_id % 7 = 1 AND doc_id % 900 <= 600 THEN 'same_view' WHEN doc_id % 7 = 2 AND doc_id % 900 <= 600 THEN 'same_size' ELSE 'unknown' END AS kind, count(*) AS n FROM t GROUP BY 1""")
def view_kinds(spark, sf):
    """What the tags of an image and of its pair say, the first rule that fits."""
    part = F.split("text", " ", -1)
    word = lambda i: F.coalesce(F.get(part, F.lit(i)), F.lit(""))
    tags = F.create_map(F.lit("ViewPosition"), word(0), F.lit("AcquisitionDeviceProcessingDescription"), word(1), F.lit("SeriesDescription"), word(2), F.lit("Rows"), F.lit("9"), F.lit("Columns"), F.lit("9"))
    rest = F.col("doc_id") % 7
    paired = F.when(rest == 0, F.create_map(F.lit("SeriesDescription"), F.lit("EXPIRATION"))).when(rest == 1, F.create_map(F.lit("AcquisitionDeviceProcessingDescription"), word(1)))
    paired = paired.when(rest == 2, F.create_map(F.lit("Rows"), F.lit("9"), F.lit("Columns"), F.lit("9")))
    kind = review.view_kind(tags, paired, F.col("doc_id") % 900)
    return _t(spark, sf, "documents").filter("text is not null").select(kind.alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


@query("""
WITH l AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT o_orderpriority AS institution, printf('c{%d', o_custkey) AS study, o_orderstatus AS series, CAST(o_orderkey AS VARCHAR) AS file, printf('image/"%d"', o_orderkey) AS image_path, CAST(o_custkey AS VARCHAR) AS patient_id,
  CAST(coalesce(n, 0) AS INT) AS n_records, CAST(10 + length(o_orderstatus) AS INT) AS shape_w FROM orders LEFT JOIN l ON o_orderkey = l_orderkey""")
def nested_round_trip(spark, sf):
    """SC1, SC3, SC4, SC5, SK5, SK6, X5: one large document written by a range sort, by many tasks, and read in parts again, braces and quotes in its names."""
    from adjudica.sources import nested, nested_text

    line = F.struct(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("geometry_uid"), F.lit("brush").alias("annotation_type"), F.col("l_partkey").alias("min_x"))
    lines = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("annotations"))
    o = _t(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    names = dict(source_json=F.lit("set"), institution=F.col("o_orderpriority"), study=F.concat(F.lit("c{"), F.col("o_custkey").cast("string")), series=F.col("o_orderstatus"), file=F.col("o_orderkey").cast("string"))
    image = F.to_json(F.struct(F.concat(F.lit('image/"'), F.col("o_orderkey").cast("string"), F.lit('"')).alias("image_path"), F.coalesce("annotations", F.array()).alias("annotations")))
    files = o.select(*[c.alias(k) for k, c in names.items()], image.alias("value"), "o_custkey")
    studies = files.groupBy("source_json", "institution", "study").agg(F.to_json(F.struct(F.max(F.col("o_custkey").cast("string")).alias("patient_id"))).alias("members"))
    series = files.select("source_json", "institution", "study", "series").distinct().withColumn("members", F.to_json(F.struct(F.struct((F.length("series") + 10).alias("w")).alias("shape"))))
    folder = scratch_path(spark, "nested-document")
    nested_text.write_documents(nested_text.document_lines(files.drop("o_custkey"), None, studies, series), folder)
    read = nested.images_of(nested_text.studies(spark, folder, block_bytes=1 << 18))
    return read.select("institution", "study", "series", "file", "image_path", "patient_id", F.size("records").alias("n_records"), "shape_w")


_SAMPLES_SQL = """s AS (SELECT CASE WHEN c % 13 < 12 THEN 'F' || c % 13 END AS f, c AS p, o % 3 = 0 AND o % 7 > 0 AS ill, CASE WHEN o // 5 % 4 < 3 THEN ['right', 'left', 'bilateral'][o // 5 % 4 + 1] END AS side,
 CASE WHEN o // 11 % 4 < 3 THEN ['present', 'absent', 'unknown'][o // 11 % 4 + 1] END AS finding, ['present', 'absent', 'unknown'][o // 7 % 3 + 1] AS bulla, o % 6 > 0 AS spaced, o % 10 > 0 AS shaped, o % 5 > 0 AS viewed, o % 4 > 0 AS made,
 (o // 2) % 3 = 1 AS m1, (o // 3) % 3 = 1 AS m2, (o // 4) % 3 = 1 AS m3, CASE WHEN o % 9 > 0 THEN CASE WHEN o % 17 = 0 THEN 0.0 ELSE t * t / (o % 1000 + 1) / 1000000.0 END END AS area, (1000 + o % 4000) * (CAST(c % 7 + 1 AS DOUBLE) / 20) AS w
 FROM (SELECT o_orderkey AS o, o_custkey AS c, o_totalprice AS t FROM orders))"""
_KINDS = ("present", "absent", "unknown")
_CHART_TESTS = [
    ("00_overview", "samples", "total", "", "true"), ("01_label_counts", "Pneumothorax case", "present/true", "", "ill"), ("01_label_counts", "Pneumothorax case", "absent/false", "", "NOT ill"),
    ("01_label_counts", "Pneumothorax case", "unknown/null", "", "false"), ("01_label_counts", "Pneumothorax mask", "present/true", "", "m1"), ("01_label_counts", "Pneumothorax mask", "absent/false", "", "false"),
    ("01_label_counts", "Pneumothorax mask", "unknown/null", "", "NOT m1"),
    *[("01_label_counts", name, value, "", f"{column} = '{kind}'") for name, column in (("Abnormal finding", "finding"), ("Bulla / bleb", "bulla")) for kind, value in zip(_KINDS, ("present/true", "absent/false", "unknown/null"))],
    *[("02_case_vs_mask", f"Pneumothorax case = {t}", f"mask {v}", "", f"{a} AND {b}") for t, a in (("true", "ill"), ("false", "NOT ill")) for v, b in (("present", "m1"), ("absent", "NOT m1"))],
    *[("03_side", "pneumothorax_side", v, distribution.SIDE_NOTE, f"side = '{v}'") for v in ("right", "left", "bilateral")],
    *[("04_mask_coverage", m, v, "", f"{n}m{i}") for i, m in enumerate(distribution.MASKS, 1) for v, n in (("present", ""), ("missing", "NOT "))],
    *[("07_metadata", m, v, "", f"{n}{c}") for m, c in (("view_position", "viewed"), ("vendor_id", "made"), ("pixel_spacing", "spaced")) for v, n in (("present", ""), ("missing (null)", "NOT "))],
    *[("08_finding_vs_case", k, f"pneumothorax {t}", "", f"finding = '{k}' AND {a}") for k in _KINDS for t, a in (("true", "ill"), ("false", "NOT ill"))],
    *[("09_physical_width", "image_shape.width * pixel_spacing.x", f"[{a}, {b}) mm", distribution.WIDTH_NOTE, f"spaced AND shaped AND w >= {a} AND w < {b}") for a, b in ((0, 200), (200, 250), (250, 300), (300, 400), (400, 10000))],
]


def _sample_set(spark, sf) -> DataFrame:
    """A sample for each order, its customer the patient."""
    o, c, t = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")
    by = lambda n: F.floor(o / n).cast("long")
    mask = lambda n: F.when(by(n) % 3 < 2, F.struct(F.when(by(n) % 3 == 1, "mask.png").otherwise("").alias("pixel_array")))
    size = (c % 7 + 1).cast("double") / 20
    return _t(spark, sf, "orders").select(
        F.when(c % 13 < 12, F.concat(F.lit("F"), c % 13)).alias("facility_id"), c.alias("patient_id"), F.when(o % 7 > 0, o % 3 == 0).alias("pneumothorax_case"), _pick(by(5), "right", "left", "bilateral", None).alias("pneumothorax_side"),
        _pick(by(11), *_KINDS, None).alias("abnormal_finding_status"), _pick(by(7), *_KINDS).alias("bulla_bleb_status"), F.when(o % 5 > 0, "PA").alias("view_position"), F.when(o % 4 > 0, "v").alias("vendor_id"),
        F.when(o % 6 > 0, F.struct(size.alias("x"), size.alias("y"))).alias("pixel_spacing"), F.when(o % 10 > 0, F.struct(F.lit(2000).alias("height"), (1000 + o % 4000).alias("width"))).alias("image_shape"),
        F.when(o % 9 > 0, F.when(o % 17 == 0, 0.0).otherwise(t * t / (o % 1000 + 1) / 1000000.0)).alias("pneumothorax_area_mm2"), mask(2).alias("pneumothorax_mask"), mask(3).alias("lung_mask"), mask(4).alias("thorax_mask"))


@query("WITH " + _SAMPLES_SQL + ", r AS (" + " UNION ALL ".join(f"SELECT '{c}' AS chart, '{f}' AS field, '{v}' AS value, count_if({t}) AS images, '{n}' AS note FROM s" for c, f, v, n, t in _CHART_TESTS) + f"""
 UNION ALL SELECT '03_side', 'pneumothorax_side', 'unknown (null)', count_if(ill) - count(side), '{distribution.SIDE_NOTE}' FROM s
 UNION ALL SELECT '05_area', 'pneumothorax_area_mm2', printf('[%.0f, %.0f) mm2', pow(10.0, b / 4.0), pow(10.0, (b + 1) / 4.0)), count(*), '' FROM (SELECT least(greatest(floor(log10(area) * 4), 0), 19) AS b FROM s WHERE area > 0) GROUP BY b
 UNION ALL SELECT '06_facility', f, 'images', count(*), '' FROM s GROUP BY f UNION ALL SELECT '06_facility', f, 'pneumothorax true', count_if(ill), '' FROM s GROUP BY f
 UNION ALL SELECT '06_facility', f, 'pneumothorax mask', count_if(m1), '' FROM s GROUP BY f
 UNION ALL SELECT '00_overview', 'patients', 'unique (facility, patient)', count(*), '' FROM (SELECT DISTINCT f, p FROM s) UNION ALL SELECT '00_overview', 'patients', 'with pneumothorax', count(*), '' FROM (SELECT DISTINCT f, p FROM s WHERE ill))
SELECT chart, field, value, CAST(images AS BIGINT) AS images, note FROM r""")
def sample_distribution(spark, sf):
    """The counts of nine charts of a sample set."""
    return distribution.distribution(_sample_set(spark, sf))


@query("WITH " + _SAMPLES_SQL + """, g AS (SELECT f, count(*) AS n, count_if(ill) AS p, count_if(m1) AS m FROM s GROUP BY f), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, f NULLS FIRST) <= 5 AS here FROM g)
SELECT CASE WHEN here THEN f END AS facility, NOT here AS other, count(*) AS facilities, CAST(sum(n) AS BIGINT) AS images, round(sum(m) * 100 / sum(n), 6) AS with_mask, round((sum(p) - sum(m)) * 100 / sum(n), 6) AS without_mask, round((sum(n) - sum(p)) * 100 / sum(n), 6) AS others
FROM r GROUP BY ALL""")
def facility_shares(spark, sf):
    """Shares of the five largest facilities and of the rest."""
    return distribution.distribution_charts(distribution.distribution(_sample_set(spark, sf)), top=5)
