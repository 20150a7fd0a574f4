"""The operators as queries over the driver's tables.

region is a dataset, nation an institution, customer a patient, orders an image or study, lineitem an annotation;
documents are annotations with human verdicts in labels; events are versions of a store.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adjudica.operators import checks, components, contracts, ladders, merges, near_images, reports, review, rollups, survivors

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]


def _hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    """dataset, institution, patient, image and annotation of each line, images without lines too."""
    nation = _t(spark, sf, "nation").join(_t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customer = _t(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = _t(spark, sf, "orders").join(customer.select("c_custkey", "c_nationkey", "n_name", "r_name"), F.col("o_custkey") == F.col("c_custkey"))
    return orders


@query("""
WITH h AS (SELECT r_name, n_name, c_custkey, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
l AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1),
j AS (SELECT h.*, coalesce(n, 0) AS n FROM h LEFT JOIN l ON o_orderkey = l_orderkey)
SELECT coalesce(r_name, '(all)') AS dataset, count(DISTINCT n_name) AS institutions, count(DISTINCT c_custkey) AS patients, count(DISTINCT o_orderkey) AS images,
       count(DISTINCT CASE WHEN n > 0 THEN o_orderkey END) AS annotated, CAST(sum(n) AS BIGINT) AS annotations
FROM j GROUP BY GROUPING SETS ((r_name), ())""")
def level_counts(spark, sf):
    """Distinct counts by dataset and over all. Lines are counted by image before the join."""
    lines = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    j = _hierarchy(spark, sf).join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    out = j.groupingSets([["r_name"], []], "r_name").agg(
        F.count_distinct("n_name").alias("institutions"), F.count_distinct("c_custkey").alias("patients"), F.count_distinct("o_orderkey").alias("images"),
        F.count_distinct(F.when(F.col("n") > 0, F.col("o_orderkey"))).alias("annotated"), F.sum("n").alias("annotations"),
    )
    return out.select(F.coalesce("r_name", F.lit("(all)")).alias("dataset"), "institutions", "patients", "images", "annotated", "annotations")


#: Stand-ins of five checks over lines: id, severity, status, condition.
LINE_CHECKS = [
    ("M01_DISCOUNT", "warning", "checked", "l_discount > 0.08"),
    ("M04_SMALL", "error", "checked", "l_quantity < 3"),
    ("M07_TAX", "info", "cannot_determine", "l_tax = 0"),
    ("D01_RETURNED", "error", "checked", "l_returnflag = 'R' and l_quantity > 45"),
    ("S03_PRICE", "warning", "checked", "l_extendedprice < 2000"),
]


def _line_issues(spark, sf) -> DataFrame:
    """All issues in one pass over the lines: an array of those that hold, exploded."""
    found = F.array_compact(F.array(*[F.when(F.expr(c), F.struct(F.lit(i).alias("check_ord"), F.lit(k).alias("check_id"), F.lit(s).alias("severity"), F.lit(st).alias("status"))) for i, (k, s, st, c) in enumerate(LINE_CHECKS)]))
    rows = _t(spark, sf, "lineitem").select(*LINE_KEY, F.explode(found).alias("x")).select(*LINE_KEY, "x.*")
    return rows.withColumn("review_required", (F.col("status") == "checked") & F.col("severity").isin("warning", "error"))


_ISSUES_SQL = "WITH i AS (" + " UNION ALL ".join(
    f"SELECT l_orderkey, {n} AS check_ord, '{k}' AS check_id, '{s}' AS severity, '{st}' AS status FROM lineitem WHERE {c}" for n, (k, s, st, c) in enumerate(LINE_CHECKS)
) + ")"


@query(_ISSUES_SQL + """,
f AS (SELECT l_orderkey, check_id, status, min(check_ord) AS o FROM i GROUP BY ALL)
SELECT l_orderkey, count(*) FILTER (status = 'checked') AS n_issues, bool_or(status = 'checked' AND severity IN ('warning', 'error')) AS needs_review,
  CASE max(CASE WHEN status <> 'checked' THEN 0 ELSE CASE severity WHEN 'info' THEN 1 WHEN 'warning' THEN 2 WHEN 'error' THEN 3 END END) WHEN 0 THEN 'none' WHEN 1 THEN 'info' WHEN 2 THEN 'warning' ELSE 'error' END AS max_severity,
  coalesce((SELECT string_agg(check_id, '|' ORDER BY o) FROM f WHERE f.l_orderkey = i.l_orderkey AND f.status = 'checked'), 'none') AS detected_checks,
  coalesce((SELECT string_agg(check_id, '|' ORDER BY o) FROM f WHERE f.l_orderkey = i.l_orderkey AND f.status = 'cannot_determine'), 'none') AS unverified_checks
FROM i GROUP BY l_orderkey""")
def issue_union_rollup(spark, sf):
    """C*, A6, A7: issues of five checks, rolled up by image in first-seen order."""
    return rollups.issue_rollup(_line_issues(spark, sf), ["l_orderkey"])


@query(_ISSUES_SQL + """
SELECT 'check_id' AS dimension, check_id AS value, count(*) AS n FROM i GROUP BY 2 UNION ALL
SELECT 'severity', severity, count(*) FROM i GROUP BY 2 UNION ALL SELECT 'status', status, count(*) FROM i GROUP BY 2""")
def issue_summary(spark, sf):
    """Independent counts in one pass by grouping sets."""
    return rollups.dimension_counts(_line_issues(spark, sf), ["check_id", "severity", "status"])


_VERDICTS_SQL = """
WITH d AS (SELECT doc_id, source, lang, n_chars, md5(text) AS h FROM documents),
g AS (SELECT h, min(doc_id) AS first FROM d GROUP BY h),
v AS (SELECT d.*, CASE WHEN d.doc_id <> g.first THEN 'exclude' ELSE 'keep' END AS automatic, l.quality, l.toxic FROM d JOIN g USING (h) LEFT JOIN labels l ON l.doc_id = d.doc_id),
s AS (SELECT *,
  CASE WHEN toxic = 1 THEN 'exclude' END AS human, n_chars > 8000 AS review, n_chars < 150 AS unverified, lang IN ('en', 'de') AS in_scope FROM v),
t AS (SELECT doc_id, source, lang, quality, toxic,
  CASE WHEN human IS NOT NULL THEN human WHEN automatic = 'exclude' THEN 'exclude' WHEN review THEN 'pending' ELSE 'keep' END AS decision,
  CASE WHEN human IS NOT NULL THEN 'human' WHEN automatic = 'exclude' THEN 'automatic' WHEN review THEN '-' ELSE 'default' END AS decided_by,
  CASE WHEN human IS NOT NULL THEN human WHEN automatic = 'exclude' THEN 'older_exact_duplicate' WHEN review THEN 'review_required'
       WHEN unverified THEN 'kept_without_full_check' WHEN NOT in_scope THEN 'out_of_scope' ELSE 'no_issue_detected' END AS reason FROM s)"""


def _verdicts(spark, sf) -> DataFrame:
    docs = _t(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars", F.md5(F.col("text").cast("binary")).alias("h"))
    first = docs.groupBy("h").agg(F.min("doc_id").alias("first"))
    labels = _t(spark, sf, "labels").select(F.col("doc_id").alias("_l"), "quality", "toxic")
    j = docs.join(first, "h").join(labels, F.col("doc_id") == F.col("_l"), "left")
    verdict = ladders.annotation_ladder(
        F.when(F.col("toxic") == 1, "exclude"), F.when(F.col("doc_id") != F.col("first"), "exclude").otherwise("keep"),
        F.col("n_chars") > 8000, F.col("n_chars") < 150, F.col("lang").isin("en", "de"),
    )
    return j.withColumn("_v", verdict).select("doc_id", "source", "lang", "quality", "toxic", F.col("_v.decision").alias("decision"), F.col("_v.source").alias("decided_by"), F.col("_v.reason").alias("reason"))


@query(_VERDICTS_SQL + " SELECT doc_id, decision, decided_by, reason FROM t")
def selection_ladder(spark, sf):
    """One verdict for each document, from human, automatic and review inputs."""
    return _verdicts(spark, sf).select("doc_id", "decision", "decided_by", "reason")


@query(_VERDICTS_SQL + """, b AS (SELECT doc_id, decision, decided_by, reason, doc_id AS i FROM t WHERE doc_id % 97 > 0 UNION ALL SELECT doc_id, decision, decided_by, reason, doc_id FROM t WHERE doc_id % 89 = 0
 UNION ALL SELECT doc_id + 1000000000, decision, decided_by, reason, doc_id FROM t WHERE doc_id % 101 = 0),
bk AS (SELECT doc_id, count(*) AS n FROM b GROUP BY 1)
SELECT 'row_count' AS rule, abs((SELECT count(*) FROM b) - (SELECT count(*) FROM t)) AS n UNION ALL SELECT 'duplicate_key', count(*) FROM bk WHERE n > 1
UNION ALL SELECT 'key_without_decision', count(*) FROM t WHERE doc_id NOT IN (SELECT doc_id FROM bk) UNION ALL SELECT 'decision_without_key', count(*) FROM bk WHERE doc_id NOT IN (SELECT doc_id FROM t)
UNION ALL SELECT 'known_decision', 0 UNION ALL SELECT 'not_needed_is_final', count(*) FROM b WHERE i % 7 = 0 AND decision NOT IN ('keep', 'exclude')
UNION ALL SELECT 'human_has_reviewer', count(*) FROM b WHERE decided_by = 'human' AND i % 3 > 0 UNION ALL SELECT 'unverified_has_checks', count(*) FROM b WHERE reason = 'kept_without_full_check' AND i % 2 = 0""")
def selection_contract(spark, sf):
    """V1: a selection table that lacks documents, has some twice and others that are none, held against the whole contract."""
    v = _verdicts(spark, sf)
    i = F.col("doc_id")
    table = v.select("doc_id", "decision", F.col("decided_by").alias("source"), "reason", F.when(i % 7 == 0, "not_needed").otherwise("pending").alias("review_status"),
                     F.when(i % 3 == 0, "r").when(i % 3 == 1, "").alias("reviewer"), F.when(i % 2 == 0, "none").otherwise("M05_FILE_MISSING").alias("unverified_checks"))
    broken = table.withColumn("doc_id", F.explode(F.concat(F.when(i % 97 > 0, F.array(i)).otherwise(F.array().cast("array<long>")), F.when(i % 89 == 0, F.array(i)).otherwise(F.array().cast("array<long>")), F.when(i % 101 == 0, F.array(i + 1000000000)).otherwise(F.array().cast("array<long>")))))
    return contracts.decision_contract(broken, v, ["doc_id"])


@query(_VERDICTS_SQL + """
SELECT 'decision' AS dimension, decision AS value, count(*) AS n FROM t GROUP BY 2 UNION ALL SELECT 'decided_by', decided_by, count(*) FROM t GROUP BY 2
UNION ALL SELECT 'reason', reason, count(*) FROM t GROUP BY 2""")
def decision_summary(spark, sf):
    """Counts of verdicts by decision, who decided, and why."""
    return rollups.dimension_counts(_verdicts(spark, sf), ["decision", "decided_by", "reason"])


_STATUS_SQL = """, c AS (SELECT source, CASE WHEN bool_or(decision IN ('pending', 'uncertain')) THEN 'needs_review' WHEN bool_or(decision = 'keep') AND bool_or(decision = 'exclude') THEN 'partial'
  WHEN bool_or(decision = 'keep') THEN 'passed' ELSE 'all_excluded' END AS status FROM t GROUP BY source)"""


@query(_VERDICTS_SQL + _STATUS_SQL + " SELECT v.status, count(c.source) AS n FROM (VALUES ('passed'), ('partial'), ('all_excluded'), ('needs_review'), ('no_annotation')) v(status) LEFT JOIN c USING (status) GROUP BY 1")
def case_status(spark, sf):
    """The status of each source by its verdicts, counted over the whole vocabulary."""
    return ladders.status_counts(ladders.case_status(_verdicts(spark, sf), ["source"]))


@query(_VERDICTS_SQL + """, f AS (SELECT doc_id, decision, unnest(list_filter([CASE WHEN toxic = 1 THEN 'TOXIC' END, CASE WHEN quality = 0 THEN 'QUALITY' END, CASE WHEN reason = 'review_required' THEN 'LONG' END], lambda x: x IS NOT NULL)) AS check_id FROM t)
SELECT check_id, count(*) AS detected, count(*) FILTER (decision = 'exclude') AS excluded, count(*) FILTER (decision = 'keep') AS kept, count(*) FILTER (decision = 'uncertain') AS uncertain,
  CASE WHEN count(*) FILTER (decision IN ('exclude', 'keep', 'uncertain')) > 0 THEN count(*) FILTER (decision = 'exclude')::DOUBLE / count(*) FILTER (decision IN ('exclude', 'keep', 'uncertain')) END AS precision
FROM f GROUP BY 1""")
def precision(spark, sf):
    """Of what a check detects, the share that was excluded."""
    v = _verdicts(spark, sf)
    which = F.array_compact(F.array(F.when(F.col("toxic") == 1, "TOXIC"), F.when(F.col("quality") == 0, "QUALITY"), F.when(F.col("reason") == "review_required", "LONG")))
    return rollups.precision(v.select("doc_id", "decision", F.explode(which).alias("check_id")), "check_id", "doc_id", "decision")


@query("""
WITH b AS (SELECT *, CASE l_returnflag WHEN 'A' THEN 5.0 WHEN 'N' THEN 3.0 ELSE 8.0 END AS floor FROM lineitem)
SELECT l_returnflag AS family, CASE WHEN l_quantity < floor THEN 'below_floor' ELSE 'review_band' END AS band, count(*) AS n FROM b WHERE l_quantity < floor * 3 GROUP BY 1, 2""")
def tiny_by_class(spark, sf):
    """Areas below the floor of their family, or in the band above it."""
    config = {"small": {"by_class": {"A": 5.0, "N": 3.0, "R": 8.0}, "band_factor": 3.0}}
    band = checks.small_band(F.col("l_quantity"), F.col("l_returnflag"), config)
    return _t(spark, sf, "lineitem").select(F.col("l_returnflag").alias("family"), band.alias("band")).filter("band is not null").groupBy("family", "band").agg(F.count("*").alias("n"))


def _interval_pairs(spark, sf) -> DataFrame:
    line = _t(spark, sf, "lineitem").select(*LINE_KEY, "l_quantity", "l_returnflag")
    order = Window.partitionBy("l_orderkey").orderBy(*LINE_KEY[1:])
    line = line.select("l_orderkey", F.row_number().over(order).alias("i"), F.col("l_suppkey").cast("double").alias("x0"), (F.col("l_suppkey") + F.col("l_quantity")).cast("double").alias("x1"), "l_returnflag")
    a, b = (line.select("l_orderkey", *[F.col(c).alias(f"{c}_{s}") for c in line.columns[1:]]) for s in "ab")
    j = a.join(b, "l_orderkey").filter("i_a < i_b and x0_a < x1_b and x0_b < x1_a")
    inter = F.least("x1_a", "x1_b") - F.greatest("x0_a", "x0_b")
    la, lb = F.col("x1_a") - F.col("x0_a"), F.col("x1_b") - F.col("x0_b")
    return j.select("l_orderkey", F.col("i_a").alias("uid_a"), F.col("i_b").alias("uid_b"), (inter / (la + lb - inter)).alias("iou"), F.greatest(inter / la, inter / lb).alias("most"), (F.col("l_returnflag_a") == F.col("l_returnflag_b")).alias("same"))


@query("""
WITH l AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS i, l_suppkey::DOUBLE AS x0, (l_suppkey + l_quantity)::DOUBLE AS x1, l_returnflag FROM lineitem),
p AS (SELECT a.l_orderkey, a.i AS ia, b.i AS ib, least(a.x1, b.x1) - greatest(a.x0, b.x0) AS n, a.x1 - a.x0 AS la, b.x1 - b.x0 AS lb, a.l_returnflag = b.l_returnflag AS same
  FROM l a JOIN l b ON a.l_orderkey = b.l_orderkey AND a.i < b.i AND a.x0 < b.x1 AND b.x0 < a.x1),
k AS (SELECT *, CASE WHEN n / (la + lb - n) >= 1 THEN 'exact' WHEN n / (la + lb - n) >= 0.95 THEN 'near' WHEN greatest(n / la, n / lb) >= 0.98 THEN 'contained' END AS kind FROM p),
s AS (SELECT l_orderkey, ia AS own, ib AS other, kind, same, n / (la + lb - n) AS iou FROM k WHERE kind IS NOT NULL UNION ALL SELECT l_orderkey, ib, ia, kind, same, n / (la + lb - n) FROM k WHERE kind IS NOT NULL)
SELECT l_orderkey, own::BIGINT AS geometry_uid, other::BIGINT AS related_uid, kind, same, round(iou, 6) AS iou FROM s""")
def interval_pairs(spark, sf):
    """Overlapping intervals of one image, classified, two rows a pair."""
    config = {"duplicate": {"iou_near": 0.95, "containment": 0.98}}
    pairs = _interval_pairs(spark, sf).withColumn("kind", checks.pair_kind(F.col("iou"), F.col("most"), F.lit(False), config)).filter("kind is not null")
    return checks.pair_sides(pairs).select("l_orderkey", F.col("geometry_uid").cast("long").alias("geometry_uid"), F.col("related_uid").cast("long").alias("related_uid"), "kind", "same", F.round("iou", 6).alias("iou"))


_DUP_SQL = "WITH d AS (SELECT doc_id, source, lang, md5(text) AS h, doc_id % 97 AS stamp, doc_id % 7 AS export FROM documents), c AS (SELECT h, count(*) AS n FROM d GROUP BY h), m AS (SELECT d.*, n FROM d JOIN c USING (h) WHERE n > 1)"


def _copies(spark, sf) -> DataFrame:
    d = _t(spark, sf, "documents").select("doc_id", "source", "lang", F.md5(F.col("text").cast("binary")).alias("h"), (F.col("doc_id") % 97).alias("stamp"), (F.col("doc_id") % 7).alias("export"))
    several = d.groupBy("h").agg(F.count("*").alias("_n")).filter("_n > 1").select("h")
    return d.join(several, "h")


@query(_DUP_SQL + """, g AS (SELECT h, count(DISTINCT stamp) AS k, count(*) AS n, max(stamp) AS s FROM m GROUP BY h)
SELECT doc_id, CASE WHEN k < g.n THEN 'timestamp_tie' WHEN stamp = s THEN 'newest_of_exact_duplicate_group' ELSE 'older_exact_duplicate' END AS reason, CASE WHEN k < g.n THEN NULL WHEN stamp = s THEN 'keep' ELSE 'exclude' END AS decision,
  CASE WHEN k = g.n THEN (SELECT max(doc_id) FROM m x WHERE x.h = m.h AND x.stamp = s) END AS kept_uid FROM m JOIN g USING (h)""")
def exact_dup_survivor(spark, sf):
    """L3: of exact copies the newest stays; ties decide nothing."""
    return survivors.newest_wins(_copies(spark, sf), ["h"], "stamp", "doc_id").select("doc_id", "reason", "decision", "kept_uid")


@query(_DUP_SQL + """, g AS (SELECT h, count(DISTINCT stamp) AS ks, count(DISTINCT export) AS ke, count(*) AS n, max(stamp) AS s, min(export) AS e FROM m GROUP BY h)
SELECT doc_id, CASE WHEN ks = g.n THEN 'newest' WHEN ke < g.n THEN 'timestamp_tie' ELSE 'oldest_export' END AS outcome,
  CASE WHEN ks = g.n THEN (SELECT max(doc_id) FROM m x WHERE x.h = m.h AND x.stamp = s) WHEN ke = g.n THEN (SELECT min(doc_id) FROM m x WHERE x.h = m.h AND x.export = e) END AS survivor FROM m JOIN g USING (h)""")
def cross_dataset_survivor(spark, sf):
    """The newest, or on a tie the oldest export."""
    return survivors.survivor(_copies(spark, sf), ["h"], "stamp", "export", "doc_id").select("doc_id", "outcome", "survivor")


@query("""
WITH d AS (SELECT doc_id, source AS dataset_id, md5(text) AS content, lang, doc_id % 97 AS stamp, doc_id % 7 AS export FROM documents),
c AS (SELECT content, lang, count(DISTINCT dataset_id) AS k, min(doc_id) AS first FROM d GROUP BY 1, 2),
g AS (SELECT content, lang, printf('XDUP_%04d', row_number() OVER (ORDER BY first)) AS group_id FROM c WHERE k > 1),
m AS (SELECT d.*, group_id FROM d JOIN g USING (content, lang)),
s AS (SELECT group_id, count(*) AS n, count(DISTINCT stamp) AS ks, count(DISTINCT export) AS ke, arg_max(doc_id, stamp) AS newest, arg_min(doc_id, export) AS oldest FROM m GROUP BY 1),
x AS (SELECT m.*, CASE WHEN ks = n THEN newest WHEN ke = n THEN oldest END AS survivor FROM m JOIN s USING (group_id))
SELECT doc_id AS geometry_uid, group_id, CASE WHEN survivor IS NULL THEN 'tie' WHEN survivor = doc_id THEN 'keep' ELSE 'exclude' END AS outcome, survivor AS kept_uid FROM x""")
def cross_source_dup(spark, sf):
    """Copies with equal labels in several datasets, their groups, and which of each stays; ties decide nothing."""
    decisions, found = checks.cross_dataset(_cross_records(spark, sf))
    tie = found.filter("check_id = 'D05_CROSS_DATASET_DUPLICATE_TIE'").select("geometry_uid", F.col("detail")["group"].alias("group_id"), F.lit("tie").alias("outcome"), F.lit(None).cast("long").alias("kept_uid"))
    return decisions.select("geometry_uid", "group_id", F.col("decision").alias("outcome"), "kept_uid").union(tie)


def _cross_records(spark, sf) -> DataFrame:
    d = _t(spark, sf, "documents")
    content = F.md5(F.col("text").cast("binary"))
    return d.select(
        F.col("source").alias("dataset_id"), F.col("doc_id").alias("geometry_uid"), content.alias("image_path"), F.col("lang").alias("label_key"), content.alias("content"),
        (F.col("doc_id") % 97).alias("stamp"), (F.col("doc_id") % 7).alias("export"), F.col("doc_id").alias("place"),
    )


@query("""
WITH v AS (SELECT DISTINCT l_returnflag AS ds, l_orderkey AS image, l_linenumber AS uid, l_quantity AS content FROM lineitem),
g AS (SELECT image, uid, list({'ds': ds, 'content': content}) AS versions FROM v GROUP BY image, uid HAVING min(ds) <> max(ds)),
o AS (SELECT image, uid, versions, unnest(versions) AS own FROM g),
x AS (SELECT image, uid, own.ds AS dataset_id, unnest(list_filter(versions, lambda w: w.ds <> own.ds AND w.content <> own.content)) AS other FROM o)
SELECT dataset_id, image, uid AS geometry_uid, other.ds AS other_dataset, count(*) AS n FROM x GROUP BY ALL""")
def cross_dataset_mismatch(spark, sf):
    """One geometry uid that several datasets hold with other contents, in one version or in several of each."""
    line = _t(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("dataset_id"), F.concat_ws("/", "l_orderkey", "l_linenumber").alias("geometry_uid"), F.col("l_orderkey").alias("image_path"), F.lit("x").alias("label_key"), F.col("l_quantity").alias("content"),
    )
    found = checks.cross_dataset_versions(line)
    uid = F.split("geometry_uid", "/")
    return found.groupBy("dataset_id", uid[0].cast("long").alias("image"), uid[1].cast("long").alias("geometry_uid"), "other_dataset").agg(F.count("*").alias("n"))


@query("""
WITH d AS (SELECT source AS dataset_id, doc_id, md5(text) AS image, lang, doc_id % 97 AS stamp, doc_id % 7 AS export FROM documents),
c AS (SELECT image, lang FROM d GROUP BY 1, 2 HAVING min(dataset_id) <> max(dataset_id)),
m AS (SELECT d.* FROM d JOIN c ON d.image = c.image AND d.lang IS NOT DISTINCT FROM c.lang),
s AS (SELECT image, lang, count(*) AS n, count(DISTINCT stamp) AS ks, count(DISTINCT export) AS ke, arg_max(doc_id, stamp) AS newest, arg_min(doc_id, export) AS oldest FROM m GROUP BY 1, 2),
x AS (SELECT m.*, CASE WHEN ks = n THEN newest WHEN ke = n THEN oldest END AS kept FROM m JOIN s ON m.image = s.image AND m.lang IS NOT DISTINCT FROM s.lang),
i AS (
  SELECT 'D05_CROSS_DATASET_DUPLICATE' AS check_id, doc_id AS uid FROM x WHERE kept <> doc_id UNION ALL SELECT 'D05_CROSS_DATASET_DUPLICATE', kept FROM x WHERE kept <> doc_id UNION ALL
  SELECT 'D05_CROSS_DATASET_DUPLICATE_TIE', doc_id FROM x WHERE kept IS NULL UNION ALL
  SELECT 'M07_BBOX_DEGENERATE', doc_id FROM d WHERE doc_id % 4 = 0 AND doc_id NOT IN (SELECT doc_id FROM x WHERE kept IS NOT NULL AND kept <> doc_id))
SELECT check_id, uid, count(*) AS n FROM i GROUP BY ALL""")
def cross_dataset_run(spark, sf):
    """Copies across datasets found before all checks, reported as D05, and the losers hidden from the other checks."""
    d = _t(spark, sf, "documents")
    lang = F.array("lang")
    annotations = d.select(
        F.col("source").alias("dataset_id"), F.col("doc_id").cast("string").alias("file_uid"), F.col("doc_id").cast("string").alias("geometry_uid"), F.md5(F.col("text").cast("binary")).alias("image_path"), lang.alias("label_keys"),
        (F.col("doc_id") % 97).alias("stamp"), (F.col("doc_id") % 7).alias("export_stamp"), F.lit(0).alias("ann_index"), F.lit("rect").alias("annotation_type"),
        F.lit(1).alias("min_x"), F.lit(1).alias("min_y"), F.when(F.col("doc_id") % 4 == 0, 1).otherwise(9).alias("max_x"), F.lit(9).alias("max_y"), F.lit(10).alias("shape_w"), F.lit(10).alias("shape_h"), F.lit(10).alias("declared_w"), F.lit(10).alias("declared_h"),
    )
    box = dict(max_x=F.lit(9))  # of copies, the box is the same; it degenerates by the row only after they were compared
    ctx, _ = checks.resolve_cross_dataset(checks.Context(annotations=annotations.withColumns(box)))
    ctx.annotations = ctx.annotations.withColumn("max_x", F.when(F.col("geometry_uid").cast("long") % 4 == 0, 1).otherwise(9))
    return checks.run(ctx, only=["D05", "M07"]).groupBy("check_id", F.col("geometry_uid").cast("long").alias("uid")).agg(F.count("*").alias("n"))


@query("""
WITH RECURSIVE o AS (SELECT o_orderkey, o_custkey, o_orderdate, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prior FROM orders),
s AS (SELECT *, sum(CASE WHEN before IS NOT NULL AND date_diff('day', prior::DATE, o_orderdate::DATE) <= 30 THEN 0 ELSE 1 END) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS g FROM o),
c AS (SELECT o_orderkey, min(o_orderkey) OVER (PARTITION BY o_custkey, g) AS label, count(*) OVER (PARTITION BY o_custkey, g) AS n FROM s)
SELECT o_orderkey AS node, label FROM c WHERE n > 1""")
def dup_components(spark, sf):
    """Components of images of one patient that follow each other within 30 days."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = _t(spark, sf, "orders").select("o_orderkey", F.lag("o_orderkey").over(w).alias("before"), F.datediff(F.col("o_orderdate").cast("date"), F.lag("o_orderdate").over(w).cast("date")).alias("days"))
    return components.components(o.filter("before is not null and days <= 30").select(F.col("o_orderkey").alias("a"), F.col("before").alias("b")))


@query("""
WITH l AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1),
o AS (SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, n IS NOT NULL AS has FROM orders LEFT JOIN l ON o_orderkey = l_orderkey),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY has DESC, o_orderdate DESC NULLS LAST, o_orderpriority, o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS n, max(has::INT) OVER (PARTITION BY o_custkey) AS mx, min(has::INT) OVER (PARTITION BY o_custkey) AS mn FROM o)
SELECT o_orderkey, k = 1 AS is_winner, n AS group_size, CASE WHEN n = 1 THEN 'unique' WHEN mx <> mn THEN 'annotated_preferred' WHEN mx = 1 THEN 'both_annotated' ELSE 'none_annotated' END AS reason FROM r""")
def image_winner(spark, sf):
    """Of the images of one path, one with annotations, the newest."""
    lines = _t(spark, sf, "lineitem").select("l_orderkey").distinct()
    o = _t(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("has", F.col("l_orderkey").isNotNull())
    return survivors.winner(o, "o_custkey", "has", "o_orderdate", "o_orderpriority", ["o_orderkey"]).select("o_orderkey", "is_winner", "group_size", "reason")


@query('SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS "index", count(*) OVER (PARTITION BY conv_id) AS count FROM conversations')
def series_ordinal(spark, sf):
    """SC9: the place of an image in its series, and their count."""
    return rollups.ordinals(_t(spark, sf, "conversations"), ["conv_id"], ["turn"]).select("conv_id", "turn", "index", "count")


_CLASS_SQL = """
WITH l AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1),
o AS (SELECT o_orderkey, o_custkey, coalesce(n, 0) AS n, o_orderstatus = 'P' AS negative FROM orders LEFT JOIN l ON o_orderkey = l_orderkey),
k AS (SELECT *, CASE WHEN n > 0 THEN 'annotated' WHEN negative THEN 'negative_case' WHEN max(n) OVER (PARTITION BY o_custkey) > 0 THEN 'unannotated_view' ELSE 'unannotated_orphan' END AS image_class FROM o)"""


def _classes(spark, sf) -> DataFrame:
    lines = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    o = _t(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "o_custkey", F.coalesce("n", F.lit(0)).alias("n"), (F.col("o_orderstatus") == "P").alias("negative"))
    annotated = F.max("n").over(Window.partitionBy("o_custkey")) > 0
    return o.withColumn("series_annotated", annotated).withColumn("image_class", ladders.image_class(F.col("n"), F.col("negative"), F.col("series_annotated")))


@query(_CLASS_SQL + " SELECT image_class, count(*) AS images, count(DISTINCT o_custkey) AS patients FROM k GROUP BY 1")
def unannotated_class(spark, sf):
    """Images by class."""
    return _classes(spark, sf).groupBy("image_class").agg(F.count("*").alias("images"), F.count_distinct("o_custkey").alias("patients"))


@query(_CLASS_SQL + """
SELECT o_orderkey, CASE WHEN image_class = 'annotated' THEN 'keep' WHEN image_class = 'unannotated_orphan' AND o_custkey % 2 = 0 THEN 'keep' WHEN image_class = 'unannotated_orphan' THEN 'exclude' WHEN image_class = 'unannotated_view' THEN 'pending' ELSE 'keep' END AS decision,
  CASE WHEN image_class = 'unannotated_orphan' AND o_custkey % 2 = 0 THEN 'override' WHEN image_class = 'unannotated_view' THEN '-' ELSE 'default' END AS decided_by,
  CASE image_class WHEN 'annotated' THEN 'has_annotations' WHEN 'unannotated_orphan' THEN 'unannotated_orphan_unused' WHEN 'unannotated_view' THEN 'review_required' ELSE 'negative_case' END AS reason FROM k""")
def image_ladder(spark, sf):
    """One verdict for each image, and rules that keep default exclusions."""
    k = _classes(spark, sf).withColumn("parity", (F.col("o_custkey") % 2).cast("string"))
    v = ladders.image_ladder(F.lit(None).cast("string"), F.col("image_class"), F.col("image_class") == "unannotated_view")
    rule = ladders.matching_override([{"id": "even", "action": "keep", "parity": ["0"], "image_class": None}], {"parity": F.col("parity"), "image_class": F.col("image_class")})
    k = k.withColumn("v", v).withColumn("v", ladders.overridden(F.col("v"), rule))
    return k.select("o_orderkey", F.col("v.decision").alias("decision"), F.col("v.source").alias("decided_by"), F.col("v.reason").alias("reason"))


@query("""
WITH c AS (SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1), t AS (SELECT *, row_number() OVER (ORDER BY n DESC, n_name) AS r FROM c)
SELECT CASE WHEN r <= 10 THEN n_name ELSE 'other' END AS n_name, CAST(sum(n) AS BIGINT) AS n FROM t GROUP BY 1""")
def top_plus_other(spark, sf):
    """The ten largest institutions and the rest."""
    j = _t(spark, sf, "customer").join(_t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rollups.top_and_other(j, "n_name", 10)


@query("SELECT CAST(floor(log10(n_chars::DOUBLE) * 4) AS BIGINT) AS bin, count(*) AS n FROM documents WHERE n_chars > 0 GROUP BY 1")
def log_histogram(spark, sf):
    """Quarter-decade bins of lengths."""
    return rollups.log_histogram(_t(spark, sf, "documents"), "n_chars")


@query("SELECT source, (list_sort(list(n_chars)))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS median FROM documents GROUP BY source")
def upper_median(spark, sf):
    """The upper median of lengths by source."""
    return rollups.upper_median(_t(spark, sf, "documents"), ["source"], "n_chars")


@query("SELECT CAST(CASE WHEN l_quantity >= 40 THEN 3 WHEN l_quantity >= 20 THEN 2 WHEN l_quantity >= 10 THEN 1 WHEN l_quantity >= 0 THEN 0 ELSE -1 END AS INT) AS bucket, count(*) AS n FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY 1")
def bucketed_widths(spark, sf):
    """Half-open ranges."""
    return rollups.width_buckets(_t(spark, sf, "lineitem"), "l_quantity", [0, 10, 20, 40])


@query("SELECT doc_id, source, lang FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS r FROM documents) WHERE r <= 3")
def spot_sample(spark, sf):
    """T4: three documents of each bucket."""
    return rollups.spot_sample(_t(spark, sf, "documents").select("doc_id", "source", "lang"), ["source", "lang"], ["doc_id"], 3)


@query("""
WITH a AS (SELECT user_id, event_type, max(ts)::VARCHAR AS stamp, arg_max(event_id % 3, event_id) AS decision FROM events WHERE event_id % 2 = 0 GROUP BY 1, 2),
b AS (SELECT user_id, event_type, max(ts)::VARCHAR AS stamp, arg_max(event_id % 3, event_id) AS decision FROM events WHERE event_id % 2 = 1 GROUP BY 1, 2),
j AS (SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.event_type, b.event_type) AS event_type, a.stamp AS s1, b.stamp AS s2, a.decision AS d1, b.decision AS d2, a.user_id IS NOT NULL AS ia, b.user_id IS NOT NULL AS ib
  FROM a FULL JOIN b ON a.user_id = b.user_id AND a.event_type = b.event_type),
k AS (SELECT *, CASE WHEN NOT ia THEN 'inserted' WHEN NOT ib THEN 'kept' WHEN d1 = d2 THEN CASE WHEN s2 >= s1 THEN 'refreshed' ELSE 'kept' END WHEN s1 = s2 THEN 'conflict' WHEN s2 > s1 THEN 'replaced' ELSE 'kept' END AS action FROM j)
SELECT user_id, event_type, CASE WHEN action IN ('inserted', 'refreshed', 'replaced') THEN d2 ELSE d1 END AS decision, action FROM k""")
def upsert_latest(spark, sf):
    """Two stores merged by key, the later stamp deciding."""
    e = _t(spark, sf, "events")
    side = lambda p: e.filter(F.col("event_id") % 2 == p).groupBy("user_id", "event_type").agg(F.max_by(F.col("event_id") % 3, "event_id").alias("decision"), F.max("ts").cast("string").alias("stamp"))
    return merges.upsert(side(0), side(1), ["user_id", "event_type"], "decision", "stamp").select("user_id", "event_type", "decision", "action")


@query("""
WITH p AS (SELECT c_nationkey, c_custkey % 2 AS ds, c_mktsegment, c_acctbal > 0 AS positive FROM customer),
f AS (SELECT c_nationkey, 'c_mktsegment' AS field, count(DISTINCT c_mktsegment) AS n_values FROM p GROUP BY 1 UNION ALL SELECT c_nationkey, 'positive', count(DISTINCT positive) FROM p GROUP BY 1)
SELECT * FROM f WHERE n_values > 1""")
def tree_merge_conflicts(spark, sf):
    """Scalars of containers on which the merged datasets disagree."""
    p = _t(spark, sf, "customer").select("c_nationkey", "c_mktsegment", (F.col("c_acctbal") > 0).alias("positive"))
    return merges.conflicts(p, ["c_nationkey"], ["c_mktsegment", "positive"])


@query("SELECT c_nationkey, arg_min(c_mktsegment, c_custkey) AS c_mktsegment FROM customer GROUP BY 1")
def tree_merge_values(spark, sf):
    """The first dataset's value of each container."""
    return merges.container_values(_t(spark, sf, "customer"), ["c_nationkey"], ["c_mktsegment"], "c_custkey")


@query("""
SELECT 'kept' AS what, count(*) AS n FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') UNION ALL
SELECT 'empty', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def prune_empty(spark, sf):
    """Patients without an image that is left are pruned and counted."""
    c = _t(spark, sf, "customer").select("c_custkey")
    files = _t(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    one = lambda df, w: df.agg(F.count("*").alias("n")).select(F.lit(w).alias("what"), "n")
    return one(merges.pruned(c, files, ["c_custkey"]), "kept").union(one(merges.empty_containers(c, files, ["c_custkey"]), "empty"))


@query("""SELECT 'text' AS "column", count(*) FILTER (text IS NULL OR text = '') AS nulls FROM documents UNION ALL SELECT 'lang', count(*) FILTER (lang IS NULL) FROM documents UNION ALL SELECT 'n_chars', count(*) FILTER (n_chars IS NULL) FROM documents""")
def null_census(spark, sf):
    """Nulls by column in one pass."""
    return rollups.null_census(_t(spark, sf, "documents"), ["text", "lang", "n_chars"], {"text": F.col("text") == ""})


@query("""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e, array_to_string(list_transform(embedding[1:8], lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS block FROM embeddings),
p AS (SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.e, b.e) AS s FROM v a JOIN v b ON a.block = b.block AND a.vec_id < b.vec_id)
SELECT a, b, CAST(round(s * 1000) AS BIGINT) AS permille FROM p WHERE s >= 0.25""")
def near_dup_blocked(spark, sf):
    """Pairs of one block whose normalised vectors correlate; a block shares the signs of the first eight components."""
    bits = F.array_join(F.transform(F.slice("embedding", 1, 8), lambda x: F.when(x > 0, "1").otherwise("0")), "")
    found = near_images.near_vectors(_t(spark, sf, "embeddings").select("vec_id", bits.alias("block"), "embedding"), 0.25)
    return found.select("a", "b", F.round(F.col("s") * 1000).cast("long").alias("permille"))


@query("SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1, 2")
def json_props(spark, sf):
    """SC3, S24: a typed reading of JSON."""
    e = _t(spark, sf, "events").select("event_type", F.from_json("props", "k bigint")["k"].alias("k"))
    return e.groupBy("event_type", "k").agg(F.count("*").alias("n"))


@query("""SELECT CASE WHEN lower(url) LIKE '%utm_%' THEN 'campaign' WHEN lower(url) LIKE '%page=%' THEN 'paged' WHEN regexp_matches(lower(html), '<table') THEN 'table' WHEN regexp_matches(lower(url), '\\.html') THEN 'article' ELSE 'unknown' END AS kind, count(*) AS n FROM pages GROUP BY 1""")
def page_keyword_class(spark, sf):
    """An ordered list of keyword tests, the first that holds."""
    u, h = F.lower("url"), F.lower("html")
    kind = F.when(u.contains("utm_"), "campaign").when(u.contains("page="), "paged").when(h.contains("<table"), "table").when(u.contains(".html"), "article").otherwise("unknown")
    return _t(spark, sf, "pages").select(kind.alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


@query("WITH r AS (SELECT unnest(string_split(o_orderpriority || '|' || o_orderstatus, '|')) AS reason FROM orders) SELECT reason, count(*) AS n FROM r WHERE reason <> '' AND reason <> 'none' GROUP BY 1")
def reason_explode(spark, sf):
    """Pipe-joined reasons, counted."""
    return rollups.exploded_reasons(_t(spark, sf, "orders").select(F.concat_ws("|", "o_orderpriority", "o_orderstatus").alias("r")), "r")


@query("SELECT CASE WHEN l_returnflag = 'R' OR l_linestatus = 'O' THEN 'in_scope' ELSE 'out_of_scope' END AS scope, count(*) AS n FROM lineitem GROUP BY 1")
def scope_split(spark, sf):
    """F1, U8: the population in and out of scope, no row lost."""
    line = _t(spark, sf, "lineitem").select("l_returnflag", "l_linestatus")
    test = (F.col("l_returnflag") == "R") | (F.col("l_linestatus") == "O")
    return line.groupBy(F.when(test, "in_scope").otherwise("out_of_scope").alias("scope")).agg(F.count("*").alias("n"))


@query(_VERDICTS_SQL + """
SELECT 'known_decision' AS rule, count(*) FILTER (NOT coalesce(decision IN ('keep', 'exclude', 'pending', 'uncertain'), false)) AS n FROM t UNION ALL
SELECT 'human_excludes', count(*) FILTER (NOT (decided_by <> 'human' OR decision = 'exclude')) FROM t UNION ALL SELECT 'not_pending', count(*) FILTER (decision = 'pending') FROM t""")
def contract_counts(spark, sf):
    """V1, V3: violations of each rule, zeros too."""
    d = F.col("decision")
    return contracts.violation_counts(_verdicts(spark, sf), {"known_decision": d.isin("keep", "exclude", "pending", "uncertain"), "human_excludes": (F.col("decided_by") != "human") | (d == "exclude"), "not_pending": d != "pending"})


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    """V1, V6: keys that aren't unique."""
    return contracts.duplicate_keys(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
WITH o AS (SELECT o_orderkey, o_orderstatus AS a, o_orderpriority AS b FROM orders WHERE o_orderpriority <> '5-LOW'), n AS (SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'X' ELSE o_orderstatus END AS a, o_orderpriority AS b FROM orders WHERE o_orderstatus <> 'P')
SELECT 'removed' AS what, count(*) AS n FROM o ANTI JOIN n USING (o_orderkey) UNION ALL SELECT 'added', count(*) FROM n ANTI JOIN o USING (o_orderkey) UNION ALL
SELECT 'common', count(*) FROM o JOIN n USING (o_orderkey) UNION ALL SELECT 'changed:a', count(*) FILTER (o.a IS DISTINCT FROM n.a) FROM o JOIN n USING (o_orderkey) UNION ALL SELECT 'changed:b', count(*) FILTER (o.b IS DISTINCT FROM n.b) FROM o JOIN n USING (o_orderkey)""")
def version_diff(spark, sf):
    """What changed between two versions of a source."""
    o = _t(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("a"), F.col("o_orderpriority").alias("b"), "o_totalprice")
    new = o.filter("a <> 'P'").withColumn("a", F.when(F.col("o_totalprice") > 200000, "X").otherwise(F.col("a")))
    return merges.version_diff(o.filter("b <> '5-LOW'"), new, "o_orderkey", ["a", "b"])


@query("WITH u AS (SELECT l_partkey, list_sort(list(DISTINCT l_returnflag)) AS s FROM lineitem GROUP BY 1) SELECT array_to_string(s, '|') AS datasets, count(*) AS n FROM u WHERE len(s) > 1 GROUP BY 1")
def uid_reuse(spark, sf):
    """Identities that several datasets share, by combination."""
    return rollups.reused(_t(spark, sf, "lineitem"), "l_partkey", "l_returnflag")


@query("SELECT p_brand, count(DISTINCT p_type) AS n FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1")
def label_ambiguity(spark, sf):
    """Codes with more than one text."""
    return rollups.ambiguous(_t(spark, sf, "part"), "p_brand", "p_type")


@query("""
WITH p AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN 'unknown' ELSE 'present' END AS status FROM customer WHERE c_acctbal >= 0),
s AS (SELECT o_custkey AS id, CASE WHEN max(o_orderstatus) = 'P' THEN 'absent' WHEN max(o_orderstatus) = 'O' THEN 'present' ELSE 'unknown' END AS status FROM orders GROUP BY 1)
SELECT coalesce(p.id, s.id) AS id, CASE WHEN p.id IS NULL THEN s.status WHEN s.id IS NOT NULL AND coalesce(p.status, 'unknown') = 'unknown' AND coalesce(s.status, 'unknown') <> 'unknown' THEN s.status ELSE p.status END AS status,
  CASE WHEN p.id IS NOT NULL AND s.id IS NOT NULL THEN 'both' WHEN p.id IS NOT NULL THEN 'primary' ELSE 'secondary' END AS origin FROM p FULL JOIN s ON p.id = s.id""")
def sample_merge(spark, sf):
    """A full outer merge in which the primary wins and only weak values are filled."""
    k = F.col("c_custkey") % 3
    p = _t(spark, sf, "customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("id"), F.when(k == 0, None).when(k == 1, "unknown").otherwise("present").alias("status"))
    top = F.max("o_orderstatus")
    s = _t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.when(top == "P", "absent").when(top == "O", "present").otherwise("unknown").alias("status"))
    return merges.merge_samples(p, s, "id", {"status": [None, "unknown"]})


@query("""
WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, CASE WHEN l_quantity > 48 THEN 'keep' ELSE 'exclude' END AS decision, CASE WHEN l_quantity > 48 THEN NULL WHEN l_quantity > 45 THEN 'x' END AS kept FROM lineitem),
g AS (SELECT l_orderkey, count(*) FILTER (decision = 'keep') AS k, max(CASE WHEN decision = 'keep' THEN l_partkey::VARCHAR END) AS one FROM d GROUP BY 1)
SELECT coalesce(CASE WHEN d.kept IS NULL AND k = 1 THEN one ELSE d.kept END, 'none') AS kept, count(*) AS n FROM d JOIN g USING (l_orderkey) GROUP BY 1""")
def kept_fill(spark, sf):
    """L2: a null kept uid takes its group's only kept row."""
    q = F.col("l_quantity")
    d = _t(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").cast("string").alias("uid"), F.when(q > 48, "keep").otherwise("exclude").alias("decision"), F.when(q > 48, None).when(q > 45, "x").alias("kept"))
    return survivors.fill_kept(d, "l_orderkey", "decision", "uid", "kept").groupBy(F.coalesce("kept", F.lit("none")).alias("kept")).agg(F.count("*").alias("n"))


@query(_ISSUES_SQL + """, b AS (SELECT l_orderkey, min(check_ord) AS o FROM i WHERE severity = 'error' AND status = 'checked' GROUP BY 1),
a AS (SELECT l_orderkey, 1 AS src, 'exclude' AS decision FROM b UNION ALL SELECT o_orderkey, 0, CASE WHEN o_orderpriority = '1-URGENT' THEN 'exclude' ELSE 'keep' END FROM orders WHERE o_orderstatus = 'O')
SELECT l_orderkey, decision, src FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY (decision = 'exclude') DESC, src) AS r FROM a) WHERE r = 1""")
def automatic_merge(spark, sf):
    """The first broken check excludes; of several sources the first counts unless a later one excludes."""
    i = _line_issues(spark, sf).withColumn("category", F.lit("machine")).withColumn("policy", F.lit("auto"))
    broken = ladders.first_broken(i, "l_orderkey", "check_ord").select("l_orderkey", F.lit(1).alias("src"), "decision")
    other = _t(spark, sf, "orders").filter("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(0).alias("src"), F.when(F.col("o_orderpriority") == "1-URGENT", "exclude").otherwise("keep").alias("decision"))
    return survivors.merged_automatic(broken.unionByName(other), "l_orderkey", "decision", "src").select("l_orderkey", "decision", "src")


@query("SELECT c_custkey FROM customer ANTI JOIN (SELECT o_custkey AS c_custkey FROM orders) USING (c_custkey)")
def orphans(spark, sf):
    """J15, J16, SC20: rows whose key the other side lacks."""
    return merges.missing_from(_t(spark, sf, "customer").select("c_custkey"), _t(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("""
WITH t AS (SELECT conv_id, turn, role FROM conversations), f AS (SELECT conv_id, min(turn) AS sibling FROM t WHERE role = 'assistant' GROUP BY 1)
SELECT conv_id, turn, sibling FROM t LEFT JOIN f USING (conv_id) WHERE role <> 'assistant'""")
def sibling_pairing(spark, sf):
    """An unannotated image with the first annotated one of its series."""
    t = _t(spark, sf, "conversations").select("conv_id", "turn", "role")
    return merges.first_sibling(t, ["conv_id"], ["turn"], F.col("role") == "assistant", "turn").select("conv_id", "turn", "sibling")


@query("""
WITH d AS (SELECT doc_id, length(text) AS size, sha256(text) AS digest FROM documents), g AS (SELECT digest, count(*) AS group_size FROM d GROUP BY 1 HAVING count(*) > 1)
SELECT doc_id, digest, group_size FROM d JOIN g USING (digest)""")
def size_block_hash(spark, sf):
    """Exact copies, hashing only what shares its size."""
    d = _t(spark, sf, "documents").select("doc_id", "text", F.length("text").alias("size"))
    return survivors.size_then_hash(d, "size", F.col("text").cast("binary"), "doc_id")


@query("SELECT e.event_type AS event_type, CAST(n0 AS BIGINT) AS before, CAST(n1 AS BIGINT) AS now, CAST(n1 - n0 AS BIGINT) AS delta FROM (SELECT event_type, count(*) FILTER (event_id % 2 = 0) AS n0, count(*) FILTER (event_id % 2 = 1) AS n1 FROM events GROUP BY 1) e")
def pending_diff(spark, sf):
    """A summary against the one before."""
    e = _t(spark, sf, "events")
    count = lambda p: e.filter(F.col("event_id") % 2 == p).groupBy("event_type").agg(F.count("*").alias("n"))
    return rollups.summary_delta(count(1), count(0), "event_type")


@query("""
WITH b AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), i AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT coalesce(b.k, i.k) AS k, CASE WHEN i.k IS NOT NULL THEN i.n ELSE b.n END AS n, b.k IS NULL AS is_new FROM b FULL JOIN i ON b.k = i.k""")
def flagged_accumulate(spark, sf):
    """Nothing is deleted, new keys are marked."""
    o = _t(spark, sf, "orders")
    side = lambda s: o.filter(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    return merges.accumulate(side("F"), side("O"), ["k"])


@query(r"""
WITH p AS (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS path FROM pages), x AS (SELECT page_id, list_filter(string_split(path, '/'), lambda x: x <> '') AS parts FROM p)
SELECT page_id, len(parts)::INT AS depth, parts[1] AS root, regexp_extract(parts[-1], '^(.+?)(\.[^.]*)?$', 1) AS stem FROM x""")
def path_parts(spark, sf):
    """Parts, root and stem of paths."""
    path = F.regexp_replace("url", "^[a-z]+://", "")
    x = _t(spark, sf, "pages").select("page_id", checks.path_parts(path).alias("parts"))
    return x.select("page_id", F.size("parts").alias("depth"), F.get("parts", F.lit(0)).alias("root"), checks.stem(F.element_at("parts", -1)).alias("stem"))


@query("""
SELECT c_custkey, count(o_orderkey) AS images, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'P') AS pending FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1""")
def case_rows(spark, sf):
    """The fact table of cases; orders are counted before the join."""
    o = _t(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("images"), F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count_if(F.col("o_orderstatus") == "P").alias("pending"))
    j = _t(spark, sf, "customer").select("c_custkey").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    return j.select("c_custkey", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("images", "done", "pending")])


@query(_ISSUES_SQL + """, v AS (SELECT unnest(['M01_DISCOUNT', 'M04_SMALL', 'M07_TAX', 'D01_RETURNED', 'S03_PRICE', 'S05_NEVER']) AS check_id)
SELECT v.check_id, count(i.check_id) AS n, count(*) FILTER (i.severity = 'error') AS errors, count(DISTINCT i.l_orderkey) AS images FROM v LEFT JOIN i USING (check_id) GROUP BY 1""")
def check_inventory(spark, sf):
    """Counts of every check, those that found nothing too."""
    names = [k for k, *_ in LINE_CHECKS] + ["S05_NEVER"]
    found = _line_issues(spark, sf).groupBy("check_id").agg(F.count("*").alias("n"), F.count_if(F.col("severity") == "error").alias("errors"), F.count_distinct("l_orderkey").alias("images"))
    v = spark.createDataFrame([(n,) for n in names], "check_id string")
    return v.join(found, "check_id", "left").select("check_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "errors", "images")])


@query("SELECT o_orderpriority, l_returnflag, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2")
def label_composition(spark, sf):
    """Labels by dataset; lines are counted by image first, so little is shuffled."""
    lines = _t(spark, sf, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.count("*").alias("c"))
    j = _t(spark, sf, "orders").select("o_orderkey", "o_orderpriority").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return j.groupBy("o_orderpriority", "l_returnflag").agg(F.sum("c").alias("n"))


@query("SELECT o_orderpriority AS code, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS excluded FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderstatus = 'F') > 0")
def lost_by_class(spark, sf):
    """Classes that lost annotations."""
    o = _t(spark, sf, "orders").select(F.col("o_orderpriority").alias("code"), F.when(F.col("o_orderstatus") == "F", "exclude").otherwise("keep").alias("decision"))
    return reports.lost_by_class(o, "code", "decision")


@query("""
SELECT coalesce(a.v, b.v) AS value, coalesce(a.n, 0) AS before, coalesce(b.n, 0) AS after
FROM (SELECT lang AS v, count(*) AS n FROM documents GROUP BY 1) a FULL JOIN (SELECT lang AS v, count(*) AS n FROM documents WHERE n_chars > 3000 GROUP BY 1) b ON a.v = b.v""")
def merge_distributions(spark, sf):
    """A distribution before and after."""
    d = _t(spark, sf, "documents").select("lang", "n_chars")
    return reports.before_and_after(d, d.filter("n_chars > 3000"), "lang")


@query("""SELECT source, printf('%d/%d (%.1f%%)', count(*) FILTER (lang = 'en'), count(*), count(*) FILTER (lang = 'en') * 100.0 / count(*)) AS english FROM documents GROUP BY 1""")
def coverage_cells(spark, sf):
    """Formatted shares by dataset."""
    return reports.coverage_cells(_t(spark, sf, "documents").select("source", "lang"), "source", {"english": F.col("lang") == "en"})


@query("""
WITH c AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) AS r FROM c)
SELECT source, string_agg(lang || ' ' || n, ', ' ORDER BY r) FILTER (r <= 2) AS top, count(*) FILTER (r > 2) AS others FROM r GROUP BY 1""")
def top_classes(spark, sf):
    """The leading classes of each dataset, and how many others."""
    return reports.top_classes(_t(spark, sf, "documents").select("source", "lang"), "source", "lang", 2)


@query("""
WITH a AS (SELECT conv_id AS g, turn AS uid, length(text) AS t FROM conversations)
SELECT x.g AS conv_id, x.uid AS uid_a, y.uid AS uid_b, y.t - x.t AS seconds, CASE WHEN x.t <> y.t THEN y.t < x.t END AS a_is_newer FROM a x JOIN a y ON x.g = y.g AND x.uid <> y.uid""")
def partner_hint(spark, sf):
    """Pairs of a group, the time between them, and which is newer."""
    c = _t(spark, sf, "conversations").select("conv_id", "turn", F.timestamp_seconds(F.length("text")).alias("t"))
    return review.partner_hint(c, "conv_id", "t", "turn").select("conv_id", "uid_a", "uid_b", "seconds", "a_is_newer")


@query("""SELECT status, count(*) AS n FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 'keep' WHEN o_orderpriority LIKE '1%' THEN 'exclude' ELSE 'pending' END AS status FROM orders) GROUP BY 1""")
def effective_status(spark, sf):
    """The status by a field, else by a tag, else the default."""
    o = _t(spark, sf, "orders")
    field = F.when(F.col("o_orderstatus") == "F", "keep")
    tags = F.array(F.lit("other"), F.when(F.col("o_orderpriority").startswith("1"), "review:exclude").otherwise("review:later"))
    return o.select(review.effective_status(field, tags).alias("status")).groupBy("status").agg(F.count("*").alias("n"))
