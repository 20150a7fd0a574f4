"""Nested fields, gates, trees, near images, sinks and small reports as queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica import ids
from adjudica.functions import raster, samples, variants
from adjudica.operators import gates, ladders, merges, near_images, reports, review
from adjudica.plans.measured import _LINES, _lines
from adjudica.plans.queries import _t, query
from adjudica.schema import SOURCE_DDL
from adjudica.sources import artifacts, nested
from adjudica.storage import scratch_path, written
from adjudica.streaming import review_store


def _documents(spark, sf) -> DataFrame:
    """A source document for each customer: labels of the study and the series, a report or none, and one image with labels of its own."""
    c = F.col("c_custkey")
    label = lambda code, n: F.struct(F.lit("Findings").alias("code_system"), code.cast("string").alias("code"), F.concat(F.lit("x"), code.cast("string")).alias("code_text_eng"), n.cast("long").alias("label_id"))
    case = lambda n, code: F.transform(F.sequence(F.lit(1), n), lambda k: F.struct(k.cast("long").alias("annotation_id"), F.array(label(code, k), label(code % 2, k)).alias("labels")))
    none = lambda value, n: F.when(n > 0, value)
    report = F.when(c % 4 == 1, F.struct(F.lit("present").alias("pneumothorax_status"), F.array(F.lit("x"), F.lit("hemothorax"), F.lit("pleural_effusion")).alias("finding_labels_observed"))).when(
        c % 4 == 2, F.struct(F.lit("").alias("pneumothorax_status"), F.array(F.lit("pleural_effusion")).alias("finding_labels_observed"))).when(c % 4 == 3, F.struct(F.lit("absent").alias("pneumothorax_status"), F.lit(None).cast("array<string>").alias("finding_labels_observed")))
    own = F.array(label(c % 5, c), label(c % 5, c + 1), label(c % 3, c))
    image = F.struct(F.array(F.struct(F.lit("brush").alias("annotation_type"), F.concat(F.lit("g"), c.cast("string")).alias("geometry_uid"), own.alias("labels"))).alias("annotations"))
    series = F.struct(none(case(c % 2, c % 7), c % 2).alias("annotations"), F.create_map(F.lit("f"), image).alias("file_list"))
    study = F.struct(c.cast("string").alias("patient_id"), none(case(c % 3, c % 4), c % 3).alias("annotations"), report.alias("report_labels"), F.create_map(F.lit("e"), series).alias("series_list"))
    value = F.to_json(F.struct(F.create_map(F.lit("I"), F.create_map(c.cast("string"), study)).alias("dataset")))
    documents = _t(spark, sf, "customer").select("c_custkey").repartition("c_custkey").select(F.concat(F.lit("engineer-set-D"), (c % 3).cast("string"), F.lit("-20260102_030405.json")).alias("source_json"), value.alias("value"))
    # written out, as conditions on parsed documents would parse them again each
    return written(documents.select("source_json", F.from_json("value", SOURCE_DDL).alias("doc")), "source-documents")


@query("""
WITH d AS (SELECT c_custkey AS c FROM customer)
SELECT CAST(c AS VARCHAR) AS patient, 'D' || (c % 3) AS dataset_id,
  CAST(len(list_distinct(list_concat(flatten(list_transform(range(1, c % 3 + 1), lambda k: [k * 10 + c % 4, k * 10 + c % 4 % 2])), flatten(list_transform(range(1, c % 2 + 1), lambda k: [k * 10 + c % 7, k * 10 + c % 7 % 2]))))) AS INT) AS n_case_labels,
  CASE c % 4 WHEN 1 THEN 'present' WHEN 2 THEN 'unknown' WHEN 3 THEN 'absent' END AS status, CASE c % 4 WHEN 1 THEN 'pleural_effusion|hemothorax' WHEN 2 THEN 'pleural_effusion' WHEN 3 THEN '' END AS findings,
  CASE c % 4 WHEN 1 THEN 3 WHEN 2 THEN 1 WHEN 3 THEN 0 END AS observed, CAST(len(list_distinct([c % 5, c % 3])) AS INT) AS n_labels FROM d""")
def nested_fields(spark, sf):
    """SC5, SC7, SC8, P2, S27: labels of cases, reports that are there, empty or missing, and labels of annotations without repeats."""
    found = nested.annotations(nested.images(_documents(spark, sf)), also=("case_labels", "report"))
    return found.select(
        F.col("patient_id").alias("patient"), "dataset_id", F.size(F.filter("case_labels", lambda x: x["code"].isNotNull())).alias("n_case_labels"), F.col("report.pneumothorax_status").alias("status"),
        F.array_join("report.pleural_effusion_findings", "|").alias("findings"), F.col("report.observed_finding_count").cast("int").alias("observed"), F.size("labels").alias("n_labels"),
    )


@query("SELECT CAST(sum(c_custkey % 3 + c_custkey % 2) AS BIGINT) AS n FROM customer")
def geometry_free(spark, sf):
    """SC6: annotations of studies and series, which have no geometry."""
    return nested.geometry_free_count(_documents(spark, sf))


@query("""
WITH w AS (SELECT o_orderkey, CAST(o_custkey % 50 AS VARCHAR) AS folder, strftime(o_orderdate, '%Y%m') AS day FROM orders),
f AS (SELECT CAST(c_custkey % 50 AS VARCHAR) AS folder, strftime(DATE '1993-01-01' + CAST(c_custkey % 2000 AS INT), '%Y%m') AS day, c_custkey % 3 = 0 AS odd FROM customer),
b AS (SELECT folder, day, bool_or(NOT odd) AS exact FROM f GROUP BY ALL)
SELECT CASE WHEN exact THEN 'exact' WHEN exact IS NOT NULL THEN 'sibling' ELSE 'none' END AS found, count(*) AS n FROM w LEFT JOIN b ON w.folder = b.folder AND w.day = b.day GROUP BY 1""")
def probed_folders(spark, sf):
    """Reference masks by the folder of a date, or of one that begins with it."""
    wanted = _t(spark, sf, "orders").select((F.col("o_custkey") % 50).cast("string").alias("folder"), F.date_format("o_orderdate", "yyyyMM").alias("day"))
    c = F.col("c_custkey")
    day = F.date_format(F.date_add(F.lit("1993-01-01").cast("date"), (c % 2000).cast("int")), "yyyyMM")
    files = _t(spark, sf, "customer").select((c % 50).cast("string").alias("folder"), F.concat(day, F.when(c % 3 == 0, F.concat(F.lit("_"), c.cast("string"))).otherwise(""), F.lit("/m.png")).alias("path"))
    return merges.probe_paths(wanted, files, "folder", "day", "path").groupBy("found").agg(F.count("*").alias("n"))


@query("""
WITH d AS (SELECT o_orderkey AS k, nullif(CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'c' || o_custkey % 5 END, '') AS patient, nullif(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END, '') AS study, o_custkey FROM orders),
j AS (SELECT d.*, 'c' || c_custkey % 7 AS lp, c_mktsegment AS ls FROM d LEFT JOIN customer ON c_custkey = o_custkey)
SELECT k, coalesce(patient, lp) AS patient, coalesce(study, ls) AS study, CAST((patient IS NOT NULL AND lp IS NOT NULL AND patient <> lp)::INT + (study IS NOT NULL AND ls IS NOT NULL AND study <> ls)::INT AS INT) AS n_mismatches FROM j""")
def filled_cells(spark, sf):
    """Blank cells filled from another table by its key, and cells that say something else."""
    o, key = _t(spark, sf, "orders"), F.col("o_orderkey")
    df = o.select(key.alias("k"), F.col("o_custkey").alias("key"), F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("c"), (F.col("o_custkey") % 5).cast("string"))).alias("patient"), F.when(key % 4 != 0, F.col("o_orderpriority")).alias("study"))
    lookup = _t(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.concat(F.lit("c"), (F.col("c_custkey") % 7).cast("string")).alias("patient"), F.col("c_mktsegment").alias("study"))
    return merges.filled(df, lookup, "key", ["patient", "study"]).select("k", "patient", "study", F.size("mismatches").alias("n_mismatches"))


@query("""
SELECT n_nationkey AS nation, count(*) AS files, count_if(k % 3 = 0) AS available, CAST(sum(n) AS BIGINT) AS annotations, CAST(coalesce(sum(CASE WHEN k % 3 = 0 THEN n END), 0) AS BIGINT) AS covered
FROM (SELECT c_nationkey AS n_nationkey, o_orderkey AS k, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2) GROUP BY 1""")
def reference_coverage(spark, sf):
    """A10: files with masks, those with references, and the annotations of both, by dataset."""
    lines = _t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_annotations"))
    o = _t(spark, sf, "orders").join(_t(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    files = o.select(F.col("c_nationkey").alias("nation"), F.coalesce("n_annotations", F.lit(0)).alias("n_masks"), F.coalesce("n_annotations", F.lit(0)).alias("n_annotations"), F.when(F.col("o_orderkey") % 3 == 0, "available").otherwise("cannot_determine:no_reference").alias("reference_status"))
    return reports.reference_coverage(files, "nation")


@query("""
WITH v AS (
  SELECT 'annotation' AS kind, 'd' || o_custkey % 4 AS dataset_id, CAST(o_custkey % 400 AS VARCHAR) AS key, o_orderkey % 3 AS store, CASE WHEN o_custkey % 2 = 0 THEN 'keep' ELSE 'exclude' END AS decision, o_orderkey AS stamp FROM orders),
o AS (SELECT kind, dataset_id, key, decision, max(stamp) AS stamp FROM v GROUP BY ALL)
SELECT kind, dataset_id, key, decision, CAST(stamp AS VARCHAR) AS reviewed_at FROM o""")
def folded_stores(spark, sf):
    """Three stores of verdicts folded in order; equal verdicts take the newer stamp."""
    o = _t(spark, sf, "orders")
    row = o.select(F.lit("annotation").alias("kind"), F.concat(F.lit("d"), (F.col("o_custkey") % 4).cast("string")).alias("dataset_id"), (F.col("o_custkey") % 400).cast("string").alias("key"), F.when(F.col("o_custkey") % 2 == 0, "keep").otherwise("exclude").alias("decision"), F.col("o_orderkey").alias("stamp"), (F.col("o_orderkey") % 3).alias("store"))
    one = row.groupBy("store", "kind", "dataset_id", "key", "decision").agg(F.max("stamp").alias("stamp"))
    keys = ["kind", "dataset_id", "key"]
    stores = [one.filter(F.col("store") == k).select(*keys, "decision", F.lpad(F.col("stamp").cast("string"), 12, "0").alias("reviewed_at")) for k in range(3)]
    return merges.fold_stores(stores, keys, "decision", "reviewed_at").withColumn("reviewed_at", F.col("reviewed_at").cast("long").cast("string"))


@query("""
WITH e AS (SELECT event_id, event_type, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
s AS (SELECT CASE event_id % 5 WHEN 0 THEN 'missing' WHEN 1 THEN 'null' WHEN 2 THEN 'empty' WHEN 3 THEN 'empty' ELSE 'value' END AS state, event_type FROM e)
SELECT state, event_type, count(*) AS n FROM s GROUP BY ALL""")
def tree_states(spark, sf):
    """Values that are missing, null, empty texts, empty lists, or something, told apart in documents of any shape."""
    e, at = _t(spark, sf, "events"), F.col("event_id") % 5
    text = F.when(at == 0, "{}").when(at == 1, '{"x": null}').when(at == 2, '{"x": ""}').when(at == 3, '{"x": []}').otherwise(F.concat(F.lit('{"x": '), F.col("event_id").cast("string"), F.lit("}")))
    v = e.select("event_type", F.try_variant_get(F.parse_json(text), "$.x", "variant").alias("v"))
    return v.groupBy(variants.state(F.col("v")).alias("state"), "event_type").agg(F.count("*").alias("n"))


def _trees(spark, sf) -> tuple[DataFrame, DataFrame]:
    e, k = _t(spark, sf, "events"), F.col("event_id")
    number = lambda c: c.cast("string")
    before = F.concat(F.lit('{"a": {"b": ['), number(k % 3), F.lit(", {\"c\": "), number(k % 5), F.lit('}], "d": "x"}, "e": '), F.when(k % 2 == 0, "null").otherwise("1"), F.lit("}"))
    after = F.concat(F.lit('{"a": {"b": ['), number(k % 3), F.lit(", {\"c\": "), number(k % 4), F.lit("}"), F.when(k % 7 == 0, ", 9").otherwise(""), F.lit(']}, "e": '), F.when(k % 3 == 0, "null").otherwise("1"), F.lit("}"))
    return e.select(k.alias("id"), F.parse_json(before).alias("tree")), e.select(k.alias("id"), F.parse_json(after).alias("tree"))


@query("""
WITH k AS (SELECT event_id AS k FROM events), d AS (
  SELECT '.a.b[1].c' AS path, k FROM k WHERE k % 5 <> k % 4 UNION ALL SELECT '.a.b[2]', k FROM k WHERE k % 7 = 0 UNION ALL SELECT '.a.d', k FROM k UNION ALL SELECT '.e', k FROM k WHERE (k % 2 = 0) <> (k % 3 = 0))
SELECT CASE WHEN path = '.a.b[1].c' THEN '."a"."b"[1]."c"' WHEN path = '.a.b[2]' THEN '."a"."b"[2]' WHEN path = '.a.d' THEN '."a"."d"' ELSE '."e"' END AS path,
  CASE path WHEN '.a.b[2]' THEN 'right' WHEN '.a.d' THEN 'left' ELSE 'both' END AS side, count(*) AS n FROM d GROUP BY ALL""")
def tree_differences(spark, sf):
    """Leaves that two versions of a document don't share, at any depth, with missing and null apart."""
    left, right = _trees(spark, sf)
    found = variants.differences(left, right, ["id"], "tree")
    side = F.when(F.col("left").isNull(), "right").when(F.col("right").isNull(), "left").otherwise("both")
    return found.groupBy("path", side.alias("side")).agg(F.count("*").alias("n"))


@query("""
WITH k AS (SELECT event_id AS k FROM events)
SELECT count(*) * 4 + count_if(k % 7 = 0) AS leaves, count_if(k % 5 <> k % 4) + count_if((k % 2 = 0) <> (k % 3 = 0)) AS conflicts FROM k""")
def tree_merges(spark, sf):
    """Two versions of a document merged leaf by leaf: what one lacks is taken, what differs is a conflict."""
    left, right = _trees(spark, sf)
    m = variants.merged(left, right, ["id"], "tree")
    return m.agg(F.count("*").alias("leaves"), F.count_if("conflict").alias("conflicts"))


@query(_LINES + """, g AS (SELECT count(*) AS total, count_if(d = 10) AS pending, count_if(t = 8) AS uncertain, count_if(q = 1) AS unmeasured FROM a)
SELECT 'pending' AS gate, pending AS n, pending > 0 AS stops, 0 AS visible_rows FROM g UNION ALL SELECT 'uncertain', uncertain, false, total FROM g UNION ALL SELECT 'unmeasured', unmeasured, false, total FROM g""")
def gated_writes(spark, sf):
    """Gates counted in the pass that writes: a failed one leaves no visible version, an allowed one does."""
    a = _lines(spark, sf)
    rules = {"pending": F.col("d") == 10, "uncertain": F.col("t") == 8, "unmeasured": F.col("q") == 1}
    store, out = scratch_path(spark, "gated"), []
    stops, counts = False, {}
    try:
        gates.write_gated(a, store, [gates.Gate(k, gates.count_of(c), allowed=k != "pending") for k, c in rules.items()])
    except gates.GateError as e:
        stops, counts = "pending" in e.failed, e.failed
    hidden = gates.read_visible(spark, store)
    out.append(("pending", counts.get("pending", 0), stops, hidden.count() if hidden is not None else 0))
    counts = gates.write_gated(a, store, [gates.Gate(k, gates.count_of(c), allowed=True) for k, c in rules.items()])
    shown = gates.read_visible(spark, store).count()
    out += [(k, counts[k], False, shown) for k in ("uncertain", "unmeasured")]
    return spark.createDataFrame(out, "gate string, n long, stops boolean, visible_rows long")


@query("""
WITH p AS (SELECT o_orderkey AS o, y, x, (o_custkey * (y * 9 + x + 1) + (o_custkey % 17) * y * x) % 251 AS v FROM orders, range(0, 8) r(y), range(0, 9) c(x)),
b AS (SELECT a.o, a.y * 8 + a.x AS place, b.v > a.v AS bit FROM p a JOIN p b ON a.o = b.o AND a.y = b.y AND b.x = a.x + 1)
SELECT o, string_agg(CASE WHEN bit THEN '1' ELSE '0' END, '' ORDER BY place) AS bits FROM b GROUP BY o""")
def image_hashes(spark, sf):
    """Difference hashes of images: whether a cell is brighter than its left neighbour."""
    return _hashed(spark, sf, with_thumbs=False).select("o", F.lpad(F.conv(F.hex("digest"), 16, 2), 64, "0").alias("bits"))


def _hashed(spark, sf, with_thumbs: bool = True) -> DataFrame:
    """o, digest and, where it is wanted, thumb: the hash of an image of 8 x 9 cells that an order's numbers make, by way of a PNG."""
    import numpy as np
    import pyarrow as pa

    def drawn(stream):
        y, x = np.ogrid[:8, :9]
        for batch in stream:
            digests, thumbs = [], []
            for c in batch.column("c").to_pylist():
                image = raster.read_png(raster.write_png(((c * (y * 9 + x + 1) + (c % 17) * y * x) % 251).astype(np.uint8)))
                digests.append(bytes.fromhex(raster.difference_hash(image)))
                thumbs.append(raster.thumbnail(image, 8) if with_thumbs else None)
            yield pa.RecordBatch.from_arrays([batch.column("o"), pa.array(digests, pa.binary()), pa.array(thumbs, pa.list_(pa.float64()))], names=["o", "digest", "thumb"])

    return _t(spark, sf, "orders").select(F.col("o_orderkey").cast("long").alias("o"), F.col("o_custkey").cast("long").alias("c")).mapInArrow(drawn, "o long, digest binary, thumb array<double>")


@query("""
WITH h AS (SELECT DISTINCT ('0x' || substr(md5(CAST(o_custkey % 900 AS VARCHAR)), 1, 12))::BIGINT * 8 + o_custkey % 8 + CASE WHEN o_custkey % 5 = 0 THEN 1099511627776 ELSE 0 END AS h FROM orders)
SELECT a.h AS a, b.h AS b FROM h a JOIN h b ON a.h < b.h AND bit_count(xor(a.h, b.h)) <= 3""")
def near_hash_pairs(spark, sf):
    """All pairs of hashes that differ in three bits or fewer, by multi-index hashing, against all pairs."""
    c = F.col("o_custkey")
    base = F.conv(F.substring(F.md5((c % 900).cast("string").cast("binary")), 1, 12), 16, 10).cast("long")
    hashes = _t(spark, sf, "orders").select((base * 8 + c % 8 + F.when(c % 5 == 0, 1099511627776).otherwise(0)).alias("hash"))
    return near_images.near_hashes(hashes, 3)


@query("""
WITH s AS (SELECT o_orderkey AS sample_id, list_sort(list_distinct(list('m' || l_suppkey % 4))) AS sources FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber > 2 GROUP BY 1)
SELECT sample_id, array_to_string(sources, '|') AS sources, len(sources) > 1 AS merged FROM s""")
def mask_sources(spark, sf):
    """SK11: samples with masks, and whether several sources make theirs."""
    lines = _t(spark, sf, "lineitem").withColumn("source", F.when(F.col("l_linenumber") > 2, F.concat(F.lit("m"), (F.col("l_suppkey") % 4).cast("string"))))
    some = lines.groupBy(F.col("l_orderkey").alias("sample_id")).agg(F.array_sort(F.collect_set("source")).alias("mask_sources")).join(_t(spark, sf, "orders").select(F.col("o_orderkey").alias("sample_id")), "sample_id", "left_semi")
    return artifacts.mask_manifest(some).select("sample_id", F.array_join("mask_sources", "|").alias("sources"), "merged")


@query(_LINES + """, i AS (SELECT CASE WHEN n % 2 = 0 THEN 'S03_TINY' ELSE 'D01_EXACT' END AS check_id, ds AS dataset_id, o || '-' || n AS geometry_uid, CASE WHEN d > 5 THEN p || '|' || s ELSE '' END AS related, CASE WHEN t = 0 THEN '' ELSE 'm' || t END AS message FROM a)
SELECT check_id, dataset_id, geometry_uid, related AS related_geometry_uids, message, '{"a":"1","b":"' || substr(geometry_uid, 1, 1) || '"}' AS detail, '' AS image_path FROM i""")
def issue_rows(spark, sf):
    """SK2, S23: issues as flat rows of fixed columns: lists joined, details as JSON with sorted keys, blanks for what is missing; written and read back."""
    a = _lines(spark, sf)
    uid = F.concat_ws("-", "o", "n")
    issues = a.select(
        F.when(F.col("n") % 2 == 0, "S03_TINY").otherwise("D01_EXACT").alias("check_id"), F.col("ds").alias("dataset_id"), uid.alias("geometry_uid"),
        F.when(F.col("d") > 5, F.array(F.col("p").cast("string"), F.col("s").cast("string"))).alias("related_geometry_uids"), F.when(F.col("t") != 0, F.concat(F.lit("m"), F.col("t").cast("string"))).alias("message"),
        F.create_map(F.lit("b"), F.substring(uid, 1, 1), F.lit("a"), F.lit("1")).alias("detail"),
    )
    path = scratch_path(spark, "issues")
    artifacts.write_issues(issues, path, "gzip")
    read = spark.read.schema(", ".join(f"{c} string" for c in artifacts.ISSUE_COLUMNS)).json(f"{path}/json")
    return read.select("check_id", "dataset_id", "geometry_uid", "related_geometry_uids", "message", "detail", "image_path")


@query("""
WITH t AS (SELECT o_orderkey AS k, list_distinct(['t' || o_custkey % 3, 'u' || o_custkey % 4]) AS tags, CASE o_custkey % 3 WHEN 0 THEN 'keep' WHEN 1 THEN 'pending' ELSE 'exclude' END AS status, CASE WHEN o_orderkey % 2 = 0 THEN 'image' ELSE 'annotation' END AS kind FROM orders)
SELECT 'status' AS what, kind || '/' || status AS name, count(*) AS n FROM t GROUP BY ALL UNION ALL SELECT 'tag', tag, count(*) FROM (SELECT unnest(tags) AS tag FROM t) GROUP BY ALL""")
def review_counts(spark, sf):
    """Review items by kind and status, and their tags."""
    c = F.col("o_custkey")
    items = _t(spark, sf, "orders").select(F.array(F.concat(F.lit("t"), (c % 3).cast("string")), F.concat(F.lit("u"), (c % 4).cast("string"))).alias("tags"), F.when(c % 3 == 0, "keep").when(c % 3 == 1, "pending").otherwise("exclude").alias("status"), F.when(F.col("o_orderkey") % 2 == 0, "image").otherwise("annotation").alias("kind"))
    by_status = review.review_status(items).select(F.lit("status").alias("what"), F.concat_ws("/", "kind", "status").alias("name"), "n")
    return by_status.unionByName(review.tag_counts(items).select(F.lit("tag").alias("what"), F.col("tag").alias("name"), "n"))


@query("""
WITH l AS (SELECT l_orderkey AS o, list_sort(list_distinct(list('F/' || l_partkey % 4) FILTER (l_linenumber % 2 = 0))) AS a, list_sort(list_distinct(list('F/' || l_partkey % 4) FILTER (l_linenumber % 2 = 1))) AS b FROM lineitem GROUP BY 1)
SELECT o, coalesce(len(a), 0) AS n_a, coalesce(a, []) = coalesce(b, []) AS same FROM l""")
def label_sets(spark, sf):
    """Sets of labels that are equal whatever their order and repeats."""
    label = F.struct(F.lit("F").alias("code_system"), (F.col("l_partkey") % 4).cast("string").alias("code"))
    sides = _t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o")).agg(F.collect_list(F.when(F.col("l_linenumber") % 2 == 0, label)).alias("a"), F.collect_list(F.when(F.col("l_linenumber") % 2 == 1, label)).alias("b"))
    a, b = ids.label_keys(F.col("a")), ids.label_keys(F.col("b"))
    return sides.select("o", F.size(a).cast("long").alias("n_a"), (a == b).alias("same"))


@query("""
WITH g AS (SELECT o_orderkey AS o, 'd' || o_custkey % 3 AS dataset_id, CASE o_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'present' WHEN 2 THEN 'absent' ELSE 'unknown' END AS s FROM orders),
c AS (SELECT o FROM g WHERE dataset_id IN ('d0', 'd2') AND s IN ('present', 'absent') ORDER BY lpad(CAST(o AS VARCHAR), 10, '0') LIMIT 500)
SELECT 'chosen' AS what, count(*) AS n, sum(o)::BIGINT AS total FROM c UNION ALL SELECT coalesce(s, 'no_report'), count(*), 0 FROM g WHERE dataset_id IN ('d0', 'd2') AND coalesce(s, '') NOT IN ('present', 'absent') GROUP BY s""")
def export_choice(spark, sf):
    """images chosen for an export by dataset and report, up to a limit in the order of their names; the dropped ones by status."""
    c, key = F.col("o_custkey"), F.col("o_orderkey")
    status = F.when(c % 4 == 1, "present").when(c % 4 == 2, "absent").when(c % 4 == 3, "unknown")
    images = _t(spark, sf, "orders").select(key.alias("o"), F.lpad(key.cast("string"), 10, "0").alias("file_uid"), F.concat(F.lit("d"), (c % 3).cast("string")).alias("dataset_id"), F.when(status.isNotNull(), F.struct(status.alias("pneumothorax_status"))).alias("report"))
    chosen, dropped = samples.export_groups(images, ["d0", "d2"], ["present", "absent"], 500)
    total = chosen.agg(F.count("*").alias("n"), F.sum("o").alias("total")).select(F.lit("chosen").alias("what"), "n", "total")
    return total.unionByName(dropped.select(F.col("status").alias("what"), "n", F.lit(0).cast("long").alias("total")))


@query("""
SELECT o_orderkey % 40 AS n, o_orderkey % 2 = 0 AS allow, o_orderkey % 3 = 0 AS told, o_orderkey % 40 > 0 AND NOT (o_orderkey % 2 = 0 AND o_orderkey % 3 = 0) AS stops, count(*) AS n_rows FROM orders GROUP BY ALL""")
def open_gates(spark, sf):
    """Open rows stop a build unless they are allowed and told what they count as."""
    key = F.col("o_orderkey")
    df = _t(spark, sf, "orders").select((key % 40).alias("n"), (key % 2 == 0).alias("allow"), (key % 3 == 0).alias("told"))
    message = ladders.gate_column(F.col("n"), "images are pending", F.col("allow"), F.col("told"))
    return df.groupBy("n", "allow", "told", message.isNotNull().alias("stops")).agg(F.count("*").alias("n_rows"))


@query("""
WITH RECURSIVE e AS (SELECT user_id AS u, event_id AS id, ts, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id % 4 + 1 AS f FROM events WHERE user_id IS NOT NULL),
x AS (SELECT u, row_number() OVER (PARTITION BY u ORDER BY ts, CAST(id AS VARCHAR)) AS n, k, f, 'r' || id % 3 AS who, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS told,
 CASE f WHEN 1 THEN ['keep', 'exclude', 'uncertain'][k % 3 + 1] WHEN 2 THEN ['frontal_view', 'wrong_label', 'frontal_view|wrong_label'][k % 3 + 1] WHEN 3 THEN 'c' || k % 5 WHEN 4 THEN ['tag+', 'tag-'][k % 2 + 1] END AS val FROM e),
s AS (
 SELECT DISTINCT u, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS version, CAST([0, 0, 0, 0] AS BIGINT[]) AS vers, ['', '', '', ''] AS whos, ['', '', '', ''] AS vals, '' AS reviewer, '' AS told, CAST(0 AS BIGINT) AS conflicts FROM x
 UNION ALL
 SELECT u, n, version + ok, CASE WHEN ok = 1 THEN [CASE WHEN i = f THEN version + 1 ELSE vers[i] END FOR i IN [1, 2, 3, 4]] ELSE vers END, CASE WHEN ok = 1 THEN [CASE WHEN i = f THEN who ELSE whos[i] END FOR i IN [1, 2, 3, 4]] ELSE whos END,
  CASE WHEN ok = 1 THEN [CASE WHEN i = f THEN val ELSE vals[i] END FOR i IN [1, 2, 3, 4]] ELSE vals END, CASE WHEN ok = 1 AND f < 4 THEN who ELSE reviewer END, CASE WHEN ok = 1 AND f < 4 THEN told ELSE old_told END, conflicts + 1 - ok
 FROM (SELECT s.u, x.n, version, vers, whos, vals, reviewer, s.told AS old_told, conflicts, x.f, x.who, x.val, x.told, CASE WHEN vers[x.f] > x.k AND whos[x.f] <> x.who AND vals[x.f] <> x.val THEN 0 ELSE 1 END AS ok FROM s JOIN x ON x.u = s.u AND x.n = s.n + 1)),
l AS (SELECT s.* FROM s JOIN (SELECT u, max(n) AS n FROM x GROUP BY 1) m USING (u, n)),
h AS (SELECT min(epoch_us(ts)) + (max(epoch_us(ts)) - min(epoch_us(ts))) // 2 AS mid FROM events),
r AS (SELECT u, count_if(epoch_us(ts) <= mid AND id % 10 = 0) AS repeated FROM e, h GROUP BY 1),
b AS (SELECT *, ['pending', 'keep', 'exclude', 'pending'][u % 4 + 1] AS baseline FROM l JOIN r USING (u)),
c AS (SELECT *, CASE WHEN vals[1] = '' THEN baseline ELSE vals[1] END AS now FROM b),
d AS (SELECT *, now <> 'pending' AND (reviewer <> '' OR now <> baseline) AS said FROM c)
SELECT CASE WHEN u % 5 = 0 THEN 'image' ELSE 'annotation' END AS kind, 'd' || u % 3 AS dataset_id, CAST(u AS VARCHAR) AS key, version AS applied, conflicts, repeated, vals[4] = 'tag+' AS to_report,
 CASE WHEN said THEN now ELSE baseline END AS status, CASE WHEN said THEN vals[2] ELSE '' END AS reasons, CASE WHEN said THEN vals[3] ELSE '' END AS comment, CASE WHEN said THEN reviewer ELSE '' END AS reviewer, CASE WHEN said THEN told ELSE '' END AS reviewed_at FROM d""")
def review_round_trip(spark, sf):
    """SK16: a store built for the users of events, each event an edit that saw some version. The stream stops after a half and goes on
    from its checkpoint with the rest and some of the first edits again; verdicts are exported and imported into a store built anew."""
    e = _t(spark, sf, "events").filter("user_id is not null")
    u, n, k = F.col("user_id"), F.col("event_id"), F.get_json_object("props", "$.k").cast("long")
    who = [F.when(u % 5 == 0, "image").otherwise("annotation").alias("kind"), F.concat(F.lit("d"), u % 3).alias("dataset_id"), u.cast("string").alias("key")]
    one = lambda at, *values: F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))
    blank = [F.lit("").alias(c) for c in ("review_reasons", "review_reason", "reviewer", "reviewed_at")]
    manifest = e.select("user_id").distinct().select(*who, one(u % 4, "pending", "keep", "exclude", "pending").alias("review_status"), *blank, F.array(F.lit("auto:s03_tiny_annotation")).alias("auto_tags"), F.lit(False).alias("spot_check"))
    field = one(n % 4, "status", "reasons", "comment", "tag")
    value = F.when(n % 4 == 0, one(k % 3, "keep", "exclude", "uncertain")).when(n % 4 == 1, one(k % 3, "frontal_view", "wrong_label", "frontal_view|wrong_label")).when(n % 4 == 2, F.concat(F.lit("c"), k % 5)).otherwise("flag:needs_report")
    edits = e.select(*who, n.cast("string").alias("edit_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"), F.concat(F.lit("r"), n % 3).alias("reviewer"), k.alias("base"),
                     F.when(n % 4 == 3, one(k % 2, "tag+", "tag-")).otherwise(field).alias("field"), value.alias("value"), F.unix_micros(F.col("ts").cast("timestamp")).alias("_us"), (n % 10 == 0).alias("_twice"))
    ends = _t(spark, sf, "events").agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
    mid = F.lit((ends[0] or 0) + ((ends[1] or 0) - (ends[0] or 0)) // 2)
    items = written(review_store.built(manifest), "items")
    place = scratch_path(spark, "review")
    for part in (F.col("_us") <= mid, (F.col("_us") > mid) | F.col("_twice")):
        edits.filter(part).drop("_us", "_twice").write.mode("append").json(f"{place}/in")
        review_store.edit_stream(items, f"{place}/in", f"{place}/history", f"{place}/checkpoint").awaitTermination()
    history = spark.read.schema(review_store.HISTORY_DDL).parquet(f"{place}/history")
    after = review_store.edited(items, history)
    again = review_store.imported(review_store.built(manifest), review_store.exported(after))
    keys = review_store.KEYS
    told = history.groupBy(*keys).agg(*[F.count_if(F.col("outcome") == o).alias(c) for o, c in (("applied", "applied"), ("conflict", "conflicts"), ("repeated", "repeated"))])
    report = review_store.flagged(after).select(*keys, F.lit(True).alias("_r"))
    return again.join(told, keys).join(report, keys, "left").select(*keys, "applied", "conflicts", "repeated", F.coalesce("_r", F.lit(False)).alias("to_report"), "status", "reasons", "comment", "reviewer", "reviewed_at")
