"""Caches, verdict stores, samples, rules and CSV tables: readers (SC10–SC20) and writers (SK1–SK11)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.schema import VERDICT_DDL


def read_cache(spark: SparkSession, path: str, schema: str, files: DataFrame | None = None) -> DataFrame:
    """Lines of a cache; malformed ones are skipped, and rows of files that are not complete are orphans (SC10)."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return rows.join(files.select("file_uid"), "file_uid", "left_semi") if files is not None else rows


def pending(groups: DataFrame, done: DataFrame, key: str = "file_uid", limit: int | None = None) -> DataFrame:
    """What a resumed scan still has to do (SC20), or the first `limit` of it by key."""
    left = groups.join(done.select(key), key, "left_anti")
    return left.orderBy(key).limit(limit) if limit is not None else left


def blank_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """SC11."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in columns})


def null_to_blank(df: DataFrame) -> DataFrame:
    """SK3, SK4."""
    return df.na.fill("")


def read_verdicts(spark: SparkSession, path: str, version: int = 2) -> DataFrame:
    """A verdict store (SC12). Of version 1, image rows name a file by its uid in a run: its dataset and key are taken
    from that, and rows of which they can't be are left out."""
    rows = spark.read.schema(VERDICT_DDL + ", file_uid STRING").option("multiLine", True).json(path)
    if version == 1:
        from adjudica.ids import dataset_of

        source, rest = F.split("file_uid", "::", 2)[0], F.get(F.split("file_uid", "::", 2), F.lit(1))
        image = F.col("kind") == "image"
        dataset = F.when(image, dataset_of(source)).otherwise(F.col("dataset_id"))
        rows = rows.withColumn("legacy_file_uid", F.col("file_uid")).withColumn("key", F.when(image, rest).otherwise(F.col("key"))).withColumn("dataset_id", dataset)
    return rows.filter("dataset_id is not null and key is not null").drop("file_uid")


def read_samples(spark: SparkSession, path: str, sample_ddl: str) -> DataFrame:
    """sample_id and the sample's columns of a dataset file: a map of samples under a dataset header (SC13)."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", f"meta STRUCT<content_type: STRING>, samples MAP<STRING, STRUCT<{sample_ddl}>>").alias("d"))
    checked = raw.filter(F.when(F.coalesce(F.col("d.meta.content_type"), F.lit("")) == "dataset", True).otherwise(F.raise_error(F.lit("no dataset")).cast("boolean")))
    return checked.select(F.explode("d.samples").alias("sample_id", "s")).select("sample_id", "s.*")


def read_sample_lines(spark: SparkSession, path: str, sample_ddl: str) -> DataFrame:
    """read_samples() of a folder by export.write_dataset(), line by line, so that no task holds the document (SC13)."""
    lines = spark.read.text(path).filter(F.col("value").startswith('"'))
    whole = F.concat(F.lit("{"), F.regexp_replace("value", ",$", ""), F.lit("}"))
    read = lines.select(F.explode(F.from_json(whole, f"MAP<STRING, STRUCT<{sample_ddl}>>")).alias("sample_id", "s"))
    return read.select("sample_id", "s.*")


def read_rules(path: str | None) -> list[dict]:
    """Override rules; none without a file. A scalar is a list of one, null a wildcard (SC15)."""
    if not path:
        return []
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    return [{k: v if k in ("id", "action", "note") or v is None or isinstance(v, list) else [v] for k, v in r.items()} for r in rules]


def read_template(path: str) -> dict[str, dict]:
    """The structure of a template, YAML or JSON; one that is broken or empty is an error (SC14).

    JSON is read as such; YAML needs the package yaml, which nothing else does.
    """
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith((".yaml", ".yml")):
        import yaml

        try:
            found = yaml.safe_load(text)
        except yaml.YAMLError as error:
            raise ValueError("the template is no YAML") from error
    else:
        found = json.loads(text)
    meta = found.get("meta") if isinstance(found, dict) else None
    structure = meta.get("structure") if isinstance(meta, dict) else None
    if not isinstance(structure, dict) or not structure:
        raise ValueError("the template has no structure")
    return structure


def multiple_fields(structure: dict[str, dict]) -> set[str]:
    """Fields that hold several values: where they have none, they are empty, not null."""
    return {name for name, field in structure.items() if isinstance(field, dict) and field.get("multiple") is True}


def read_csv(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """SC17, SC18."""
    return spark.read.csv(path, header=True, encoding=encoding)


def fingerprint(spark: SparkSession, paths: list[str], prefix: str = "src") -> str:
    """A name for a set of sources by their names, sizes and contents (SC19); the key of every artifact's folder."""
    rows = spark.read.format("binaryFile").load(paths).select(F.element_at(F.split("path", "/"), -1).alias("n"), "length", F.sha2("content", 256).alias("h"))
    listing = rows.agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "n", F.col("length").cast("string"), "h"))), "\n").alias("x"))
    return prefix + "-" + listing.select(F.substring(F.sha1(F.col("x").cast("binary")), 1, 12)).first()[0]


def probed(paths: DataFrame, files: DataFrame, path: str) -> DataFrame:
    """paths with content, read_error and exists of the files that they name: missing and unreadable differ (SC16)."""
    right = files.select(F.regexp_replace("path", "^file:", "").alias("_p"), "content")
    j = paths.join(right, F.col(path) == F.col("_p"), "left")
    return j.withColumn("exists", F.col("_p").isNotNull()).withColumn("read_error", F.when(F.col("_p").isNotNull() & (F.octet_length("content") == 0), "empty")).drop("_p")


def sorted_detail(detail: Column) -> Column:
    """A map as JSON text with sorted keys (SK2)."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(detail))))


#: Columns of the issue table in their order (fixed values).
ISSUE_COLUMNS = (
    "check_id", "category", "severity", "status", "review_priority", "review_required", "dataset_id", "source_json", "institution", "study", "series", "file",
    "geometry_uid", "annotation_type", "image_path", "mask_path", "message", "cannot_determine_reason", "duplicate_group_id", "related_geometry_uids", "detail",
)


def issue_table(issues: DataFrame) -> DataFrame:
    """Issues flattened to ISSUE_COLUMNS (SK2): lists joined by |, detail as sorted JSON, blanks for what is missing."""
    def flat(c: str) -> Column:
        if c not in issues.columns:
            return F.lit("")
        kind = issues.schema[c].dataType.typeName()
        value = F.array_join(c, "|") if kind == "array" else sorted_detail(F.col(c)) if kind == "map" else F.col(c).cast("string")
        return F.coalesce(value, F.lit("{}" if c == "detail" else ""))

    return issues.select(*[c for c in ("check_ord",) if c in issues.columns], *[flat(c).alias(c) for c in ISSUE_COLUMNS])


def write_issues(issues: DataFrame, path: str, compression: str = "none") -> None:
    """SK2: JSON lines and CSV of the 21 columns, in registry order; compression is that of Spark's writers."""
    issues = issues if "check_ord" in issues.columns else issues.withColumn("check_ord", F.lit(0))
    order = ["check_ord", "dataset_id", "source_json", "institution", "study", "series", "file", "geometry_uid"]
    # rows are sorted as they are, and get their blanks behind the shuffle
    ordered = issues.orderBy(*[F.coalesce(F.col(c).cast("string"), F.lit("")) if c != "check_ord" else F.col(c) for c in order if c in issues.columns])
    flat = issue_table(ordered).drop("check_ord")
    flat.write.mode("overwrite").option("compression", compression).json(f"{path}/json")
    flat.write.mode("overwrite").option("compression", compression).csv(f"{path}/csv", header=True)


def write_verdicts(base: DataFrame | None, incoming: DataFrame, path: str) -> DataFrame:
    """The verdict store after incoming rows are merged into base (SK8), as JSON lines and CSV below path; returns its rows.

    Annotations first, then images, each by dataset and key, so that versions compare line by line. A conflict that no
    stamp decides stops the job before anything is written.
    """
    from adjudica.operators import merges
    from adjudica.storage import written

    keys = ["kind", "dataset_id", "key"]
    rows = incoming.filter("dataset_id is not null and key is not null")
    if base is not None:
        rows = merges.without_conflicts(merges.upsert(base, rows, keys, "decision", "reviewed_at"), keys)
    rows = written(null_to_blank(rows), "verdicts")
    ordered = rows.orderBy(*keys)
    ordered.write.mode("overwrite").json(f"{path}/json")
    ordered.write.mode("overwrite").csv(f"{path}/csv", header=True)
    return rows


def ordered_distinct(values: list) -> list:
    """Each value once, in the order of its first place."""
    return list(dict.fromkeys(values))


def newest_tagged(root: str, name: str) -> str | None:
    """The file of that name in the last of root's folders by name that holds one (T11): tags count, not times."""
    import os

    held = [os.path.join(root, d, name) for d in sorted(os.listdir(root), reverse=True)] if os.path.isdir(root) else []
    return next((p for p in held if os.path.isfile(p)), None)


def newest_written(root: str, name: str) -> str | None:
    """The folder whose file of that name was written last."""
    import glob
    import os

    held = glob.glob(os.path.join(glob.escape(root), "*", name))
    return os.path.dirname(max(held, key=os.path.getmtime)) if held else None


def runs(root: str, current: str, artifacts: tuple[str, ...] = ("issues", "dashboard", "selection"), selected: str = "selection") -> list[dict]:
    """Runs below a root, a folder by fingerprint (A34): which artifacts each has and when its selection was written; those
    with a selection first, by that time."""
    import os

    found = []
    for name in sorted(os.listdir(root)) if os.path.isdir(root) else []:
        home = os.path.join(root, name)
        if os.path.isdir(home):
            has = {a: os.path.exists(os.path.join(home, a)) for a in artifacts}
            found.append({"fingerprint": name, "is_current": name == current, "artifacts": has, "mtime": os.path.getmtime(os.path.join(home, selected)) if has.get(selected) else None})
    return sorted(found, key=lambda r: (r["mtime"] is None, r["mtime"] or 0))


def write_table(df: DataFrame, path: str, key: list[str]) -> None:
    """SK3, SK4, SK9: a CSV table in the order of its key."""
    null_to_blank(df).orderBy(*key).write.mode("overwrite").csv(path, header=True)


def write_partition(df: DataFrame, path: str, fingerprint_id: str) -> None:
    """SK1: measurements of one fingerprint; the commit protocol makes a batch whole or absent."""
    df.withColumn("fingerprint", F.lit(fingerprint_id)).write.mode("append").partitionBy("fingerprint").parquet(path)


def nested_documents(records: DataFrame) -> DataFrame:
    """source_json and value, the nested JSON of the annotations that are left (SK5, SK6); keys are sorted.

    records has source_json, institution, study, series, file, image_path and annotation (a struct, null for an image
    without annotations, which stays). Each level is one aggregate; a document's size bounds what comes together.
    """
    def level(df: DataFrame, keys: list[str], name: str, value: Column) -> DataFrame:
        entries = F.array_sort(F.collect_list(F.struct(F.col(name).alias("key"), value.alias("value"))), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
        return df.groupBy(*keys).agg(F.map_from_entries(entries).alias(name + "s"))

    keys = ["source_json", "institution", "study", "series", "file"]
    files = records.groupBy(*keys).agg(F.first("image_path").alias("image_path"), F.collect_list("annotation").alias("annotations"))
    series = level(files, keys[:4], "file", F.struct("image_path", "annotations"))
    studies = level(series, keys[:3], "series", F.struct(F.col("files").alias("file_list")))
    institutions = level(studies, keys[:2], "study", F.struct(F.col("seriess").alias("series_list")))
    top = level(institutions, keys[:1], "institution", F.col("studys"))
    return top.select("source_json", F.to_json(F.struct(F.col("institutions").alias("dataset"))).alias("value"))


def merge_meta(path: str, values: dict) -> dict:
    """SK10: a small JSON on the driver; keys not given keep what they had."""
    import os

    old = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            old = json.load(f)
    new = {**old, **values}
    with open(path + ".part", "w", encoding="utf-8") as f:
        json.dump(new, f, sort_keys=True, indent=1)
    os.replace(path + ".part", path)
    return new


def mask_manifest(samples: DataFrame) -> DataFrame:
    """SK11: samples with a mask in the order of their ids, and whether several sources make it."""
    return samples.filter(F.size("mask_sources") > 0).select("sample_id", "mask_sources", (F.size("mask_sources") > 1).alias("merged")).orderBy("sample_id")
