"""The export of samples: rows about reports, counters and open questions, header, and the file itself (P8, A22, S9, SK7)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a report says by itself, kept for samples in and out of scope alike.
REPORT_COLUMNS = (
    "pneumothorax_status", "pneumothorax_subtype", "pneumothorax_evidence", "pneumothorax_certainty_max", "pneumothorax_certainty_counts", "pneumothorax_absent_certainty_counts",
    "bulla_bleb_evidence", "bulla_bleb_certainty_max", "bulla_bleb_certainty_counts", "pleural_effusion_evidence", "pleural_effusion_certainty_max", "pleural_effusion_flags",
    "pleural_effusion_findings", "observed_finding_count", "flags", "needs_review",
)
#: What only a sample has: null out of scope, for no sample is made there.
DERIVED = ("pneumothorax_case", "case_evidence", "pneumothorax_side", "bulla_bleb_status", "pleural_effusion_status", "abnormal_finding_status")


def report_rows(images: DataFrame, labels: DataFrame, scope: Column, key: str = "sample_id") -> DataFrame:
    """A row for each image with a report, in scope or not, in the same columns.

    images has key, study and report; labels has key and DERIVED. The report's own study, dataset and document count first.
    """
    r = F.col("report")
    rows = images.filter(r.isNotNull()).select(
        key, F.coalesce(F.nullif(r["study_name"], F.lit("")), F.col("study")).alias("study_name"), r["source_dataset_id"].alias("source_dataset_id"), r["source_json"].alias("source_json"),
        F.coalesce(scope, F.lit(False)).alias("in_scope"), *[r[c].alias(c) for c in REPORT_COLUMNS], r["pleural_effusion_status"].alias("report_pleural_effusion_status"),
    )
    own = labels.select(F.col(key).alias("_k"), *DERIVED)
    return rows.join(own, F.col("in_scope") & (F.col(key) == F.col("_k")), "left").drop("_k")


def _empty(df: DataFrame, column: str) -> Column:
    """Null, an empty list, or a mask without pixels."""
    c, kind = F.col(column), df.schema[column].dataType.typeName()
    if kind == "array":
        return c.isNull() | (F.size(c) == 0)
    if kind == "struct" and df.schema[column].dataType.fieldNames() == ["pixel_array"]:
        return c.isNull() | c["pixel_array"].isNull()
    return c.isNull()


def counters(samples: DataFrame, evidence: str = "case_evidence", certainty: str | None = None, fields: list[str] | None = None) -> DataFrame:
    """counter, value and n of an export (A22): statuses, statuses with cases, evidence, certainty, and empty fields.

    One pass: each sample gives its values, which are counted with partial aggregation. Fields that are never empty and
    values that do not occur have no row.
    """
    status = F.col("abnormal_finding_status")
    pair = lambda name, value: F.struct(F.lit(name).alias("counter"), value.cast("string").alias("value"))
    said = [pair("status", status), pair("status_case", F.concat_ws("/", status, F.col("pneumothorax_case").cast("string"))), pair("evidence", F.col(evidence))]
    if certainty:
        said.append(pair("certainty", F.coalesce(F.nullif(F.col(certainty), F.lit("")), F.lit("(none)"))))
    said += [F.when(_empty(samples, c), pair("null", F.lit(c))) for c in fields or samples.columns]
    return samples.select(F.explode(F.array_compact(F.array(*said))).alias("x")).select("x.*").groupBy("counter", "value").agg(F.count("*").alias("n"))


def finding_counts(samples: DataFrame, findings: str = "findings") -> DataFrame:
    """finding and the number of samples that have it."""
    return samples.select(F.explode(F.array_distinct(findings)).alias("finding")).groupBy("finding").agg(F.count("*").alias("n"))


def unlisted_normals(images: DataFrame, evidence: list[list[str]], columns: tuple[str, ...] = ("case_labels", "ann_labels")) -> DataFrame:
    """label and images: labels named normal of systems that are no evidence (A22); an image counts once."""
    listed = [f"{system}/{name}" for system, name in evidence]
    every = F.concat(*[F.coalesce(F.transform(c, lambda x: F.struct(x["code_system"], x["code_text_eng"])), F.array().cast("array<struct<code_system:string,code_text_eng:string>>")) for c in columns])
    named = F.array_distinct(F.transform(F.filter(every, lambda x: x["code_text_eng"] == "normal"), lambda x: F.concat_ws("/", x["code_system"], x["code_text_eng"])))
    return images.select(F.explode(named).alias("label")).filter(~F.col("label").isin(*listed)).groupBy("label").agg(F.count("*").alias("images"))


def named_as(dataset: Column, word: str = "pneumothorax", opposite: str = "non_pneumothorax") -> Column:
    """Whether a dataset's name says that it holds cases, case aside; the opposite's name does not."""
    name = F.lower(dataset)
    return name.contains(word) & ~name.contains(opposite)


def named_without_cases(samples: DataFrame) -> DataFrame:
    """dataset_id and n: samples without a case in datasets named after it, for a person to look at."""
    return samples.filter(~F.col("pneumothorax_case") & named_as(F.col("dataset_id"))).groupBy("dataset_id").agg(F.count("*").alias("n"))


def has_placeholder(value: Column) -> Column:
    """Whether a text still holds a part like <owner>."""
    return value.rlike("<[^<>]+>")


def unresolved(header: dict) -> list[str]:
    """Texts on the top level of a header that still hold a placeholder, as key=value, sorted."""
    import re

    return sorted(f"{k}={v}" for k, v in header.items() if isinstance(v, str) and re.search(r"<[^<>]+>", v))


def write_dataset(samples: DataFrame, header: dict, path: str, key: str = "sample_id") -> None:
    """The dataset file: {"meta": header, "samples": {key: sample}}, keys sorted, nulls written (SK7).

    The folder's parts in the order of their names are the document; each is a range of keys, so no task holds all, and
    the commit protocol makes the whole appear or nothing. A null key or a repeated one stops the job.
    """
    columns = sorted(c for c in samples.columns if c != key)
    value = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    last = samples.agg(F.max(key)).first()[0]
    doubled = samples.groupBy(key).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | F.col(key).isNull()).limit(1).collect()
    if doubled:
        raise ValueError(f"no sample of its own: {doubled[0][0]}")
    quoted = F.regexp_replace(F.to_json(F.struct(F.col(key).alias("k"))), r'^\{"k":(.*)\}$', "$1")
    lines = samples.select(F.lit(1).alias("_kind"), F.col(key).alias("_key"), F.concat(quoted, F.lit(": "), value, F.when(F.col(key) == last, "").otherwise(",")).alias("value"))
    ends = [(0, "", '{"meta": ' + json.dumps(header, ensure_ascii=False, sort_keys=True) + ', "samples": {'), (2, "", "}}")]
    frame = samples.sparkSession.createDataFrame(ends, "_kind int, _key string, value string")
    frame.union(lines).orderBy("_kind", "_key").select("value").write.mode("overwrite").text(path)
