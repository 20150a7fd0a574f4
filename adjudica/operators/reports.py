"""Tables and texts of reports (A10, A11, A17, A22–A24, A31, SK13, SK14, T6, T8, S10)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reference_coverage(files: DataFrame, dataset: str = "dataset_id") -> DataFrame:
    """By dataset: files with masks, those with references, annotations of both (A10)."""
    f = files.filter("n_masks > 0")
    ok = F.col("reference_status") == "available"
    return f.groupBy(dataset).agg(F.count("*").alias("files"), F.count_if(ok).alias("available"), F.sum("n_annotations").cast("long").alias("annotations"), F.coalesce(F.sum(F.when(ok, F.col("n_annotations"))), F.lit(0)).cast("long").alias("covered"))


def lost_by_class(df: DataFrame, code: str, decision: str) -> DataFrame:
    """Codes that lost annotations: all of them, and the excluded."""
    return df.groupBy(code).agg(F.count("*").alias("total"), F.count_if(F.col(decision) == "exclude").alias("excluded")).filter("excluded > 0")


def before_and_after(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """value, before and after: two distributions of a column, null as its own value."""
    count = lambda df, n: df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("(null)")).alias("value")).agg(F.count("*").alias(n))
    return count(before, "before").join(count(after, "after"), "value", "full_outer").select("value", F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))


def coverage_cells(df: DataFrame, by: str, tests: dict[str, Column]) -> DataFrame:
    """By group, a text like 3/4 (75.0%) for each test."""
    n = F.count("*")
    cell = lambda t: F.format_string("%d/%d (%.1f%%)", F.count_if(t), n, F.count_if(t) * 100.0 / n)
    return df.groupBy(by).agg(*[cell(t).alias(k) for k, t in tests.items()])


def top_classes(df: DataFrame, group: str, code: str, k: int = 3) -> DataFrame:
    """The k most frequent codes of each group as text, and how many others there are."""
    counts = df.groupBy(group, code).agg(F.count("*").alias("n"))
    ranked = counts.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), code)))
    out = ranked.groupBy(group).agg(F.array_sort(F.collect_list(F.when(F.col("_r") <= k, F.struct("_r", F.concat_ws(" ", code, "n").alias("t"))))).alias("top"), F.count_if(F.col("_r") > k).alias("others"))
    return out.select(group, F.array_join(F.transform("top", lambda x: x["t"]), ", ").alias("top"), "others")


def page(df: DataFrame, order: list[Column], number: int, size: int = 120) -> DataFrame:
    """One page of a sorted table."""
    return df.orderBy(*order).offset(number * size).limit(size)


def markdown(title: str, tables: dict[str, DataFrame], rows: int = 20) -> str:
    """A report of small aggregates (SK13); each table shows its first rows, as a report does."""
    out = [f"# {title}"]
    for name, df in tables.items():
        got = df.limit(rows + 1).collect()
        out += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in got[:rows]]
        out += ["", "More rows are in the table."] if len(got) > rows else []
    return "\n".join(out) + "\n"


def payload(tables: dict[str, DataFrame], most: int = 50_000) -> str:
    """Aggregates as compact JSON with sorted keys (SK14); a table of more than `most` rows is no aggregate and stops the job."""
    out = {}
    for name, df in tables.items():
        got = df.limit(most + 1).collect()
        if len(got) > most:
            raise ValueError(f"{name} has more than {most} rows: write it as a table")
        out[name] = [r.asDict(recursive=True) for r in got]
    return json.dumps(out, sort_keys=True, separators=(",", ":"), default=str)
