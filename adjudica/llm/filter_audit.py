"""Filter interaction audit: what each filter of a chain removes, in every order of the chain.

1. Each document gets the set of filters that it fails, a bit mask: 32 of them for five filters.
2. One aggregate turns the table into three histograms of masks for each part: all documents, good ones, toxic ones.
3. The histograms are the rows of an integer matrix with 32 columns. A product with matrices of 0 and 1, a row for each mask
   and a column for each step of each order (32 by 600), counts what is kept, removed, redundant and uniquely failing there.

The texts are read once; orders cost nothing but the product, whatever the table's size.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.llm.common import ship, written
from adjudica.llm.text_stats import let, uncommon, words

#: Filters of one text; a document fails where the condition holds.
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 200, 50, 3
SYMBOLS = "#$%&*|"
FILTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


@lru_cache(maxsize=8)
def outcome_matrices(filters: str) -> tuple[list[str], dict[str, np.ndarray]]:
    """The orders of filters, and matrices of masks by (order, step): kept, removed, redundant, unique.

    Bit k of a mask stands for the k-th filter. A matrix holds 1 where documents of that mask count: none of the filters so
    far fails them; this one is the first to; this one would, but an earlier one did; no other one of all does.
    """
    k = len(filters)
    orders = ["".join(o) for o in permutations(filters)]
    masks = np.arange(1 << k)
    out = {name: np.zeros((1 << k, len(orders) * k), np.int64) for name in ("kept", "removed", "redundant", "unique")}
    for n, order in enumerate(orders):
        failed = np.zeros(1 << k, bool)
        for step, letter in enumerate(order):
            bit = 1 << filters.index(letter)
            fails, column = (masks & bit) > 0, n * k + step
            out["removed"][:, column] = fails & ~failed
            out["redundant"][:, column] = fails & failed
            out["unique"][:, column] = masks == bit
            failed |= fails
            out["kept"][:, column] = ~failed
    return orders, out


def text_masks(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    bit = lambda condition, k: F.when(condition, 1 << k).otherwise(0)
    few = let(words(text), lambda w: bit(F.size(w) < MIN_WORDS, 0) + bit(100 * F.size(F.array_distinct(w)) < MIN_DISTINCT_PERCENT * F.size(w), 1))
    upper = lambda left: F.length(left) - F.length(F.regexp_replace(left, "[A-Z]+", ""))
    marks = let(uncommon(text), lambda left: bit(100 * upper(left).cast("long") > MAX_UPPER_PERCENT * F.length(text), 2) + bit(left.rlike(f"[{SYMBOLS}]"), 3))
    return few + marks


def mask_histograms(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: how many documents of each part fail just the filters of a mask.

    Equal texts are found by their SHA-256; a row is first if no smaller doc_id has its text. Rows are counted before
    every shuffle, and the first rows are looked up by text and doc_id, so a text or an id that many rows have is in no one's way.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text_masks(text).alias("mask"))
    rows = written(rows.groupBy("digest", "doc_id", "part", "mask").agg(F.count("*").alias("n")), "masks")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    late = F.when(F.col("first").isNull() & F.col("doc_id").isNotNull(), 1 << 4).otherwise(0)
    counted = rows.join(first, ["digest", "doc_id"], "left").groupBy("doc_id", "part", (F.col("mask") + late).alias("mask")).agg(F.sum("n").alias("n"))
    is_one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int"))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(is_one("quality").alias("good"), is_one("toxic").alias("toxic"))
    of = lambda c: F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c)
    return counted.join(marks, "doc_id", "left").groupBy("part", "mask").agg(F.sum("n").alias("n"), of("good"), of("toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, order of the five filters and step: part, filter_order, step and the counts of COUNTS.

    docs has doc_id, text, lang; labels has doc_id, quality, toxic; other columns are not looked at. A null text is an empty
    one, a null lang the part of the empty name. A row without doc_id has no label, repeats nothing and is repeated by none;
    rows of one doc_id don't repeat each other. A document with several labels is good, or toxic, if one of them says so.
    Every row of docs counts. An empty table has no part, and so no rows. A text's words are in memory at once.
    """
    orders, matrices = outcome_matrices(FILTERS)
    size, steps = 1 << len(FILTERS), len(FILTERS)
    ship(docs.sparkSession)
    stacked = mask_histograms(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 cells at most
    names = pa.array([o for o in orders for _ in range(steps)])
    step = pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), len(orders)))
    letter = np.array([FILTERS.index(x) for o in orders for x in o])

    def product(stream):
        for batch in stream:
            for part, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                histogram = np.zeros((3, size), np.int64)
                for c in cells:
                    histogram[:, c["mask"]] += (c["n"], c["good"], c["toxic"])
                removed = histogram @ matrices["removed"]
                kept, redundant, unique = (histogram[0] @ matrices[m] for m in ("kept", "redundant", "unique"))
                whole = np.zeros(steps, np.int64)
                np.add.at(whole, letter, removed[0])
                columns = [kept, removed[0], redundant, unique, removed[1], removed[2], whole[letter]]
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(names), pa.string()), names, step, *map(pa.array, columns)], names=["part", "filter_order", "step", *COUNTS])

    return stacked.mapInArrow(product, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))
