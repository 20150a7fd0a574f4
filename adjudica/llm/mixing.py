"""Mixing sources to target weights.

Documents get hash-random keys; inside each source they are sorted by key, and prefix sums of sizes tell where the
source's budget cuts. A budget above the source's size repeats whole epochs; the document at the cut is taken in part,
so a source gives its budget to the word, also where many rows are alike. Everything is DataFrame code: no task holds a
source, however large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adjudica.llm.common import SPACE, WORD, bucket_digits, columns_of, hash_key, packed, prefix_sums, repeated, written
from adjudica.operators.scale import numbered_within, skew_join

#: Weights of sources in the order of their names, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Sources, a row of some numbers each, that are broadcast at most; more meet their documents by a shuffle that splits hot ones.
BROADCAST_SOURCES = 10_000


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Targets of sources (columns source, source_size): weighted shares of share times all sizes.

    Sources are ordered by code point, null last, and take the weights in turn. A target stops at `most` times its
    source's size; the excess is shared again by weight among the rest, until none is above. Each round of sharing
    is one small aggregate; no table of sources is collected. Empty sources get 0.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth + 1).cast("int"))
    ranked = written(sources.select("source", "source_size", weight.alias("weight")), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    left, sum_weights = share * total, ranked.agg(F.sum("weight")).first()[0] or 0.0
    full = F.lit(False)
    cap = most * F.col("source_size")
    while True:
        fair = F.col("weight") * F.lit(float(left)) / F.lit(float(sum_weights) or 1.0)
        now = full | (fair > cap)
        row = ranked.agg(F.sum(F.when(now, cap).otherwise(0.0)), F.sum(F.when(now, 0.0).otherwise(F.col("weight"))), F.sum(F.when(now & ~full, 1).otherwise(0))).first()
        if not row[2]:
            return ranked.select("source", "source_size", F.when(full, cap).otherwise(fair).alias("target"))
        if not row[1]:
            return ranked.select("source", "source_size", cap.alias("target"))
        full, left, sum_weights = now, share * total - row[0], row[1]


def _name(source):
    """A source as a key that is never null: no name and the empty name are two sources."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def _with_source(rows: DataFrame, facts: DataFrame, spread: str, how: str = "inner") -> DataFrame:
    """rows with facts of their source, by the column _name. facts have _rows, how many rows a source has."""
    sources, total = facts.agg(F.count("*"), F.sum("_rows")).first()
    if sources <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(facts.drop("_rows")), "_name", how).drop("_name")
    return skew_join(rows, facts, "_name", "_rows", total, spread, how).drop("_name")


def cuts(units: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """A row for each source of units (source, _key, doc_id, size, alike, words): where its budget ends.

    source_size, target; epochs, the whole passes over the source; and the unit at which the last pass ends, how many
    rows are like it, and the words that they still give. _name is the source's key, _rows how many rows it has.
    """
    sources = units.groupBy("source").agg(F.sum("words").cast("long").alias("source_size"), F.sum("alike").alias("_rows"))
    targets = source_targets(sources.select("source", "source_size"), weights, share, most)
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    budgets = targets.withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    rows = sources.select(_name(F.col("source")).alias("_name"), "_rows")
    budgets = written(budgets.withColumn("_name", _name(F.col("source"))).drop("source").join(rows, "_name"), "budgets")
    before = prefix_sums(units, ["source"], "_key", ["doc_id", "size"], {"_before": "words"}, bucket_digits(units.count()))
    crossing = _with_source(before.withColumn("_name", _name(F.col("source"))), budgets.select("_name", "_rows", "rest"), "_key")
    crossing = crossing.filter("_before < rest and rest <= _before + words").select(
        _name(F.col("source")).alias("_name"), F.struct("_key", "doc_id", "size").alias("_cut"), "alike", (F.col("rest") - F.col("_before")).alias("_part"))
    return budgets.join(crossing, "_name", "left").drop("rest")


def _units(slim: DataFrame) -> DataFrame:
    """Rows that are alike as one, with their number and all their words: no bucket is hot."""
    units = slim.groupBy("source", "_key", "doc_id", "size").agg(F.count("*").alias("alike")).withColumn("words", F.col("size") * F.col("alike"))
    return written(units, "units")


def _key(seed: str, doc_id, text):
    """A document's random key, by its id and its text."""
    return hash_key(seed, doc_id.cast("long"), F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def _slim(docs: DataFrame, seed: str) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), _size(text).alias("size"), _key(seed, F.col("doc_id"), text).alias("_key"))


def _part(here, size, nth):
    """What the last pass takes of a row: all before the cut; of rows that are alike at the cut even shares, and of what is left the first ones a word."""
    odd = (nth < F.col("_part") % F.col("alike")).cast("int")
    return F.when(here < F.col("_cut"), size).when(here == F.col("_cut"), F.floor(F.col("_part") / F.col("alike")) + odd).otherwise(0).cast("long")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """doc_id, source, size, source_size, target and taken of documents (doc_id, text, source).

    size counts words; a null or empty text has 0 and is taken 0 times. A null source is a source. Documents without
    doc_id have keys by their texts. Rows alike in doc_id, source and text that a cut falls into give even shares, and as
    many of them a word more as the budget asks. The sums, and the rows as a whole, are the same however the table is stored. An empty table
    stays empty. Other columns, whatever their names, are not looked at. Of very long texts, words are counted and no list of them is made.
    taken = whole epochs of the document plus what the last, partial epoch takes of it.
    """
    units = _units(_slim(docs, seed))
    ends = written(cuts(units, weights, share, most).withColumnRenamed("alike", "_like"), "cuts")
    joined = _with_source(units.withColumn("_name", _name(F.col("source"))), ends, "_key", "left")
    rows = repeated(joined.drop("words", "_like"), "alike", "_nth")  # at a cut, the unit is the cut's: as many are alike
    part = _part(F.struct("_key", "doc_id", "size"), F.col("size"), F.col("_nth"))
    return rows.select("doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """The mix itself: the columns of docs, with a row for each time that a document is taken.

    The document at a source's cut is taken in part: that row's text is its first words. Documents without words
    hold nothing to be taken and are left out. Texts never travel while the cuts, a row for each source, are few enough to come
    to them; only rows alike at a cut, where its words don't divide evenly, are written out and numbered. Columns of any name stay as they are.
    """
    ends = written(cuts(_units(_slim(docs, seed)), weights, share, most), "cuts")
    text = F.col("_row.text").cast("string")
    joined = packed(docs).withColumns({"size": _size(text), "_name": _name(F.col("_row.source").cast("string")), "_own": _key(seed, F.col("_row.doc_id"), text)})
    joined = _with_source(joined.withColumn("_source", F.col("_name")), ends, "_own", "left")
    here = F.struct(F.col("_own").alias("_key"), F.col("_row.doc_id").cast("long").alias("doc_id"), "size")
    uneven = (F.col("alike") > 1) & (F.col("_part") % F.col("alike") > 0)
    if ends.filter(uneven).limit(1).count():
        at_cut = F.coalesce(uneven & (here == F.col("_cut")), F.lit(False))
        joined = joined.filter(~at_cut).withColumn("_nth", F.lit(0).cast("long")).unionByName(numbered_within(joined.filter(at_cut), "_source", "_nth"))
    else:
        joined = joined.withColumn("_nth", F.lit(0).cast("long"))
    joined = joined.withColumn("part", _part(here, F.col("size"), F.col("_nth")))
    none = F.array().cast("array<bigint>")
    times = F.when(F.col("size") > 0, F.array_repeat("size", F.col("epochs").cast("int"))).otherwise(none)
    taken = joined.withColumn("words", F.explode(F.concat(times, F.when(F.col("part") > 0, F.array("part")).otherwise(none))))
    pieces = F.split(text, rf"(?<={SPACE})(?=[^\x20\x09-\x0D])", -1)  # a word and the white space after it; white space may come first
    lead = F.when(text.rlike(f"^{SPACE}"), 1).otherwise(0)
    head = F.array_join(F.slice(pieces, F.lit(1), (F.col("words") + lead).cast("int")), "")
    return taken.select(*columns_of(docs, text=F.when(F.col("words") < F.col("size"), head).otherwise(F.col("_row.text"))))


def _size(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
