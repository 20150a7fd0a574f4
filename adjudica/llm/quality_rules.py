"""Quality rules with a divergence test: a text's histograms against those of its language.

References come from all documents: for each language the shares of character classes, and the shares of its most
common words with the rest as one cell. A language's counts are smoothed with the shares of all documents, by a fixed
weight for every language: so a few odd documents under a name of their own are no reference for themselves, while a
language of a few ordinary documents keeps its own. A document fails when the Jensen-Shannon distance of either histogram is
larger than its limit, which is wider for short texts, whose histograms are rough; below a minimum length a histogram
isn't judged. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.llm.common import SPACE, written
from adjudica.llm.text_stats import CLASSES, class_counts, duplicate_lines, js_distance, js_term, let, repeated_words, split_words, uncommon, word_chars, words

#: Cells of the word histogram besides the rest, and the parts that words are ranked in first.
COMMON_WORDS = 32
CLASS_CELLS = len(CLASSES) + 1
PARTS = 256
#: Words and characters of all documents that each language's counts are smoothed with.
PRIOR_WORDS, PRIOR_CHARS = 50.0, 500.0
#: How the references, a small row for each language, reach the documents: those of so many languages, the largest, are
#: broadcast, those of all others shuffled. Results are the same.
BROADCAST_LANGUAGES = 64

#: Limits of the distances, a slack over the root of the length, and the least lengths at which they are judged.
CLASS_LIMIT, CLASS_SLACK, MIN_CHARS = 0.11, 5.0, 200
WORD_LIMIT, WORD_SLACK, MIN_WORDS = 0.13, 2.5, 40


def references(docs: DataFrame) -> DataFrame:
    """A row for each language: lang (null: all documents), common (hashes of words), word_shares (one more, the rest), class_shares, total (words).

    docs has text and lang. Counts are over all documents; ranks take the more frequent word, then the lesser.
    """
    slim = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = slim.select("lang", F.explode(F.array_remove(split_words(F.col("text")), "")).alias("word")).groupBy("lang", F.lower("word").alias("word")).agg(F.count("*").alias("n"))
    counts = written(counts, "word-counts")
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    known = sizes.filter("lang is not null")
    own = counts.filter("lang is not null").select("lang", "word", "n")
    pooled = counts.groupBy("word").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "word", "n")
    ranked = _top(own.unionByName(pooled))  # words as themselves; documents are searched for their hashes
    everywhere = pooled.select(F.col("word").alias("_word"), F.col("n").alias("_n"))
    everyone = sizes.agg(F.sum("total").alias("_total"))
    ranked = ranked.join(everywhere, F.col("word") == F.col("_word")).drop("_word")
    totals = known.unionByName(everyone.select(F.lit(None).cast("string").alias("lang"), F.col("_total").alias("total")))
    common = ranked.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "word", "n", "_n"))).alias("top"))
    shares = common.alias("a").join(totals.alias("b"), F.col("a.lang").eqNullSafe(F.col("b.lang"))).crossJoin(F.broadcast(everyone))  # one row
    total, prior = F.col("total").cast("double"), F.when(F.col("a.lang").isNull(), 0.0).otherwise(PRIOR_WORDS)
    smoothed = F.transform("top", lambda x: (x["n"] + prior * (x["_n"] / F.col("_total").cast("double"))) / (total + prior))
    shares = shares.select("a.lang", "total", F.transform("top", lambda x: F.xxhash64(x["word"])).alias("common"), smoothed.alias("_shares"))
    shares = shares.withColumn("word_shares", F.concat("_shares", F.array(F.greatest(F.lit(0.0), 1 - F.aggregate("_shares", F.lit(0.0), lambda a, b: a + b))))).drop("_shares")
    return shares.join(_class_shares(slim), F.col("lang").eqNullSafe(F.col("_lang"))).select("lang", "common", "word_shares", "class_shares", "total")


def _class_shares(slim: DataFrame) -> DataFrame:
    """_lang (null: all documents) and class_shares."""
    raw = F.coalesce("text", F.lit(""))
    chars = F.length(F.regexp_replace(raw, f"{SPACE}+", ""))
    counted = slim.select("lang", uncommon(raw).alias("left"), chars.cast("double").alias("chars"))
    counted = counted.select("lang", class_counts(F.col("left"), F.col("chars")).alias("c"))
    cells = [f"c{i}" for i in range(CLASS_CELLS)]
    sums = written(counted.groupBy("lang").agg(*[F.sum(F.col("c")[i]).alias(c) for i, c in enumerate(cells)]), "class-sums")
    total = lambda names: sum((F.col(c) for c in names[1:]), F.col(names[0]))
    share = lambda c, of: F.when(of > 0, F.col(c) / of).otherwise(0.0)
    pooled = sums.agg(*[F.sum(c).alias(c) for c in cells])
    everyone = pooled.select(F.array(*[share(c, total(cells)) for c in cells]).alias("q"))
    own = sums.filter("lang is not null").crossJoin(F.broadcast(everyone))  # one row
    smoothed = F.array(*[(F.col(c) + PRIOR_CHARS * F.col("q")[i]) / (total(cells) + PRIOR_CHARS) for i, c in enumerate(cells)])
    return own.select(F.col("lang").alias("_lang"), smoothed.alias("class_shares")).unionByName(everyone.select(F.lit(None).cast("string").alias("_lang"), F.col("q").alias("class_shares")))


def _top(counts: DataFrame) -> DataFrame:
    """The most common words of each language, ranked in parts first, so that no task ranks a whole vocabulary."""
    order = [F.desc("n"), F.col("word")]
    part = counts.withColumn("_part", F.pmod(F.xxhash64("word"), F.lit(PARTS)))
    first = part.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).filter(F.col("_r") <= COMMON_WORDS)
    return first.withColumn("_r", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("_r") <= COMMON_WORDS).select("lang", "word", "n")


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance, kept.

    docs has doc_id, text and lang; other columns are not looked at. A null text is empty: it has no words and fails
    the base rules. A null language is held against all documents, any other against its own smoothed counts. A distance
    is null where the text is too short for it. Repeated rows are judged alike; an empty table stays empty.
    """
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    refs = references(slim)
    refs = written(refs, "references")  # a row of bounded size for each language
    return _judged(slim, refs)


def _with_own(slim: DataFrame, own: DataFrame) -> DataFrame:
    """Documents with the reference of their language as _own, null where there is none."""
    on = F.col("lang") == F.col("_lang")
    if own.count() <= BROADCAST_LANGUAGES:
        return slim.join(F.broadcast(own.drop("total")), on, "left").drop("_lang")
    # the largest are broadcast; each of the others holds less than a 64th of all words, so their shuffle has no hot key
    large = written(own.orderBy(F.desc("total"), "_lang").limit(BROADCAST_LANGUAGES).drop("total"), "large-languages")
    small = own.drop("total").join(F.broadcast(large.select("_lang")), "_lang", "left_anti")
    marked = slim.join(F.broadcast(large), on, "left").drop("_lang")
    rare = F.col("_own").isNull() & F.col("lang").isNotNull()
    found = marked.filter(rare).drop("_own").join(small.hint("merge"), on, "left").select(*slim.columns, "_own")
    return marked.filter(~rare).unionByName(found)


def _judged(slim: DataFrame, refs: DataFrame) -> DataFrame:
    struct = F.struct("common", "word_shares", "class_shares")
    everyone = F.broadcast(refs.filter("lang is null").select(struct.alias("_all")))
    own = refs.filter("lang is not null").select(F.col("lang").alias("_lang"), struct.alias("_own"), "total")
    n = F.col("n_words")
    base = _with_own(slim, own).join(everyone, F.lit(True), "left")
    raw = F.coalesce("text", F.lit(""))
    base = base.withColumn("_ref", F.coalesce("_own", "_all")).select(
        "doc_id", "text", words(raw).alias("_words"), uncommon(raw).alias("_left"), "_ref.common", "_ref.word_shares", "_ref.class_shares",
    )
    base = base.select(
        "doc_id", "common", "word_shares", "class_shares", "_left", F.size("_words").cast("long").alias("n_words"), word_chars(F.col("_words")).cast("long").alias("word_chars"),
        duplicate_lines(F.col("text")).alias("n_dup_lines"),
        repeated_words(F.col("_words"), F.size("_words")).alias("n_repeat_words"), F.transform("_words", lambda w: F.xxhash64(F.lower(w))).alias("_hashes"),
    )
    base = base.select(*[c for c in base.columns if c not in ("_left", "_hashes")], class_counts(F.col("_left"), F.col("word_chars")).alias("_classes"), _hits().alias("_hits"))
    base = base.withColumn("n_symbols", F.get("_classes", F.lit(list(CLASSES).index("symbol"))).cast("long"))
    failed = (n < 20) | (100 * F.col("n_repeat_words") > 30 * n)
    word_distance = F.when((n >= MIN_WORDS) & (F.size("common") > 0), _word_distance(n))
    chars = F.col("word_chars")
    class_distance = F.when(chars >= MIN_CHARS, js_distance(F.transform("_classes", lambda c: c / chars), F.col("class_shares")))
    out = base.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        class_distance.alias("class_distance"), word_distance.alias("word_distance"),
    )
    far = (F.coalesce("class_distance", F.lit(0.0)) > CLASS_LIMIT + CLASS_SLACK / F.sqrt(F.greatest(chars, F.lit(1)))) | (F.coalesce("word_distance", F.lit(0.0)) > WORD_LIMIT + WORD_SLACK / F.sqrt(F.greatest(n, F.lit(1))))
    return out.withColumn("kept", ~F.col("base_failed") & ~far)


def _hits() -> Column:
    """Which common words a document has, and how often: runs in the sorted hashes that are common ones."""
    found = F.sort_array(F.filter("_hashes", lambda h: F.array_contains("common", h)))
    ends = let(found, lambda s: F.filter(F.transform(s, lambda h, i: F.when(~F.get(s, i + 1).eqNullSafe(h), F.struct(h.alias("hash"), (i + 1).alias("upto")))), lambda e: e.isNotNull()))
    return let(ends, lambda e: F.transform(e, lambda x, i: F.struct(x["hash"].alias("hash"), (x["upto"] - F.coalesce(F.get(e, i - 1)["upto"], F.lit(0))).alias("n"))))


def _word_distance(n: Column) -> Column:
    """The distance of the word histograms, summed over the common words that occur; each of the others adds half its share."""
    cells = F.transform("_hits", lambda x: F.struct((x["n"] / n).alias("p"), F.element_at("word_shares", F.array_position("common", x["hash"]).cast("int")).alias("q")))
    zero = F.struct(F.lit(0.0).alias("js"), F.lit(0.0).alias("q"), F.lit(0.0).alias("p"))
    both = let(cells, lambda c: F.aggregate(c, zero, lambda a, x: F.struct((a["js"] + js_term(x["p"], x["q"])).alias("js"), (a["q"] + x["q"]).alias("q"), (a["p"] + x["p"]).alias("p"))))
    rest = F.element_at("word_shares", -1)
    total = let(both, lambda s: s["js"] + F.greatest(1 - rest - s["q"], F.lit(0.0)) / 2 + js_term(F.greatest(1 - s["p"], F.lit(0.0)), rest))
    return F.sqrt(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))
