"""Line dedup by pairwise alignment: blocks of lines that an earlier document holds go from the later one.

1. Each document's lines get 128-bit hashes. The shortest runs of lines that reach min_words words, from each line on
   and up to each line, are its marks, and the whole of a document of less: a mark is itself what is deleted.
2. Each mark pairs the documents that hold it with the earliest one that does: as many pairs as there are holders,
   however common the mark is. A document below min_words of several lines is paired with the earliest that holds its
   lines in a row: such runs are only made where a document has the first two lines of a short one.
3. Each pair is aligned with patience diff: lines that occur once on both sides and keep their order are anchors;
   equal lines around them join in; the gaps between are aligned the same way. Runs of min_words words that this chain
   leaves, as passages that are repeated or cross, are looked up one by one.
   Blank lines are left out, as in the marks.
4. Shared blocks of at least min_words words, and blocks that are all of a document, are deleted from the later one.

Every deleted line equals a line of an earlier document, so the earliest holder of a passage keeps it.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.llm.common import columns_of, packed, small_batches, written
from adjudica.operators.scale import skew_join

MIN_WORDS = 50
DIGEST = 16
BLANK = bytes(DIGEST)


def patience(a: list, b: list, blank=None) -> list[tuple[int, int]]:
    """Aligned positions (i, j) of equal items of a and b, ascending in both. blank is no anchor."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        anchors = _increasing(_once_in_both(a, a0, a1, b, b0, b1, blank))
        at = (a0, b0)
        for i, j in anchors:
            todo.append((at[0], i, at[1], j))
            found.append((i, j))
            at = (i + 1, j + 1)
        if anchors:
            todo.append((at[0], a1, at[1], b1))
    return sorted(found)


def _once_in_both(a, a0, a1, b, b0, b1, blank) -> list[tuple[int, int]]:
    """Positions of items that occur once in each range, in the order of a."""

    def once(items, start, stop):
        at: dict = {}
        for k in range(start, stop):
            at[items[k]] = -1 if items[k] in at else k
        return at

    left, right = once(a, a0, a1), once(b, b0, b1)
    return [(i, right[x]) for x, i in left.items() if i >= 0 and x != blank and right.get(x, -1) >= 0]


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest part of pairs (ascending in the first) that ascends in the second too."""
    tops: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        tops[at:], ends[at:] = [j, *tops[at + 1 :]], [k, *ends[at + 1 :]]
        before.append(ends[at - 1] if at else -1)
    out = []
    k = ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def runs(words: list[int], min_words: int):
    """The shortest runs (begin, end) that reach min_words: from each line on, up to each line, and two lines where one alone does.

    A longer run is made of these, each overlapping the next, and whether a run is one of them shows in its lines alone.
    """
    least = max(min_words, 1)
    end = held = 0
    for begin, n in enumerate(words):
        while held < least and end < len(words):
            held, end = held + words[end], end + 1
        if held < least:
            break
        yield begin, end
        if n >= least and begin + 1 < len(words):
            yield begin, begin + 2
        held -= n
    begin = held = 0
    for end, n in enumerate(words, 1):
        held += n
        while held - words[begin] >= least:
            held, begin = held - words[begin], begin + 1
        if held >= least:
            yield begin, end


def _spans(a: list, b: list, words: list[int], min_words: int) -> list[tuple[int, int]]:
    """Runs (begin, end) of a of min_words or more that b holds, wherever and however often: together all such lines."""
    pairs = patience(a, b)
    out, k = [], 0
    while k < len(pairs):
        n = k + 1
        while n < len(pairs) and pairs[n][0] == pairs[n - 1][0] + 1 and pairs[n][1] == pairs[n - 1][1] + 1:
            n += 1
        if sum(words[pairs[k][0] : pairs[n - 1][0] + 1]) >= max(min_words, 1):
            out.append((pairs[k][0], pairs[n - 1][0] + 1))
        k = n
    # repeats and crossings are off the chain: runs that it leaves are looked up among those of b
    stop = list(range(len(a)))
    for begin, end in out:
        stop[begin:end] = [end] * (end - begin)
    left: dict[tuple, set[tuple[int, int]]] = {}
    for begin, end in runs(words, min_words):
        if end > stop[begin]:
            left.setdefault(tuple(a[begin:end]), set()).add((begin, end))
    known = dict(zip(a, words, strict=True))
    at = 0
    while left and at < len(b):
        to = at
        while to < len(b) and b[to] in known:
            to += 1
        for begin, end in runs([known[x] for x in b[at:to]], min_words):
            out += left.pop(tuple(b[at + begin : at + end]), ())
        at = to + 1
    return out


def blocks(later: list, earlier: list, words: list[int], min_words: int, blank=None) -> list[tuple[int, int]]:
    """Ranges (begin, end) of lines of the later document to delete: all runs of min_words that the earlier one holds.

    Blank lines part no run on either side, and those inside a run go with it; those around it stay.
    A document of less goes if the earlier one holds all of it in a row; a single line only if that is all of the other too.
    """
    at = [k for k, x in enumerate(later) if x != blank]
    solid, held = [later[k] for k in at], [x for x in earlier if x != blank]
    if sum(words) < min_words:
        n = len(solid)
        whole = held == solid or (n > 1 and any(held[k : k + n] == solid for k in range(len(held) - n + 1)))
        return [(0, len(later))] if solid and whole else []
    out: list[tuple[int, int]] = []
    for begin, end in sorted(_spans(solid, held, [words[k] for k in at], min_words)):
        begin, end = at[begin], at[end - 1] + 1
        if out and begin < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """doc_id, text_key, hashes and word counts of lines, marks, twos and whole. docs has doc_id, text, text_key.

    twos are hashes of two lines in a row; whole is the hash of a document below min_words of several lines, or null.
    """
    small_batches(docs.sparkSession)

    def split(stream):
        from xxhash import xxh3_64_intdigest, xxh3_128_digest

        white = b" \t\n\x0b\x0c\r"
        signed = lambda x: np.array(x, dtype=np.uint64).view(np.int64)
        for batch in stream:
            hashes, counts, marks, twos, wholes = [], [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                lines = [x.strip(white) for x in (text or b"").split(b"\n")]
                own = [xxh3_128_digest(x) if x else BLANK for x in lines]
                words = [len(x.split()) for x in lines]
                solid = b"".join(h for h, n in zip(own, words, strict=True) if n)
                held = [n for n in words if n]
                keys = {xxh3_64_intdigest(solid[DIGEST * a : DIGEST * b]) for a, b in runs(held, min_words)}
                short = 0 < sum(held) < min_words
                if short and len(held) == 1:
                    keys.add(xxh3_64_intdigest(b"all" + solid))
                hashes.append(b"".join(own))
                counts.append(words)
                marks.append(signed(sorted(keys)))
                twos.append(signed([xxh3_64_intdigest(solid[DIGEST * k : DIGEST * (k + 2)]) for k in range(len(held) - 1) if held[k] + held[k + 1] < min_words]))
                wholes.append(int(signed([xxh3_64_intdigest(solid)])[0]) if short and len(held) > 1 else None)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(hashes, pa.binary()), pa.array(counts, pa.list_(pa.int32())), pa.array(marks, longs), pa.array(twos, longs), pa.array(wholes, pa.int64())],
                names=["doc_id", "text_key", "hashes", "words", "marks", "twos", "whole"],
            )

    return docs.mapInArrow(split, "doc_id long, text_key long, hashes binary, words array<int>, marks array<long>, twos array<long>, whole long")


def _short_pairs(lines: DataFrame, min_words: int) -> DataFrame:
    """doc_id and earlier: documents below min_words of several lines, and the earliest one that holds all of each in a row."""
    short = lines.filter("whole is not null").select("doc_id", "whole", F.get("twos", F.lit(0)).alias("two"))
    places = lines.select("doc_id", "text_key", F.explode("twos").alias("two"))
    places = places.join(short.select("two").distinct().hint("merge"), "two").groupBy("doc_id", "text_key").agg(F.collect_set("two").alias("openings"))
    places = places.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "openings")
    on = (F.col("doc_id") == F.col("_doc")) & (F.col("text_key") == F.col("_key"))
    holders = lines.select("doc_id", "text_key", "hashes", "words").join(places.hint("merge"), on).select("doc_id", "hashes", "words", "openings")

    def below(stream):
        from xxhash import xxh3_64_intdigest

        for batch in stream:
            ids, marks = [], []
            for doc_id, hashes, words, openings in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                solid = b"".join(hashes[DIGEST * k : DIGEST * (k + 1)] for k, n in enumerate(words) if n)
                held, wanted, found = [n for n in words if n], set(np.array(openings, dtype=np.int64).view(np.uint64).tolist()), set()
                for begin in range(len(held) - 1):
                    if xxh3_64_intdigest(solid[DIGEST * begin : DIGEST * (begin + 2)]) in wanted:
                        end, total = begin + 1, held[begin]
                        while end < len(held) and (total := total + held[end]) < min_words:
                            end += 1
                            found.add(xxh3_64_intdigest(solid[DIGEST * begin : DIGEST * end]))
                ids += [doc_id] * len(found)
                marks += sorted(found)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.array(marks, dtype=np.uint64).view(np.int64))], names=["held_by", "mark"])

    first = holders.mapInArrow(below, "held_by long, mark long").groupBy("mark").agg(F.min("held_by").alias("earlier"))
    return short.join(first.hint("merge"), F.col("whole") == F.col("mark")).filter("doc_id > earlier").select("doc_id", "earlier")


def removals(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text_key, begin, end, earlier: ranges of lines to delete, and the document that holds them before."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null and text is not null")
    lines = written(_lines(keyed.withColumn("text_key", F.xxhash64("text")), min_words), "lines")
    marks = lines.select("doc_id", F.explode("marks").alias("mark"))
    held = marks.groupBy("mark").agg(F.min("doc_id").alias("earlier"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
    first = held.filter("earlier < last").select("mark", "earlier", "n")
    total = lines.agg(F.sum(F.size("marks"))).first()[0] or 0
    pairs = skew_join(marks, first, "mark", "n", total, "doc_id").filter("doc_id > earlier").select("doc_id", "earlier")
    pairs = written(pairs.unionByName(_short_pairs(lines, min_words)).distinct(), "pairs")
    # a document that a third of all others share a passage with is one partner of many: its lines are repeated for parts of them
    partners = pairs.groupBy(F.col("earlier").alias("_earlier")).agg(F.count("*").alias("n"))
    before = lines.select(F.col("doc_id").alias("earlier"), F.col("hashes").alias("before")).join(partners.hint("merge"), F.col("earlier") == F.col("_earlier")).drop("_earlier")
    later = pairs.join(lines.select("doc_id", "text_key", "hashes", "words").hint("merge"), "doc_id")
    both = skew_join(later, before, "earlier", "n", pairs.count(), "doc_id").select("doc_id", "text_key", "hashes", "words", "earlier", "before")

    def aligned(stream):
        cut = lambda x: [x[k : k + DIGEST] for k in range(0, len(x), DIGEST)]
        for batch in stream:
            out = []
            for doc_id, key, hashes, words, earlier, held in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out += [(doc_id, key, a, b, earlier) for a, b in blocks(cut(hashes), cut(held), words, min_words, BLANK)]
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "text_key", "begin", "end", "earlier"])

    return both.mapInArrow(aligned, "doc_id long, text_key long, begin int, end int, earlier long")


def _deduped(docs: DataFrame, min_words: int) -> DataFrame:
    """_row, a struct of the columns of docs, and new_text, n_lines, n_removed, removed, had_words."""
    gone = written(removals(docs, min_words), "removals")
    gone = gone.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set(F.struct("begin", "end", "earlier"))).alias("_gone"))
    text = F.col("_row.text").cast("string")
    on = (F.col("_row.doc_id").cast("long") == F.col("doc_id")) & (F.xxhash64(text) == F.col("text_key"))
    # texts meet the deletions by a shuffle at every size: what is deleted grows with the corpus and is never broadcast
    joined = packed(docs).join(gone.hint("merge"), on, "left").withColumn("_lines", F.split(text, "\n"))
    inside = lambda i: F.exists("_gone", lambda b: (i >= b["begin"]) & (i < b["end"]))
    joined = joined.withColumn("_left", F.when(F.col("_gone").isNotNull(), F.filter("_lines", lambda x, i: ~inside(i))))
    return joined.select(
        "_row", F.when(F.col("_left").isNotNull(), F.array_join("_left", "\n")).otherwise(text).alias("new_text"),
        F.coalesce(F.size("_lines"), F.lit(0)).alias("n_lines"),
        F.when(F.col("_left").isNotNull(), F.size("_lines") - F.size("_left")).otherwise(0).alias("n_removed"),
        F.coalesce("_gone", F.array().cast("array<struct<begin:int,end:int,earlier:bigint>>")).alias("removed"),
        _has_words(text).alias("had_words"),
    )


def _has_words(text):
    return F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of docs with text less the deleted blocks, and n_lines, n_removed, removed, had_words.

    removed lists (begin, end, earlier), lines from 0; n_lines counts the lines of the text as it was. Lines are equal
    that agree but for white space at their ends. The later document is the one with the larger doc_id. A row without
    doc_id or text stays as it is, and no other row loses lines to it. Rows with one doc_id never lose lines to each
    other; repeated rows lose the same. A document can lose all lines: its text is empty then. An empty table stays
    empty. Columns of docs that are named like one of the four are replaced.
    """
    made = ["n_lines", "n_removed", "removed", "had_words"]
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in made])
    return _deduped(docs, min_words).select(*columns_of(kept, text=F.col("new_text")), *made)


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The columns of docs, of any name, after line_dedup(), without the rows whose every word was deleted."""
    left = _has_words(F.col("new_text")) | ~F.col("had_words")
    return _deduped(docs, min_words).filter(left).select(*columns_of(docs, text=F.col("new_text")))
