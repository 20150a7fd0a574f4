"""Document fingerprints from prefix polynomial hashes.

A text's prefix array holds the hash of each of its beginnings: S[i] is the sum of c[j] * B**j for j < i, modulo a prime. The
hash of any span follows from two entries, so spans are equal if their hashes are, and the longest common extension of two
places is found by binary search. Two primes of 31 bits make 62.

A fingerprint keeps of that, in a few hundred bytes:
* the number of characters and the hash of the whole text;
* a ladder of the hashes of its first and of its last 1, 2, 3, 4, 6, 8, 11 ... characters: where two texts part, from
  either end, is found by binary search on two ladders;
* the least mixed hashes of all spans of WIDTH characters, from differences of the array: two such samples estimate how
  many spans two texts have in common, wherever those stand.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.llm.common import small_batches

PRIMES = (2147483647, 2147483629)
BASES = (1000003, 69069007)
#: Characters of a span, and how many spans a fingerprint keeps.
WIDTH, SPANS = 32, 32
#: Characters that are hashed at once.
BLOCK = 1 << 16
#: Odd multiplier that spreads span hashes over 64 bits.
MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=4)
def _powers(prime: int, base: int, count: int) -> np.ndarray:
    """base ** 0 to base ** (count - 1), modulo prime."""
    out = np.ones(1, np.int64)
    while len(out) < count:
        out = np.concatenate([out, out * pow(base, len(out), prime) % prime])
    return out[:count]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1


def _sums(codes: np.ndarray, k: int) -> np.ndarray:
    """The prefix array of at most BLOCK + WIDTH characters."""
    prime = PRIMES[k]
    out = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(codes * _powers(prime, BASES[k], BLOCK + WIDTH)[: len(codes)] % prime, out=out[1:])
    return out % prime


class PrefixHashes:
    """The prefix arrays of a text, which answer whether any two spans are equal; 16 bytes a character."""

    def __init__(self, text: str):
        self.length = len(text)
        self.arrays = []
        for k, prime in enumerate(PRIMES):
            parts, before = [np.zeros(1, np.int64)], 0
            for at in range(0, len(text), BLOCK):
                part = (_sums(_codes(text[at : at + BLOCK]), k)[1:] * pow(BASES[k], at, prime) + before) % prime
                parts.append(part)
                before = int(part[-1])
            self.arrays.append(np.concatenate(parts))

    def span(self, begin: int, end: int) -> tuple[int, int]:
        """The hash of a span, the same wherever it stands."""
        return tuple(int(a[end] - a[begin]) * pow(b, -begin, p) % p for a, b, p in zip(self.arrays, BASES, PRIMES, strict=True))

    def equal(self, begin: int, other: PrefixHashes, start: int, length: int) -> bool:
        return self.span(begin, begin + length) == other.span(start, start + length)

    def extension(self, begin: int, other: PrefixHashes, start: int) -> int:
        """How many characters from begin on equal the other text's from start on."""
        low, high = 0, min(self.length - begin, other.length - start)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.equal(begin, other, start, middle) else (low, middle - 1)
        return low


def rungs(length: int) -> list[int]:
    """Lengths at which ladders hold hashes: 1, 2, 3, 4, 6, 8, 11, 16 and so on, by the root of two, up to length."""
    out, k = [], 0
    while (n := round(2 ** (k / 2))) <= length:
        if not out or n > out[-1]:
            out.append(n)
        k += 1
    return out


def fingerprint(text: str) -> bytes:
    """A text's fingerprint, block by block; equal texts have equal ones."""
    n, prime, base = len(text), PRIMES[0], BASES[0]
    steps = rungs(n)
    wanted = np.array(sorted({0, n, *steps, *(n - s for s in steps)}), np.int64)
    at_wanted = np.zeros(len(wanted), np.int64)
    whole, before, least = 0, 0, np.zeros(0, np.uint64)
    inverse = _powers(prime, pow(base, -1, prime), BLOCK + WIDTH)
    for at in range(0, n, BLOCK):
        codes = _codes(text[at : at + BLOCK + WIDTH - 1])
        own = min(BLOCK, n - at)
        sums = _sums(codes, 0)
        shift = pow(base, at, prime)
        here = slice(*np.searchsorted(wanted, [at, at + own + 1]))
        at_wanted[here] = (sums[wanted[here] - at] * shift + before) % prime
        before = (before + int(sums[own]) * shift) % prime
        whole = (whole + int(_sums(codes[:own], 1)[own]) * pow(BASES[1], at, PRIMES[1])) % PRIMES[1]
        width = min(WIDTH, n)
        begins = max(0, len(sums) - width)  # none in a last block that is shorter than a span: the block before has seen them
        spans = (sums[width:] - sums[:begins]) % prime * inverse[:begins] % prime
        least = _least(np.concatenate([least, (spans.astype(np.uint64) * MIX) >> np.uint64(32)]))
    of = dict(zip(wanted.tolist(), at_wanted.tolist(), strict=True))
    first = [of[s] for s in steps]
    last = [(of[n] - of[n - s]) * pow(base, s - n, prime) % prime for s in steps]
    head = n.to_bytes(6, "big") + of[n].to_bytes(4, "big") + whole.to_bytes(4, "big")
    return head + np.array(first + last, ">u4").tobytes() + least.astype(">u4").tobytes()


def _least(hashes: np.ndarray) -> np.ndarray:
    """The SPANS least of the distinct hashes, ascending."""
    if len(hashes) > 8 * SPANS:
        few = np.unique(hashes[hashes <= np.partition(hashes, 4 * SPANS)[4 * SPANS]])
        if len(few) >= SPANS:
            return few[:SPANS]
    return np.unique(hashes)[:SPANS]


def _shared_rung(steps: list[int], a: np.ndarray, b: np.ndarray) -> int:
    """The longest rung at which two ladders agree: below it they do at each."""
    low, high = 0, len(steps)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[middle - 1] == b[middle - 1] else (low, middle - 1)
    return steps[low - 1] if low else 0


def likeness(a: bytes, b: bytes) -> float:
    """How much two texts have in common, by their fingerprints: 1 for equal texts alone, 0 for nothing.

    The greater of two shares of both texts' characters: those before the first and after the last difference, from
    below within the root of two; and those in common spans, as the samples estimate it.
    """
    if a == b:
        return 1.0
    n, m = int.from_bytes(a[:6], "big"), int.from_bytes(b[:6], "big")
    if not n or not m:
        return 0.0
    more, fewer = len(rungs(max(n, m))), rungs(min(n, m))
    x, y = (np.frombuffer(f, ">u4", offset=14) for f in (a, b))
    k, i, j = len(fewer), more if n >= m else len(fewer), more if m >= n else len(fewer)
    ends = min(_shared_rung(fewer, x[:k], y[:k]) + _shared_rung(fewer, x[i : i + k], y[j : j + k]), n, m)
    mine, other = set(x[2 * i :].tolist()), set(y[2 * j :].tolist())
    union = sorted(mine | other)[:SPANS]
    shared = sum(h in mine and h in other for h in union) / len(union)
    return min(max(2 * ends / (n + m), 2 * shared / (1 + shared)), 1 - 1 / (n + m + 1))


def fingerprints(docs: DataFrame, name: str = "fingerprint") -> DataFrame:
    """docs with a column `name`, lower-case hex: each text's fingerprint. A null text is an empty one; a column of that name is replaced."""
    small_batches(docs.sparkSession)
    mark = F.pandas_udf(lambda texts: texts.map(lambda t: fingerprint(t or "").hex()), "string")
    return docs.withColumn(name, mark(F.coalesce(F.col("text").cast("string"), F.lit(""))))


#: A row without doc_id stands where the least long does.
LEAST = -(1 << 63)


def _ranges(keys: DataFrame, parts: int) -> tuple[list[tuple[int, int]], tuple[int, int], list[int]]:
    """Ends of ranges of keys (id, tie), all but the last; the greatest key; and ids that more than a part's share of rows have.

    What is collected is a row for each range. An end is a row of the table, so that what comes right after it is in the next
    range; a frequent id has ends among its ties too.
    """
    shares = [k / parts for k in range(1, parts)] or [0.5]
    found = keys.agg(F.percentile_approx("id", shares, 10 * parts + 1000).alias("cuts"), F.count("*").alias("n")).first()
    if not found["n"]:
        return [], (LEAST, LEAST), []
    # cuts are rounded to doubles, so each stands for the greatest key up to it
    cuts = [(c, (1 << 63) - 1) for c in sorted(set(found["cuts"]))] if parts > 1 else []
    part = _count_below(cuts, F.col("id"), F.col("tie")) if cuts else F.lit(0)
    ends = {tuple(r["end"]) for r in keys.groupBy(part.alias("part")).agg(F.max(F.struct("id", "tie")).alias("end")).collect()}
    counts = keys.groupBy("id").agg(F.count("*").alias("n"))
    often = {r["id"]: r["n"] for r in counts.filter(F.col("n") * parts > found["n"]).collect()}
    if often:
        split = keys.filter(F.col("id").isin(list(often))).groupBy("id").agg(F.percentile_approx("tie", shares, 10 * parts + 1000).alias("cuts"), F.max("tie").alias("last")).collect()
        for r in split:
            step = max(1, found["n"] // often[r["id"]])
            ends |= {(r["id"], t) for t in [*r["cuts"][step - 1 :: step], r["last"]]}
    last = max(ends)
    return sorted(ends - {last}), last, sorted(often)


def _array(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")  # folded into one literal


def _count_below(ends: list[tuple[int, int]], ident: Column, tie: Column) -> Column:
    """How many of the ascending ends are below a key: in steps of the root of their number."""

    def below(pairs: Column) -> Column:
        return F.size(F.filter(pairs, lambda e: (e["i"] < ident) | ((e["i"] == ident) & (e["t"] < tie))))

    step = max(1, int(len(ends) ** 0.5))
    pairs = lambda some: F.arrays_zip(_array([i for i, _ in some]).alias("i"), _array([t for _, t in some]).alias("t"))
    coarse = below(pairs(ends[::step]))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + below(F.slice(pairs(ends), (coarse - 1) * step + 1, F.lit(step))))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of documents (doc_id, text).

    The next document is that of the next smaller doc_id; after the last comes the first. The edited text has the first half of
    n_chars // 2 characters of the next one's text, or all of a shorter one, in place of as many at its end. likeness()
    compares the fingerprint with that of the edited text, and of the next document.

    Rows are dealt by ranges of doc_id, as many as spark.sql.shuffle.partitions, and each range gets the row that
    comes after it, too: texts are shuffled once. A null text is an empty one. Texts of one doc_id follow each other by a hash;
    rows alike in doc_id and text are one document with as many equal rows, and where they are a part's share of all, they are
    counted before they are dealt. Rows without doc_id come after all others. A single document is its own next one. An empty table
    stays empty; other columns are not looked at. Of a text, a block at a time is hashed; it and the next one are in memory.
    """
    spark = docs.sparkSession
    small_batches(spark)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("id"), F.col("doc_id").isNull().alias("nameless"), text.alias("text"), F.shiftrightunsigned(F.xxhash64(text), 12).alias("tie"))
    ends, last, often = _ranges(rows.select("id", "tie"), parts)
    rows = rows.withColumn("copies", F.lit(1).cast("long"))
    if often:
        alike = rows.filter(F.col("id").isin(often)).groupBy("id", "nameless", "text", "tie").agg(F.count("*").alias("copies"))
        rows = rows.filter(~F.col("id").isin(often)).unionByName(alike)
    ident, tie = F.col("id"), F.col("tie")
    place = _count_below(ends, ident, tie) if ends else F.lit(0)
    rows = rows.withColumn("range", place)
    is_end = F.lit(False)
    if ends:
        pair = lambda k: F.get(_array([e[k] for e in ends]), F.col("range"))
        is_end = (F.col("range") < len(ends)) & (pair(0) == ident) & (pair(1) == tie)
    is_last = (ident == last[0]) & (tie == last[1])
    goes = lambda at, ahead: F.struct(F.when(ahead, at).alias("range"), F.lit(True).alias("ahead"))
    places = F.array(F.struct(F.col("range"), F.lit(False).alias("ahead")), goes(F.col("range") + 1, is_end), goes(F.lit(0), is_last))
    dealt = rows.withColumn("to", F.explode(F.filter(places, lambda p: p["range"].isNotNull()))).select("to.range", "to.ahead", "id", "tie", "nameless", "copies", "text")
    dealt = dealt.repartitionById(len(ends) + 1, F.col("range").cast("int")).sortWithinPartitions("range", F.desc("ahead"), "id", "tie", "text")
    names = ["doc_id", "copies", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compared(stream):
        at = key = before = here = made = None  # before and here: text and fingerprint of the next document and of this one
        for batch in stream:
            out = []
            for r in batch.to_pylist():
                if r["range"] != at:
                    at, key, before, here, made = r["range"], None, None, None, None
                if r["ahead"]:
                    if before is None or before[0] != r["text"]:
                        before = (r["text"], fingerprint(r["text"]))
                    continue
                if key != (r["id"], r["text"]):
                    before = before if key is None else here
                    key, here = (r["id"], r["text"]), (r["text"], fingerprint(r["text"]))
                    made = _compared(here, before)
                out.append((None if r["nameless"] else r["id"], r["copies"], *made))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            columns = list(zip(*out, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    done = dealt.mapInArrow(compared, "doc_id long, copies long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return done.withColumn("copies", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).drop("copies") if often else done.drop("copies")


def _compared(here: tuple[str, bytes], after: tuple[str, bytes]) -> tuple:
    text, mark = here
    half = len(text) // 2
    edited = text[: len(text) - half] + after[0][:half]
    other = mark if edited == text else fingerprint(edited)
    return len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), mark.hex(), other.hex(), likeness(mark, other), likeness(mark, after[1])
