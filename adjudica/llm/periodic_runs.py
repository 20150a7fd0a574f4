"""Periodic runs in texts: stretches of words that repeat with a period, found by counting matches at each lag.

1. For every lag up to a quarter of the text, how many words equal the one that far on: an exact autocorrelation. Frequent
   words add theirs by FFT, one transform a word; rare ones by the differences of their positions, pair by pair.
2. A run of period q and four periods or more has 3 q matches in a row at lag q. Only lags with that many are looked at.
   Matches inside runs already found, at multiples of their periods, are taken off first: Fine and Wilf's theorem says that no
   run of a greater smallest period needs them. So one word a million times over costs one scan, not one for each lag.
3. Islands of matches are looked for with a stride of a sixteenth of the lag, then word by word where the strides all match.

Numpy on the words' numbers; each text is worked on by itself.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.llm.common import small_batches
from adjudica.llm.text_stats import let, words

#: A run has at least so many words, and so many periods.
MIN_WORDS, MIN_PERIODS = 6, 4
STRIDES = 16
#: Bytes of a text that are split into words at once, and words that are joined at once.
SLICE, JOINED = 1 << 20, 1 << 16
_SPACE = re.compile(rb"[\t-\r ]")
RUN = "struct<start: long, length: long, period: long>"


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def word_numbers(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The words of a text by number, and the words in the order of the numbers."""
    numbers, parts, at = _Numbers(), [], 0
    while at < len(text):
        cut = _SPACE.search(text, at + SLICE)
        end = cut.end() if cut else len(text)
        parts.append(np.array([numbers[w] for w in text[at:end].split()], np.int64))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), list(numbers)


def lag_matches(ids: np.ndarray, most: int) -> np.ndarray:
    """For lags 0 to most: how many i have ids[i] == ids[i + lag]. Exact: an FFT's error is far below a half here.

    A word is frequent where its pairs would cost more than a transform.
    """
    counts = np.zeros(most + 1, np.int64)
    counts[0] = len(ids)
    size = 1 << int(len(ids) + most).bit_length()
    often = np.bincount(ids)
    limit = (size * size.bit_length() / 4) ** 0.5
    heavy = np.flatnonzero(often > limit)
    if len(heavy):
        power = np.zeros(size // 2 + 1)
        for word in heavy:
            f = np.fft.rfft(ids == word, size)
            power += f.real**2 + f.imag**2
        counts[1:] += np.rint(np.fft.irfft(power, size)[1 : most + 1]).astype(np.int64)
    place = np.flatnonzero((often[ids] > 1) & (often[ids] <= limit))
    place = place[np.argsort(ids[place], kind="stable")]
    word = np.append(ids[place], -1)
    active, hop, waiting, held = np.arange(len(place)), 1, [], 0
    while len(active):
        active = active[active + hop < len(word)]
        active = active[word[active + hop] == word[active]]
        apart = place[active + hop] - place[active]
        near = apart <= most
        active, apart = active[near], apart[near]
        waiting.append(apart)
        held += len(apart)
        if held > most:
            counts += np.bincount(np.concatenate(waiting), minlength=most + 1)
            waiting, held = [], 0
        hop += 1
    if waiting:
        counts += np.bincount(np.concatenate(waiting), minlength=most + 1)
    return counts


def _stretches(equal: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Ranges of True that are least long or longer."""
    edge = np.diff(equal.astype(np.int8), prepend=0, append=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - begin >= least
    return list(zip(begin[long].tolist(), end[long].tolist(), strict=True))


def islands(ids: np.ndarray, lag: int, least: int) -> list[tuple[int, int]]:
    """Ranges of at least so many i in a row with ids[i] == ids[i + lag]."""
    step, n = max(1, lag // STRIDES), len(ids) - lag
    if step == 1:
        return _stretches(ids[:n] == ids[lag:], least)
    out = []
    for a, b in _stretches(ids[:n:step] == ids[lag::step], least // step):
        low, high = max(0, (a - 1) * step + 1), min(n, b * step)
        out += [(low + x, low + y) for x, y in _stretches(ids[low:high] == ids[low + lag : high + lag], least)]
    return out


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    n, found, ends = len(ids), [], set()
    if n < MIN_WORDS:
        return found
    most = n // MIN_PERIODS
    counts = lag_matches(ids, most)
    lags = np.arange(most + 1)
    least = np.maximum(MIN_WORDS, MIN_PERIODS * lags) - lags
    for q in (np.flatnonzero(counts[1:] >= least[1:]) + 1).tolist():
        if counts[q] < least[q]:
            continue  # what is left of its matches is inside runs of shorter periods
        for begin, end in islands(ids, q, int(least[q])):
            length = end - begin + q
            if (begin, length) not in ends:  # else a shorter period's run
                ends.add((begin, length))
                found.append((begin, length, q))
                again = np.arange(2 * q, min(most, length - 1) + 1, q)
                counts[again] -= length - again
    return sorted(found, key=lambda r: (r[0], r[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period, compared exactly; of equal ones the first, then that of the least period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words no run contains after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


def _collapsed(ids: np.ndarray, vocabulary: list[bytes], kept: np.ndarray) -> bytes:
    left = ids[kept]
    return b" ".join(b" ".join([vocabulary[k] for k in left[at : at + JOINED].tolist()]) for at in range(0, len(left), JOINED))


def collapse_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs, strongest and collapsed, for every row of docs (doc_id, text).

    runs lists (start, length, period) in words from 0, by start and period: stretches with a smallest period that no
    neighbour continues, of four periods and six words at least. strongest is the run of the most periods, null without any.
    collapsed is the text with one period left of each run, its words parted by one space; a text without runs, too, is
    parted so. A null or empty text has no words, no runs and an empty collapsed text. Repeated rows have equal results;
    an empty table stays empty; other columns are not looked at. A text is split in slices; its words' numbers and one
    transform, some 60 bytes a word, are in memory at once, so very long texts cost time in proportion to n log n.
    """
    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    as_run = lambda r: dict(zip(("start", "length", "period"), r, strict=True)) if r else None
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(stream):
        for batch in stream:
            counts, every, best, texts = [], [], [], []
            for text in batch.column("text"):
                ids, vocabulary = word_numbers(text.as_py())
                runs = find_runs(ids)
                counts.append(len(ids))
                every.append([as_run(r) for r in runs])
                best.append(as_run(strongest(runs)))
                texts.append(_collapsed(ids, vocabulary, _kept(len(ids), runs)))
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(every, pa.list_(run)), pa.array(best, run), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "strongest", "collapsed"])

    found = slim.mapInArrow(search, f"doc_id long, n_words long, runs array<{RUN}>, strongest {RUN}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; where the crc32 h of the decimal doc_id ends in 0, and the text has n > 0 words, the end of it repeats.

    With g = h / 10 in whole numbers, the words from a = g % n on repeat the first p = 1 + (n - a) / (3 + g % 8) of them. A row without doc_id stays as it is.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(w):
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a), tail), " ")).otherwise(text)

    return docs.select(doc_id.alias("doc_id"), F.when(h % 10 == 0, let(words(text), repeated)).otherwise(text).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run's numbers, and hashes of all runs and of the collapsed text."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
