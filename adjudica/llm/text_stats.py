"""Column expressions over whole texts that quality operators share. All are built-in functions, linear in the text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from adjudica.llm.common import SPACE, WORD

#: Character classes of the histograms, as patterns; the last class is the rest, lower-case ASCII letters above all.
CLASSES = {
    "upper": "A-ZÀ-ÖØ-Þ",
    "digit": "0-9",
    "stop": ".,",
    "mark": "!?",
    "symbol": "#*$%&|<>",
    "beyond": r"\x{80}-\x{BF}×ß-\x{10FFFF}",
}

#: Runs of what most characters are; classes are counted in the little that is left without them.
COMMON_RUNS = r"[a-z\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text; none of a null one."""
    return F.filter(split_words(text), lambda w: w != "")  # a lambda is computed once, however often it is named


def split_words(text: Column) -> Column:
    """A text's words, and an empty one where white space begins or ends it."""
    return F.split(F.coalesce(text, F.lit("")), f"{SPACE}+")


def word_chars(words_of: Column) -> Column:
    """Characters of all words."""
    return F.length(F.array_join(words_of, ""))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(WORD))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeated_words(words_of: Column, n: Column, width: int = 8) -> Column:
    """Words inside windows of `width` (a power of two) words that occur twice or more in the text, the first included.

    A window is known by a 64-bit hash, made of the hashes of its halves. Texts without a repeated word, pair or window,
    nearly all, end at a count of distinct hashes.
    """
    def covered(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = let(ordered, lambda s: F.transform(F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])), lambda x: x["i"]))
        steps = let(F.array_sort(twice), lambda p: F.transform(p, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(p, i + 1) - x, F.lit(width)))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    def repeats(h: Column, k: int, size: Column) -> Column:
        """h holds hashes of k neighbouring words: where all differ, so do all longer windows."""
        longer = covered(h) if k == width else let(F.zip_with(F.slice(h, F.lit(1), size - k), F.slice(h, F.lit(1 + k), size - k), lambda a, b: F.xxhash64(a, b)), lambda x: repeats(x, 2 * k, size - k))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(longer)

    found = let(F.transform(words_of, lambda w: F.xxhash64(w)), lambda h: repeats(h, 1, n))
    return F.when(n > width, found).otherwise(F.lit(0)).cast("long")


def uncommon(text: Column) -> Column:
    """A text without white space and lower-case ASCII letters."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), COMMON_RUNS, "")


def characters(left: Column, of: str) -> Column:
    """How many characters are in a class, given as the inside of a pattern's brackets."""
    return F.length(F.regexp_replace(left, f"[^{of}]+", ""))


def class_counts(left: Column, chars: Column) -> Column:
    """Counts of the character classes, by a text's uncommon(), among the so many characters of its words; the last is the rest.

    One class after another is taken out, so that each pattern meets only what is left.
    """

    def taken(text: Column, patterns: list[str], counts: list[Column]) -> Column:
        if not patterns:
            return F.array(*counts, chars - sum(counts[1:], counts[0]))
        return let(F.regexp_replace(text, f"[{patterns[0]}]+", ""), lambda rest: taken(rest, patterns[1:], [*counts, (F.length(text) - F.length(rest)).cast("double")]))

    return let(left, lambda text: taken(text, list(CLASSES.values()), []))


def js_term(a: Column, b: Column) -> Column:
    """What a cell of two histograms, with shares a and b, adds to their Jensen-Shannon divergence (base 2)."""
    m = (a + b) / 2
    part = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    return (part(a) + part(b)) / 2


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms of shares, as arrays of one length."""
    total = F.aggregate(F.zip_with(p, q, js_term), F.lit(0.0), lambda a, b: a + b)
    return F.sqrt(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))
