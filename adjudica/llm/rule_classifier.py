"""Quality classifier as a sparse ensemble of rules.

Statistics of texts are built-in functions. Shallow boosted trees are fitted on a bounded, hash-ordered sample of
labelled documents; every path from a root becomes a conjunctive rule; a logistic regression with a lasso penalty keeps
few of the rules; and those are compiled into one column expression, so that scoring never leaves the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.llm.common import columns_of
from adjudica.llm.text_stats import CLASSES, characters, uncommon, word_chars, words

#: Labelled documents that the model is fitted on, at most; trees, their depth and shrinkage; lasso weight and steps.
SAMPLE_ROWS = 20_000
TREES, DEPTH, SHRINK, BINS = 30, 3, 0.3, 32
LASSO, STEPS = 1e-3, 400


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """_row, a struct of df's columns, and the FEATURES of its text as doubles, under names with a leading _s_.

    Those of an empty or null text are 0.
    """
    raw = F.coalesce(F.col(text).cast("string"), F.lit(""))
    kept = [F.col("_row")]  # a struct, so that no name in it can clash
    step = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), raw.alias("_text"), words(raw).alias("_w"), uncommon(raw).alias("_left"), F.split(raw, "\n").alias("_lines"))
    one = lambda name, of: characters(F.col("_left"), of).cast("double").alias(name)
    but_last, but_first = F.slice("_w", F.lit(1), F.greatest(F.size("_w") - 1, F.lit(0))), F.slice("_w", F.lit(2), F.greatest(F.size("_w") - 1, F.lit(0)))
    step = step.select(
        *kept, F.size("_w").cast("double").alias("_n"), word_chars(F.col("_w")).cast("double").alias("_c"), F.size("_lines").cast("double").alias("_l"),
        one("_upper", CLASSES["upper"]), one("_digits", CLASSES["digit"]), one("_marks", CLASSES["mark"]), one("_symbols", CLASSES["symbol"]),
        one("_periods", "."), one("_commas", ",;:"), one("_beyond", r"\x{80}-\x{10FFFF}"),
        F.size(F.array_distinct("_w")).cast("double").alias("_distinct"), F.size(F.filter("_w", lambda x: F.length(x) <= 3)).cast("double").alias("_short"),
        F.size(F.filter(F.zip_with(but_last, but_first, lambda a, b: a == b), lambda x: x)).cast("double").alias("_stutter"),
        F.size(F.array_distinct("_lines")).cast("double").alias("_distinct_lines"),
    )
    values = {
        "log_words": F.log1p("_n"), "word_length": _ratio("_c", "_n"), "upper": _ratio("_upper", "_c"), "digits": _ratio("_digits", "_c"),
        "marks": _ratio("_marks", "_c"), "symbols": _ratio("_symbols", "_c"), "periods": _ratio("_periods", "_c"), "commas": _ratio("_commas", "_c"),
        "beyond": _ratio("_beyond", "_c"), "lines": _ratio("_l", "_n"), "distinct": _ratio("_distinct", "_n"), "short": _ratio("_short", "_n"),
        "stutter": _ratio("_stutter", "_n"), "distinct_lines": _ratio("_distinct_lines", "_l"),
    }
    return step.select(*kept, *[values[f].alias(f"_s_{f}") for f in FEATURES])


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)


FEATURES = ("log_words", "word_length", "upper", "digits", "marks", "symbols", "periods", "commas", "beyond", "lines", "distinct", "short", "stutter", "distinct_lines")

#: A condition (feature, is above, threshold); a rule is a conjunction of them.
Condition = tuple[str, bool, float]


@dataclass(frozen=True)
class Model:
    bias: float
    rules: tuple[tuple[float, tuple[Condition, ...]], ...]

    def score(self) -> Column:
        """The probability of label 1, over the columns of with_statistics()."""
        z = F.lit(self.bias)
        for weight, rule in self.rules:
            test = F.lit(True)
            for name, above, at in rule:
                x = F.col(f"_s_{name}")
                test = test & ((x > at) if above else (x <= at))
            z = z + F.when(test, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-z))


def _tree(binned: np.ndarray, target: np.ndarray, rows: np.ndarray, depth: int) -> list:
    """A regression tree over binned features: [mean] or [mean, feature, bin, low side, high side]."""
    mean = float(target[rows].mean())
    if depth == 0 or len(rows) < 40:
        return [mean]
    best = (1e-9, 0, 0)
    y = target[rows] - mean
    for f in range(binned.shape[1]):
        b = binned[rows, f]
        n = np.cumsum(np.bincount(b, minlength=BINS))[:-1]
        s = np.cumsum(np.bincount(b, weights=y, minlength=BINS))[:-1]
        ok = (n >= 10) & (len(rows) - n >= 10)
        gain = np.where(ok, s**2 / np.maximum(n, 1) + s**2 / np.maximum(len(rows) - n, 1), 0.0)
        k = int(gain.argmax())
        if gain[k] > best[0] * (1 + 1e-9):
            best = (float(gain[k]), f, k)
    if best[0] <= 1e-6 * len(rows):
        return [mean]
    _, f, k = best
    high = binned[rows, f] > k
    return [mean, f, k, _tree(binned, target, rows[~high], depth - 1), _tree(binned, target, rows[high], depth - 1)]


def _predict(tree: list, binned: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(binned), tree[0])
    return np.where(binned[:, tree[1]] > tree[2], _predict(tree[4], binned), _predict(tree[3], binned))


def _paths(tree: list, path: tuple = ()):
    if path:
        yield path
    if len(tree) > 1:
        yield from _paths(tree[3], (*path, (tree[1], False, tree[2])))
        yield from _paths(tree[4], (*path, (tree[1], True, tree[2])))


def fit_rules(x: np.ndarray, y: np.ndarray, names: tuple[str, ...] = FEATURES, seed: int = 7) -> Model:
    """Fits the ensemble on statistics x (rows, features) and labels y (0 or 1). Reruns on the same rows agree.

    Without rows, the model says a half of everything; with labels of one kind, about their share.
    """
    if not len(y):
        return Model(0.0, ())
    y = y.astype(np.float64)
    base = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    bias = float(np.log(base / (1 - base)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)  # bin k: at most cuts[k]
    random = np.random.default_rng(seed)
    margin, found = np.full(len(y), bias), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        rows = np.sort(random.choice(len(y), size=max(1, len(y) // 2), replace=False))
        tree = _tree(binned, (y - p) / np.maximum(p * (1 - p), 0.05), rows, DEPTH)
        margin = margin + SHRINK * np.clip(_predict(tree, binned), -4, 4)
        for path in _paths(tree):
            found.setdefault(tuple(sorted(path)), None)
    rules = [r for r in found if all(k < len(cuts[f]) for f, _, k in r)]
    columns, kept = [], {}
    for rule in rules:
        on = np.ones(len(y), dtype=bool)
        for f, above, k in rule:
            on &= (binned[:, f] > k) == above
        if 0 < on.sum() < len(y) and on.tobytes() not in kept:
            kept[on.tobytes()] = rule
            columns.append(on)
    if not columns:
        return Model(bias, ())
    m = np.stack(columns, axis=1).astype(np.float64)
    bias, weights = _lasso(m, y, bias)
    named = lambda rule: tuple((names[f], above, float(cuts[f][k])) for f, above, k in rule)
    return Model(bias, tuple((float(w), named(r)) for w, r in zip(weights, kept.values(), strict=True) if w))


def _lasso(m: np.ndarray, y: np.ndarray, bias: float) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on the weights, by accelerated proximal gradients."""
    n = len(y)
    step = 1 / (0.25 * (np.linalg.norm(m, 2) ** 2 / n + 1))
    w = v = np.zeros(m.shape[1])
    b = c = bias
    t = 1.0
    for _ in range(STEPS):
        error = 1 / (1 + np.exp(-(m @ v + c))) - y
        nw = v - step * (m.T @ error) / n
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * LASSO, 0)
        nb = c - step * error.mean()
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, c = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return float(b), w


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from learning: crc32 of its id as text, modulo 5, is 0."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns from labelled documents that are not held out: at most sample_rows of them, the first by a hash of doc_id.

    Labels that are null or neither 0 nor 1, or whose doc_id is null, are left out; of several labels of one document
    the larger counts, and of several texts each is a row, to the bound.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    usable = usable.filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id").limit(sample_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = with_statistics(texts.join(F.broadcast(chosen), "doc_id"))
    names = [f"_s_{f}" for f in FEATURES]
    got = rows.select("_row.doc_id", "_row.y", *names).orderBy("doc_id", *names).limit(2 * sample_rows).toPandas()
    return fit_rules(got[names].to_numpy(dtype=np.float64), got["y"].to_numpy())


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The columns of docs with score and predicted (1 from the threshold on). Null and empty texts get a score too.

    Columns of docs that are named score or predicted are replaced.
    """
    columns = [c for c in docs.columns if c not in ("score", "predicted")]
    scored = with_statistics(docs.select(*[F.col(f"`{c}`") for c in columns]))
    scored = scored.select(*[F.col(f"_row.`{c}`") for c in columns], model.score().alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int"))


def drop_low_quality(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of docs that score() predicts to be of label 1; columns of any name stay as they are."""
    # a numbered row keeps the filter above the statistics: below them, it would compute them anew for each rule
    scored = with_statistics(docs).select("_row", model.score().alias("_score"), F.monotonically_increasing_id().alias("_place"))
    return scored.filter(F.col("_score") >= threshold).select(*columns_of(docs))
