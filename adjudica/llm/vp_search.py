"""Nearest neighbours by vantage-point trees, one for each shard of the candidates.

Vectors are brought to length 1, where the Euclidean distance orders as the cosine does. A tree's node keeps a vantage
point, splits the other points at the median distance to it, and remembers the least and largest distance on each
side. By the triangle inequality a side can be skipped when its bound, times a factor, exceeds the distance of the
worst of the k found so far: factor 1 keeps the search exact, a larger one prunes more and may miss neighbours.
Shards and blocks of queries have bounded sizes; each shard meets each block of queries in a task of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adjudica.llm.common import ship, written

#: Vectors of a shard and queries of a block, about; points of a leaf.
SHARD_ROWS = 8192
BLOCK_ROWS = 1024
LEAF = 256
#: What rounding can move a distance by.
ROUNDING = 1e-6


def build(unit: np.ndarray, leaf: int = LEAF, seed: int = 3) -> tuple[np.ndarray, list]:
    """The order of rows and the tree over it: (begin, end) or (begin, end, vantage row, low/high bounds, inner, outer).

    unit: rows of length 1. Inner and outer halves have as many points, ties of the median anywhere.
    """
    order = np.arange(len(unit))
    random = np.random.default_rng(seed)

    def split(begin: int, end: int):
        if end - begin <= leaf:
            return (begin, end)
        rows = order[begin:end]
        tried = random.choice(rows, size=min(8, len(rows)), replace=False)
        probe = unit[random.choice(rows, size=min(128, len(rows)), replace=False)]
        vantage = int(tried[int(np.argmax([np.var(_distances(probe, unit[v])) for v in tried]))])
        d = _distances(unit[rows], unit[vantage])
        by = np.argsort(d, kind="stable")
        order[begin:end] = rows[by]
        middle = (end - begin) // 2
        d = d[by]
        bounds = (float(d[0]), float(d[middle - 1]), float(d[middle]), float(d[-1]))
        return (begin, end, vantage, bounds, split(begin, begin + middle), split(begin + middle, end))

    return order, split(0, len(unit)) if len(unit) else (0, 0)


def _distances(rows: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (rows @ to)))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows of a and b in double precision, summed from the first component to the last."""
    dot, na, nb = (np.zeros(len(a)) for _ in range(3))
    for k in range(a.shape[1]):
        x, y = a[:, k], b[:, k]
        dot += x * y
        na += x * x
        nb += y * y
    return np.clip(dot / np.sqrt(na * nb), -1.0, 1.0)


class Shard:
    """A tree over vectors with ids and numbers of their rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        by_id = np.lexsort((rows, ids))
        self.ids, self.rows, self.vectors = ids[by_id], rows[by_id], vectors[by_id].astype(np.float64)
        self.unit = self.vectors / np.sqrt((self.vectors**2).sum(axis=1))[:, None]
        self.order, self.tree = build(self.unit, leaf)

    def search(self, rows: np.ndarray, vectors: np.ndarray, k: int, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For queries of these rows: (place of the query, candidate id, cosine) of up to k nearest each, their own row left out."""
        vectors = vectors.astype(np.float64)
        unit = vectors / np.sqrt((vectors**2).sum(axis=1))[:, None]
        score, row = np.full((len(rows), k), -np.inf), np.full((len(rows), k), -1, dtype=np.int64)
        self.seen = 0

        def visit(node, active: np.ndarray) -> None:
            if not len(active):
                return
            if len(node) == 2:
                self._leaf(node, active, rows, vectors, unit, score, row)
                return
            _, _, vantage, (a, b, c, d), inner, outer = node
            far = _distances(unit[active], self.unit[vantage])
            first_inner = far <= (b + c) / 2
            to_inner, to_outer = np.maximum(0.0, np.maximum(a - far, far - b)), np.maximum(0.0, np.maximum(c - far, far - d))
            for one, other, bound, mine in ((inner, outer, to_outer, first_inner), (outer, inner, to_inner, ~first_inner)):
                own = active[mine]
                visit(one, own)
                worst = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * score[own, k - 1]))
                visit(other, own[bound[mine] * factor <= worst + ROUNDING])

        visit(self.tree, np.arange(len(rows)))
        q, c = np.nonzero(row >= 0)
        return q, self.ids[row[q, c]], score[q, c]

    def _leaf(self, node, active, rows, vectors, unit, score, row) -> None:
        """Takes a leaf's members into the best of the active queries. Rough cosines choose whom to measure exactly."""
        members = self.order[node[0] : node[1]]
        if not len(members):
            return
        self.seen += len(active) * len(members)
        rough = unit[active] @ self.unit[members].T
        rough[self.rows[members][None, :] == rows[active][:, None]] = -np.inf
        k = score.shape[1]
        known = np.concatenate([score[active], rough], axis=1)
        least = np.partition(known, known.shape[1] - k, axis=1)[:, known.shape[1] - k]
        q, m = np.nonzero((rough >= least[:, None] - ROUNDING) & np.isfinite(rough))
        if not len(q):
            return
        exact = cosine(vectors[active[q]], self.vectors[members[m]])
        oq, oc = np.nonzero(row[active] >= 0)
        all_q, all_row = np.concatenate([q, oq]), np.concatenate([members[m], row[active[oq], oc]])
        all_score = np.concatenate([exact, score[active[oq], oc]])
        by = np.lexsort((all_row, -all_score, all_q))  # rows are in the order of ids
        all_q, all_row, all_score = all_q[by], all_row[by], all_score[by]
        first = np.concatenate([[0], np.flatnonzero(np.diff(all_q)) + 1])
        nth = np.arange(len(all_q)) - np.repeat(first, np.diff(np.concatenate([first, [len(all_q)]])))
        top = nth < k
        score[active[all_q[top]], nth[top]], row[active[all_q[top]], nth[top]] = all_score[top], all_row[top]


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id and v (doubles) of vectors that can have a cosine: not null, not zero, every component finite; and an id."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = vectors.select(F.col(key).cast("long").alias("id"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("v", lambda x: x != 0))


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, factor: float = 1.0, key: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest by cosine of the rows whose key is divisible by `every`.

    Candidates are all rows but the query's own. Null, zero and non-finite vectors take no part, nor do rows without
    id; vectors are compared with those of their own length only. Rows that repeat an id are rows like others: a
    candidate each, and a query each, with ranks of its own. Ties go to the smaller id. Fewer candidates than k give
    fewer rows; an empty table none. Other columns, whatever their names, are not looked at.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = written(usable(vectors, key, vector).select("id", F.monotonically_increasing_id().alias("row"), "v", F.size("v").alias("dim")), "vectors")
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(F.col("id") % every == 0).alias("q")).filter("q > 0")
    sizes = sizes.select(F.col("dim").alias("_dim"), F.ceil(F.col("n") / shard_rows).cast("int").alias("shards"), F.ceil(F.col("q") / block_rows).cast("int").alias("blocks"))
    joined = rows.join(sizes, F.col("dim") == F.col("_dim"))
    at = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    shards = joined.select("id", "row", "v", "dim", at("shards").alias("shard"), "blocks")
    queries = joined.filter(F.col("id") % every == 0).select("id", "row", "v", "dim", at("blocks").alias("block"), "shards")

    def as_row(name, other):
        def make(table):
            v = np.asarray(table["v"].combine_chunks().flatten(), dtype="<f8").tobytes()
            first = table.slice(0, 1)
            numbers = {c: pa.array([np.asarray(table[c], dtype="<i8").tobytes()], pa.binary()) for c in ("id", "row")}
            return pa.table({"dim": first["dim"], name: first[name], other: first[other], "ids": numbers["id"], "rows": numbers["row"], "vectors": pa.array([v], pa.binary())})

        return make

    ddl = "dim int, {} int, {} int, ids binary, rows binary, vectors binary"
    index = shards.groupBy("dim", "shard").applyInArrow(as_row("shard", "blocks"), ddl.format("shard", "blocks"))
    asked = queries.groupBy("dim", "block").applyInArrow(as_row("block", "shards"), ddl.format("block", "shards"))
    # a row for each shard and block that meet; few and of bounded size
    parts = ["ids", "rows", "vectors"]
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select(F.col("dim").alias("_dim"), F.col("shard").alias("_shard"), *[F.col(c).alias(f"q_{c}") for c in parts])
    pairs = index.join(asked, (F.col("dim") == F.col("_dim")) & (F.col("shard") == F.col("_shard"))).select("dim", "shard", *parts, *[f"q_{c}" for c in parts])

    def searched(stream):
        last, shard = None, None
        for batch in stream:
            for r in batch.to_pylist():
                this = (r["dim"], r["shard"])
                longs = lambda c: np.frombuffer(r[c], dtype="<i8")  # noqa: B023, E731
                doubles = lambda c: np.frombuffer(r[c], dtype="<f8").reshape(-1, r["dim"])  # noqa: B023, E731
                if this != last:
                    shard, last = Shard(longs("ids"), longs("rows"), doubles("vectors")), this
                q, c, score = shard.search(longs("q_rows"), doubles("q_vectors"), k, factor)
                yield pa.RecordBatch.from_arrays([pa.array(longs("q_ids")[q]), pa.array(longs("q_rows")[q]), pa.array(c), pa.array(score)], names=["query_id", "query_row", "vec_id", "score"])

    found = pairs.repartition("dim", "shard").mapInArrow(searched, "query_id long, query_row long, vec_id long, score double")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
