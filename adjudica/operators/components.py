"""Connected components of a graph, and groups numbered by first appearance."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adjudica.operators.scale import numbered, skew_join
from adjudica.storage import written

#: Edges up to so many are no matter for rounds over all tasks, which cost the same however few rows they move: one task joins them.
FEW = 200_000
_PLAIN = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and label, the least node of its component, for every node of the edges; an edge to itself makes a node.

    Large-star and small-star rounds in turn, each written out, until all edges lead straight to a node that leads nowhere:
    a number of rounds that grows with the logarithm of the graph, none if the edges are such stars already. Edges of
    hubs are split over tasks; nothing is collected. FEW edges are joined by one task at once.
    """
    edges = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    edges = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    if isinstance(edges.schema["u"].dataType, _PLAIN) and edges.count() <= FEW:
        return written(_joined(edges), "labels")
    loops = edges.filter("u = v").select(F.col("u").alias("node"))
    edges = edges.filter("u <> v")
    while (n := _unfinished(edges)) is not None:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = skew_join(both, least, "u", "n", 2 * n, "v").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = skew_join(large, least, "u", "n", large.count(), "v").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    labels = stars.union(edges.select("v", F.col("v").alias("label")).distinct())
    return labels.union(loops.select("node", F.col("node").alias("label")).join(labels.select("node"), "node", "left_anti"))


def _joined(edges: DataFrame) -> DataFrame:
    """components() of FEW edges (u, v), by one task."""
    def joined(stream):
        batches = [batch for batch in stream if len(batch)]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        ends = pa.chunked_array([*table["u"].chunks, *table["v"].chunks]).combine_chunks()
        names = ends.unique()
        names = names.take(pc.sort_indices(names))
        at = pc.index_in(ends, names).to_numpy().reshape(2, -1)
        label = np.arange(len(names))
        while True:  # labels take the least that an edge leads them to, then each node follows its label to the end
            new = label.copy()
            for side in at:
                np.minimum.at(new, label[side], np.minimum(label[at[0]], label[at[1]]))
            while not np.array_equal(far := new[new], new):
                new = far
            if np.array_equal(new, label):
                break
            label = new
        yield pa.RecordBatch.from_arrays([names, names.take(pa.array(label))], names=["node", "label"])

    kind = edges.schema["u"].dataType.simpleString()
    return edges.coalesce(1).mapInArrow(joined, f"node {kind}, label {kind}")


def _unfinished(edges: DataFrame) -> int | None:
    """The number of edges (u, v), u > v, or None where each u has one v, and no v is a u."""
    by_u = edges.groupBy("u").agg(F.count("*").alias("n"))  # whoever is a v of others meets this once
    n, several = by_u.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum((F.col("n") > 1).cast("int")), F.lit(0))).first()
    if several:
        return n
    return n if by_u.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").limit(1).count() else None


def numbered_groups(labels: DataFrame, order: DataFrame, prefix: str) -> DataFrame:
    """Adds group_id, prefix and four digits, to (node, label); groups are numbered by their first place in order (node, place)."""
    firsts = labels.join(order, "node").groupBy("label").agg(F.min("place").alias("_first"))
    ids = numbered(firsts, ["_first", "label"], "_n").select("label", F.format_string(prefix + "_%04d", F.col("_n") + 1).alias("group_id"))
    return labels.join(ids, "label")


def star_clusters(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """center and node: clusters of linked nodes around centers, the center among its nodes; not transitive.

    Nodes come up in the order in which the ascending pairs name them. A node that no earlier center is linked to becomes
    a center, and all that is linked with it is its cluster, nodes of other clusters too. Nothing is collected.
    """
    edges = written(pairs.select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y")).filter("x <> y").distinct(), "pairs")
    both = edges.union(edges.select("y", "x"))
    smaller = F.min(F.when(F.col("y") < F.col("x"), F.col("y")))
    order = both.groupBy("x").agg(smaller.alias("l")).select(F.col("x").alias("node"), F.struct(F.coalesce("l", "x").alias("at"), F.when(F.col("l").isNotNull(), F.col("x")).alias("then")).alias("o"))
    left = order.select(F.col("node").alias("x"), F.col("o").alias("ox"))
    right = order.select(F.col("node").alias("y"), F.col("o").alias("oy"))
    earlier = written(both.join(left, "x").join(right, "y").filter("oy < ox").select("x", "y"), "earlier")  # y comes up before x
    centers = _independent(order.select("node"), earlier).filter("center").select(F.col("node").alias("center"))
    return centers.select("center", F.col("center").alias("node")).union(centers.join(both, F.col("center") == F.col("x")).select("center", F.col("y").alias("node")))


def _independent(nodes: DataFrame, earlier: DataFrame) -> DataFrame:
    """node and center: whether no y of the pairs (x, y) of earlier, which has no circle, is a center.

    A node without open y is a center, one with a y that is a center is none. A node with one open y is its opposite and
    is replaced by that wherever it is a y itself, so chains and trees halve with each round: their rounds grow with the
    logarithm of their depth. Only where nodes keep several open y after that does a round decide one layer.
    """
    open_ = earlier.select("x", "y", F.lit(False).alias("opposite"))  # x is no center where y is one, or where its opposite is
    done = None
    while True:
        terms = open_.groupBy("x", "y").agg(F.min("opposite").alias("opposite"), F.max("opposite").alias("_o"))
        true = F.col("y").isNull() | (F.col("opposite") != F.col("_o"))  # a y that is a center, or a node and its opposite
        by_x = terms.groupBy("x").agg(F.bool_or(true).alias("_true"), F.count("*").alias("_n"), F.min(F.struct("y", "opposite")).alias("_one"))
        center = F.when(F.col("_true"), False).when(F.col("_n").isNull(), True)
        j = nodes.join(by_x, F.col("node") == F.col("x"), "left")
        state = written(j.select("node", center.alias("center"), F.when(F.col("_n") == 1, F.col("_one")).alias("one")), "state")
        decided = state.filter("center is not null").select("node", "center")
        done = decided if done is None else done.union(decided)
        nodes = state.filter("center is null").select("node")
        if not nodes.limit(1).count():
            return done
        open_one = state.filter("center is null and one is not null").join(nodes.select(F.col("node").alias("_z")), F.col("one.y") == F.col("_z"), "left_semi").select("node", "one")
        y = state.select("node", "center").join(open_one, "node", "left").select(F.col("node").alias("y"), "center", "one")
        left = written(terms.select("x", "y", "opposite"), "terms").join(nodes.select(F.col("node").alias("x")), "x", "left_semi").join(y, "y")
        known = F.col("center").isNotNull()
        left = left.filter(~known | (F.col("center") != F.col("opposite")))
        # a y with one term is the opposite of it
        passed = F.when(known, F.lit(None)).when(F.col("one").isNotNull(), F.struct(F.col("one.y").alias("y"), (F.col("one.opposite") == F.col("opposite")).alias("opposite"))).otherwise(F.struct("y", "opposite"))
        open_ = written(left.select("x", passed.alias("_p")).select("x", F.col("_p.y").alias("y"), F.coalesce("_p.opposite", F.lit(False)).alias("opposite")), "open")
