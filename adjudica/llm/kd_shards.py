"""K-d tree shards: leaves of near equal bytes whose documents are alike in metadata.

Each document is a point: its coordinates are metadata columns brought to [0, 1]. A node is split at the weighted
median along its widest dimension, until leaves reach the target bytes. Medians come from distributed histograms of
byte weights that zoom in: all nodes of a level share each pass, which is one aggregate over a slim table, and the tree
is a table too, a row for each node of a level: nothing of it is collected. Where many documents share the median's
coordinate, a hash of the row's id and text splits them, and rows alike in both have hashes by their number among their
like, so neither one hot value nor many equal rows can unbalance a leaf. The place of a row in its file decides nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adjudica.llm.common import bucket_digits, hash_key, prefix_sums, repeated, written
from adjudica.operators.scale import numbered, skew_join

#: Cells of a histogram, and how often it zooms into the cell that holds the median: first by coordinate, then by hash.
CELLS = 256
ZOOMS = ("coordinate", "coordinate", "hash", "hash")
HASH_RANGE = float(1 << 32)
#: Nodes of a level, a row of some numbers each, that are broadcast at most; more meet their points by a shuffle.
BROADCAST_NODES = 10_000


def split_points(points: DataFrame, dims: list[str], leaves: int) -> DataFrame:
    """Adds first: the leaf, from 0, that each point (columns dims in [0, 1], tie in [0, 2^32), size) falls into.

    A node is named by its first leaf and has so many leaves. An odd number of leaves is shared out as evenly as can be,
    and the cut moves from the median to that share. Leaves have near equal sizes.
    """
    points = points.withColumn("first", F.lit(0)).withColumn("leaves", F.lit(leaves))
    nodes = 1
    for _ in range((leaves - 1).bit_length()):
        nodes = min(2 * nodes, leaves)
        state = written(_start(points.filter("leaves > 1"), dims), "nodes")
        for i, zoom in enumerate(ZOOMS):
            state = written(_zoom(_at_node(points.filter("leaves > 1"), state, nodes), state, dims, zoom, i + 1 == len(ZOOMS)), "nodes")
        state = written(_ends(state), "cuts")
        points = written(_descend(_at_node(points, state, nodes, "left"), dims).select(*points.columns), "points")
    return points.drop("leaves")


def _extents(dims: list[str]) -> list[Column]:
    return [f(d).alias(f"{f.__name__}_{i}") for i, d in enumerate(dims) for f in (F.min, F.max)]


def _start(points: DataFrame, dims: list[str]) -> DataFrame:
    """A row for each node that is to be split: its widest dimension, the ends there, and the weight below the cut."""
    found = points.groupBy("first", "leaves").agg(F.sum("size").alias("w"), *_extents(dims))
    sides = F.array(*[F.struct((F.col(f"max_{i}") - F.col(f"min_{i}")).alias("width"), F.lit(-i).alias("order"), F.col(f"min_{i}").alias("low"), F.col(f"max_{i}").alias("high")) for i in range(len(dims))])
    widest = F.array_max(sides)
    goal = F.col("w") * F.floor(F.col("leaves") / 2) / F.col("leaves")
    return found.select("first", (-widest["order"]).alias("dim"), widest["low"].alias("low"), widest["high"].alias("high"), F.lit(0.0).alias("hash_low"), F.lit(HASH_RANGE).alias("hash_high"), goal.cast("double").alias("goal"))


def _at_node(points: DataFrame, state: DataFrame, nodes: int, how: str = "inner") -> DataFrame:
    """Points with what is known of their node, under names with a leading _."""
    state = state.select(*[F.col(c).alias(f"_{c}") for c in state.columns])
    return points.join(F.broadcast(state) if nodes <= BROADCAST_NODES else state, F.col("first") == F.col("_first"), how)


def _coordinate(dims: list[str]) -> Column:
    return F.element_at(F.array(*[F.col(d) for d in dims]), F.col("_dim") + 1)


def _zoom(at_node: DataFrame, state: DataFrame, dims: list[str], zoom: str, last: bool) -> DataFrame:
    """One pass: a histogram of the part of each node that still holds the cut, and in it the cell that does."""
    x = _coordinate(dims)
    inside = (x >= F.col("_low")) & (x <= F.col("_high"))
    if zoom == "hash":
        low, high, at = F.col("_hash_low"), F.col("_hash_high"), F.col("tie")
        inside = inside & (at >= low) & (at < high)
    else:
        low, high, at = F.col("_low"), F.col("_high"), x
        inside = inside & (low < high)
    cell = F.least(F.lit(CELLS - 1), F.floor((at - low) / (high - low) * CELLS)).cast("int")
    cells = at_node.filter(inside).groupBy(F.col("first").alias("_node"), cell.alias("_cell")).agg(F.sum("size").alias("_w"), F.min(x).alias("_x0"), F.max(x).alias("_x1"))
    before = F.coalesce(F.sum("_w").over(Window.partitionBy("_node").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = cells.withColumn("_before", before).join(state.select(F.col("first").alias("_of"), F.col("goal").alias("_goal")), F.col("_node") == F.col("_of"))
    chosen = chosen.filter("_before <= _goal and _goal < _before + _w").select("_node", "_cell", "_before", "_w", "_x0", "_x1")
    both = state.join(chosen, F.col("first") == F.col("_node"), "left")
    goal = F.col("goal") - F.coalesce("_before", F.lit(0))
    if zoom != "hash":
        return both.select("first", "dim", F.coalesce("_x0", "low").alias("low"), F.coalesce("_x1", "high").alias("high"), "hash_low", "hash_high", goal.alias("goal"))
    width = (F.col("hash_high") - F.col("hash_low")) / CELLS
    nearer = F.when(2 * goal > F.col("_w"), 1).otherwise(0) if last else F.lit(0)  # the last cell is about one row: the nearer side
    low = F.when(F.col("_cell").isNull(), F.col("hash_low")).otherwise(F.col("hash_low") + (F.col("_cell") + nearer) * width)
    return both.select("first", "dim", "low", "high", low.alias("hash_low"), F.when(F.col("_cell").isNull(), F.col("hash_high")).otherwise(low + width).alias("hash_high"), goal.alias("goal"))


def _ends(state: DataFrame) -> DataFrame:
    return state.select("first", "dim", "low", "high", F.col("hash_low").alias("hash"))


def _descend(at_node: DataFrame, dims: list[str]) -> DataFrame:
    """Each point in the child of its node that it falls into. Between low and high of a cut, the hash decides."""
    x, half = _coordinate(dims), F.floor(F.col("leaves") / 2).cast("int")
    below = (x < F.col("_low")) | ((x <= F.col("_high")) & (F.col("tie") < F.col("_hash")))
    leaf = F.col("_first").isNull()
    at_node = at_node.withColumn("_below", below).withColumn("_half", half)
    first = F.when(leaf | F.col("_below"), F.col("first")).otherwise(F.col("first") + F.col("_half"))
    count = F.when(leaf, F.col("leaves")).when(F.col("_below"), F.col("_half")).otherwise(F.col("leaves") - F.col("_half"))
    return at_node.withColumn("_count", count).withColumn("first", first).drop("leaves").withColumnRenamed("_count", "leaves")


def _ranked(rows: DataFrame, c: str, total: int) -> DataFrame:
    """rows with a text column replaced by the rank of its value among all values of the column, from 1; null is 0.

    The values meet their rows by a join that splits hot ones, and are numbered by ranges: there can be as many as rows.
    """
    values = rows.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("_value")).agg(F.count("*").alias("_rows"))
    ranks = numbered(values, ["_value"], "_rank").select(F.col("_value").alias(c), "_rows", "_rank")
    joined = skew_join(rows, ranks, c, "_rows", total, "text_crc32", "left")
    return joined.withColumn(c, F.coalesce(F.col("_rank") + 1, F.lit(0)).cast("double")).drop("_rank")


def coordinates(rows: DataFrame, dims: list[str], kinds: dict[str, T.DataType], total: int) -> DataFrame:
    """rows with the metadata columns dims as numbers that keep their order: texts by rank, counts by logarithm. Null is the least value."""
    for i, d in enumerate(dims):
        c = f"_d{i}"
        if isinstance(kinds[d], T.StringType):
            rows = _ranked(rows, c, total)
            continue
        if isinstance(kinds[d], T.NumericType):
            number = F.log1p(F.greatest(F.col(c).cast("double"), F.lit(0.0))) if d.startswith("n_") else F.col(c).cast("double")
        else:
            number = F.unix_micros(F.col(c).cast("timestamp")).cast("double")
        rows = rows.withColumn(c, F.when(~F.isnan(number), number))
    return rows


def kd_shards(docs: DataFrame, dims: list[str] | None = None, target_bytes: int | None = None, leaves: int | None = None, seed: str = "kd") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of documents (doc_id, text and the metadata columns dims).

    size is the bytes of the text plus 1, a null text has none and the crc32 of an empty one. Give the leaves, or the
    bytes they should reach. dims default to those of lang, source, n_chars and doc_id that docs has; columns of other
    names are not looked at. Null metadata is the least value of its column. Rows alike in all of this, repeated or
    nameless ones, are counted, numbered, and shared out by their numbers: which shards they go to, and into which slots, does not
    depend on how the table is stored. An empty table stays empty. slot numbers the rows of a shard from 0 in the order of a hash.
    """
    dims = [d for d in dims or ["lang", "source", "n_chars", "doc_id"] if d in docs.columns]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    names = [f"_d{i}" for i in range(len(dims))]
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        *[F.col(f"`{d}`").alias(c) for d, c in zip(dims, names, strict=True)],
    )
    units = written(slim.groupBy("doc_id", "size", "text_crc32", *names).agg(F.count("*").alias("_alike")), "alike")
    points = coordinates(units, dims, {d: docs.schema[d].dataType for d in dims}, units.count())
    points = repeated(points, "_alike", "_nth").withColumn("_key", hash_key(seed, F.col("doc_id"), F.col("text_crc32"), F.col("_nth")))
    raw = written(points.drop("_alike", "_nth").withColumn("tie", F.conv(F.substring("_key", 9, 8), 16, 10).cast("double")), "points")
    names = names or ["tie"]
    span = raw.agg(F.sum("size").alias("w"), F.count("*").alias("n"), *_extents(names)).first()
    leaves = leaves or max(1, -(-(span["w"] or 0) // (target_bytes or 1 << 30)))
    scaled = raw.select("doc_id", "size", "text_crc32", "_key", "tie", *[_scaled(d, span[f"min_{i}"], span[f"max_{i}"]).alias(f"_s{i}") for i, d in enumerate(names)])
    placed = split_points(scaled, [f"_s{i}" for i in range(len(names))], leaves)
    rows = placed.select("doc_id", "size", "text_crc32", F.col("first").cast("int").alias("shard"), "_key", F.lit(1).cast("long").alias("_one"))
    return prefix_sums(rows, ["shard"], "_key", ["doc_id", "size", "text_crc32"], {"slot": "_one"}, bucket_digits(span["n"])).drop("_key", "_one")


def _scaled(d: str, low: float | None, high: float | None) -> Column:
    if low is None or high <= low:
        return F.lit(0.0)
    return F.coalesce((F.col(d) - low) / F.lit(high - low), F.lit(0.0))
