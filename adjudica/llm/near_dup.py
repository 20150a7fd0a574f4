"""Near-duplicate documents: MinHash bands find candidates, odd sketches verify them, full shingle sets confirm links.

1. Each document gets its set of word shingles, MinHash samples, a key for each band of them, and an odd sketch.
   Documents of equal sets are one node from here on, named by the least doc_id, so exact copies cost nothing.
2. Nodes that share a band key are joined to the least node of that key: a star, not all pairs. The components of
   these edges are blobs; every link lies inside a blob (but for the chance, below 1e-6, that two linked sets share no band).
3. Texts of the nodes in blobs come together by blob. There, nodes that share a band key are candidates; the odd sketches
   estimate their similarity by the population count of an XOR and drop what is far below the threshold, and whole sets
   confirm the rest, likeliest first. Candidates that are connected already need no test, so a blob yields a spanning
   forest of its links.
4. A blob too large for one task is cut into chunks, twice and by different hashes, and each chunk is searched: work that
   grows with the blob only. What is then connected needs no more tests; nodes that still share a band key with a node of
   another component are cut into chunks again, and every two of those chunks meet in a task, so that no link is lost.
5. Components of the confirmed links are the classes; the least doc_id of each is kept.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.llm import shingles as S
from adjudica.llm.common import columns_of, packed, small_batches, written
from adjudica.operators.components import components
from adjudica.operators.scale import skew_join

BAND_ROWS = 5
MISS = 1e-7
SKETCH_BITS = 1024
#: Shingles of the nodes in one task of steps 3 and 4, about.
CHUNK_SHINGLES = 250_000
#: Standard deviations of a sketch's estimate below the threshold at which a pair is dropped unseen: a chance below MISS.
GUARD = 5.5


def bands_for(percent: int, rows: int = BAND_ROWS, miss: float = MISS) -> int:
    """Bands that miss a pair at the threshold with no more than this chance."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def signatures(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key (192 bits; null without shingles), keys of bands, sketch."""
    small_batches(docs.sparkSession)
    bands = bands_for(percent)
    samples = bands * BAND_ROWS

    def signed(stream):
        a, b = S.coefficients(samples)
        for batch in stream:
            sets = S.shingle_sets(batch.column("text"), width)
            full = [k for k, x in enumerate(sets) if len(x)]
            low = np.stack([S.minhash(sets[k], a, b) for k in full]) if full else np.empty((0, samples), dtype=np.uint64)
            band, sketch = S.band_keys(low, bands, BAND_ROWS).view(np.int64), S.odd_sketches(low, SKETCH_BITS)
            keys, marks, lists = [None] * len(sets), [None] * len(sets), [None] * len(sets)
            for at, k in enumerate(full):
                x = sets[k]
                keys[k] = _set_key(x)
                marks[k], lists[k] = sketch[at].tobytes(), band[at]
            sizes = pa.array([len(x) for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), sizes, pa.array(keys, pa.binary()), pa.array(lists, pa.list_(pa.int64())), pa.array(marks, pa.binary())], names=["doc_id", "text_key", "n_shingles", "set_key", "bands", "sketch"])

    return docs.mapInArrow(signed, "doc_id long, text_key long, n_shingles long, set_key binary, bands array<long>, sketch binary")


def _set_key(x: np.ndarray) -> bytes:
    """A name of a set that only equal sets have."""
    return np.array([len(x), np.bitwise_xor.reduce(S.mixed(x)), S.mixed(x * np.uint64(3)).sum(dtype=np.uint64)], dtype=np.uint64).tobytes()


def sketch_floor(percent: int, samples: int) -> float:
    """The estimate below which a pair is dropped: GUARD deviations of samples and of a sketch's collisions under the threshold."""
    t = percent / 100
    odd = 2 * (1 - t) * samples  # samples that differ, on both sides
    return t - GUARD * math.sqrt(t * (1 - t) / samples + odd**2 / SKETCH_BITS / (2 * samples) ** 2)


def spanning_links(sets: list[np.ndarray], bands: np.ndarray, sketches: np.ndarray, samples: int, percent: int, roots: list | None = None, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets that share a band key: pairs (row, row) with 100 |x & y| >= percent |x | y|.

    bands and sketches have a row for each set. Rows with equal roots count as connected from the start. sides (0 or 1
    for each set) restricts the search to pairs of different sides. Sets must not be empty.
    """
    floor = sketch_floor(percent, samples)
    order = np.argsort([len(x) for x in sets], kind="stable")
    sets, sketches, sides = [sets[k] for k in order], sketches[order], None if sides is None else sides[order]
    n = np.array([len(x) for x in sets])
    label = np.arange(len(sets)) if not roots else np.unique(np.array(roots, dtype=object)[order], return_inverse=True)[1]
    _, key, count = np.unique(bands[order], return_inverse=True, return_counts=True)
    sharing = np.argsort(key.ravel(), kind="stable")  # places in the table of bands, by key and then by row
    end = np.empty(len(sharing), dtype=np.int64)
    end[sharing] = np.arange(len(sharing))
    begin, end, sharing = (np.cumsum(count) - count)[key.reshape(bands.shape)], end.reshape(bands.shape), sharing // bands.shape[1]
    words, code = np.unique(np.concatenate(sets), return_inverse=True)
    codes, own = np.split(code, np.cumsum(n)[:-1]), np.zeros(len(words), dtype=bool)
    links: list[tuple[int, int]] = []
    for x in np.flatnonzero((end > begin).any(axis=1)).tolist():
        spans = {(a, b) for a, b in zip(begin[x].tolist(), end[x].tolist(), strict=True) if b > a}
        rows = np.unique(np.concatenate([sharing[a:b] for a, b in spans]))
        rows = rows[(label[rows] != label[x]) & (100 * n[rows] >= percent * n[x]) & (True if sides is None else sides[rows] != sides[x])]
        guess = S.odd_similarity(sketches[x], sketches[rows], samples)
        rows = rows[np.argsort(-guess, kind="stable")][: np.count_nonzero(guess >= floor)]
        own[codes[x]] = True
        some = 16
        while len(rows):  # likeliest first, and what they connect needs no test
            now, rows, some = rows[:some], rows[some:], 4 * some
            both = np.add.reduceat(own[np.concatenate([codes[y] for y in now])], np.cumsum(n[now]) - n[now], dtype=np.int64)
            for y in now[100 * both >= percent * (n[x] + n[now] - both)].tolist():
                if label[y] != label[x]:
                    links.append((int(order[x]), int(order[y])))
                    label[label == label[y]] = label[x]
            rows = rows[label[rows] != label[x]]
        own[codes[x]] = False
    return links


def _classes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, text_key, n_shingles and component_id of documents (doc_id, text), by their rows."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_key", F.xxhash64("text"))
    signed = written(signatures(docs, width, percent), "signatures")
    named = signed.filter("doc_id is not null and set_key is not null")
    first = F.min(F.struct("doc_id", "text_key", "n_shingles", "bands", "sketch"))
    nodes = written(named.groupBy(F.col("set_key").alias("node")).agg(first.alias("s"), F.count("*").alias("copies")).select("node", "copies", "s.*"), "nodes")
    keyed = nodes.select("node", F.explode("bands").alias("band"))
    stars = keyed.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("z"), F.count("*").alias("n")).filter("a != z").select("band", "a", "n")
    total = nodes.count() * bands_for(percent)
    edges = skew_join(keyed, stars, "band", "n", total, "node").filter("a != node").select("a", F.col("node").alias("b"))
    blobs = components(edges)
    members = written(blobs.join(nodes, "node"), "members")
    links = components(_links(docs, members, width, percent))
    classes = links.select(F.col("node").alias("_node"), "label")
    best = nodes.select("node", "doc_id", "copies").join(classes, F.col("node") == F.col("_node"), "left").withColumn("label", F.coalesce("label", "node"))
    best = written(best.select("node", "doc_id", "copies", "label"), "labelled")
    least = best.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
    of_node = skew_join(best, least, "label", "n", best.count(), "node").select(F.col("node").alias("set_key"), "component_id", "copies")
    out = skew_join(signed.select("doc_id", "text_key", "n_shingles", "set_key"), of_node, "set_key", "copies", signed.count(), "doc_id", "left")
    return out.select("doc_id", "text_key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def _kept() -> Column:
    return F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of documents (doc_id, text); other columns are not looked at.

    Documents are linked when 100 |x & y| >= percent |x | y| for their sets of word shingles; component_id is the
    least doc_id that links reach. Documents without words, null texts among them, are linked with nothing. A row
    without doc_id can't be named: it is linked with nothing, has a null component_id, and is kept. Rows with one
    doc_id and several texts each stand for themselves under that id. An empty table stays empty.
    """
    return _classes(docs, width, percent).select("doc_id", "n_shingles", "component_id", _kept().alias("kept"))


def _chunked(members: DataFrame) -> DataFrame:
    """members with chunks: how many tasks the shingles of their blob (label) are for."""
    sizes = members.groupBy("label").agg(F.ceil(F.sum("n_shingles") / CHUNK_SHINGLES).cast("int").alias("chunks"), F.count("*").alias("n"))
    return skew_join(members, sizes, "label", "n", members.count(), "node")


def _links(docs: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) of nodes that connect what links connect in each blob. members: node, label, doc_id, text_key, n_shingles, bands, sketch."""
    members = written(_chunked(members), "chunked")
    chunk = lambda seed, n: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")
    at = lambda turn, c: F.struct(F.lit(turn).alias("turn"), c.alias("low"), c.alias("high"), c.alias("chunk"))
    turns = F.when(F.col("chunks") == 1, F.array(at(0, F.lit(0)))).otherwise(F.array(at(1, chunk(1, "chunks")), at(2, chunk(2, "chunks"))))
    placed = members.withColumn("root", F.col("node")).select(*_PLACED, F.explode(turns).alias("t")).select(*_PLACED, "t.*")
    links = written(_confirmed(docs, placed, width, percent), "links")
    large = members.filter("chunks > 1").drop("chunks")
    if not large.limit(1).count():
        return links
    classes = components(links).select(F.col("node").alias("_node"), F.col("label").alias("_root"))
    large = written(large.join(classes, F.col("node") == F.col("_node"), "left").withColumn("root", F.coalesce("_root", "node")).drop("_node", "_root"), "rooted")
    keyed = large.select("node", "root", F.explode("bands").alias("band"))
    mixed = keyed.groupBy("band").agg(F.min("root").alias("r"), F.max("root").alias("z"), F.count("*").alias("n")).filter("r != z").select("band", "r", "n")
    still = skew_join(keyed.select("node", "band"), mixed, "band", "n", large.count() * bands_for(percent), "node").select(F.col("node").alias("_node")).distinct()
    rest = written(_chunked(large.join(still, F.col("node") == F.col("_node"), "left_semi")), "rest")
    # chunk c of n meets every chunk, itself included: the pair is named by its smaller and larger number
    rest = rest.withColumn("chunk", chunk(3, "chunks")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    placed = rest.select(*_PLACED, F.lit(3).alias("turn"), F.least("chunk", "_other").alias("low"), F.greatest("chunk", "_other").alias("high"), "chunk")
    return links.union(written(_confirmed(docs, placed, width, percent), "more-links"))


_PLACED = ["node", "label", "doc_id", "text_key", "bands", "sketch", "root"]


def _confirmed(docs: DataFrame, placed: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) of nodes, a spanning forest in each group (label, turn, low, high) of placed."""
    samples, bands = bands_for(percent) * BAND_ROWS, bands_for(percent)
    together = docs.join(placed, ["doc_id", "text_key"]).drop("doc_id", "text_key")

    def linked(key, table):
        table = table.combine_chunks()
        nodes = table["node"].to_pylist()
        first: dict[bytes, int] = {}
        for k, node in enumerate(nodes):  # a row that is repeated comes as often
            first.setdefault(node, k)
        rows = [first[node] for node in sorted(first)]
        if len(rows) < 2:
            return pa.table({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary())})
        table = table.take(pa.array(rows)).combine_chunks()
        nodes, sets = table["node"].to_pylist(), [x for c in table["text"].chunks for x in S.shingle_sets(c, width)]
        keys = np.asarray(table["bands"].combine_chunks().flatten()).reshape(len(rows), bands)
        sketches = np.stack([np.frombuffer(x, dtype=np.uint8) for x in table["sketch"].to_pylist()])
        low, high = key[2].as_py(), key[3].as_py()
        found = spanning_links(sets, keys, sketches, samples, percent, table["root"].to_pylist(), None if low == high else (np.asarray(table["chunk"]) == high).astype(int))
        return pa.table({"a": pa.array([nodes[x] for x, _ in found], pa.binary()), "b": pa.array([nodes[y] for _, y in found], pa.binary())})

    return together.groupBy("label", "turn", "low", "high").applyInArrow(linked, "a binary, b binary")


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, without those that near_duplicates() does not keep; columns of any name stay as they are.

    Of repeated rows of a kept doc_id all stay: they are the same document. Where one doc_id has several texts, only
    rows of the texts that are not kept go.
    """
    gone = _classes(docs, width, percent).filter(~_kept()).select("doc_id", "text_key").distinct()
    on = (F.col("_row.doc_id").cast("long") == F.col("doc_id")) & (F.xxhash64(F.col("_row.text").cast("string")) == F.col("text_key"))
    return packed(docs).join(gone, on, "left_anti").select(*columns_of(docs))
