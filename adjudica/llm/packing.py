"""Sum-of-squares packing of token sequences.

A document longer than a sequence is cut into whole sequences and a rest. Pieces are dealt by a hash into groups of
bounded size; each group is packed on its own, from its longest piece on. A piece goes to the open sequence that
makes the sum of the squared counts of open sequences by residual gap smallest, and to a new sequence if none has
room. Only lengths and keys travel; a group is a bounded task whatever the input, and reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.llm.common import small_batches, written

#: Pieces in a group, about: enough that what the last open sequences of a group waste is below a thousandth.
GROUP_PIECES = 40_000


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, in the order given; every length is between 1 and capacity.

    Ties take the smallest gap that fits. Opening a bin is the last resort, as few bins are wanted.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)  # open bins by gap
    gaps: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    n, never = 0, np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        here, gap = counts[s:capacity], capacity
        if s < capacity and here.any():
            # a bin leaves the gaps g and joins the gaps g - s, which have no count at 0
            change = 2 * (counts[: capacity - s] - here)
            change[0] = -2 * here[0] - 1
            change[here == 0] = never
            gap = s + int(change.argmin())
        if gap == capacity:
            bins[i], n = n, n + 1
        else:
            bins[i] = gaps[gap].pop()
            counts[gap] -= 1
        offsets[i] = capacity - gap
        if gap > s:
            gaps[gap - s].append(int(bins[i]))
            counts[gap - s] += 1
    return bins, offsets


def pack(pieces: DataFrame, keys: list[str], deal: list[str] | None = None, length: str = "length", capacity: int = 2048, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to pieces of 1 to capacity tokens.

    keys order equal lengths; rows that agree in all keys and the length are alike, and any of them may take either
    place. The columns `deal` (the keys, if none are given) deal pieces into groups: where many rows are alike, name one
    that numbers rows, or they come into one group. Null keys are values like any other. An empty table stays empty.
    """
    groups = max(1, -(-pieces.count() // group_pieces))
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    schema = pieces.select(*columns).schema.add("sequence_id", "long").add("offset", "long")

    def placed(key, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([length, *keys], ascending=[False] + [True] * len(keys), kind="stable", ignore_index=True)
        bins, offsets = sum_of_squares(frame[length].to_numpy(dtype=np.int64), capacity)
        return frame[columns].assign(sequence_id=bins + (int(key[0]) << 32), offset=offsets)

    dealt = pieces.select(*columns, F.pmod(F.xxhash64(*(deal or keys)), F.lit(groups)).alias("_group"))
    return dealt.groupBy("_group").applyInPandas(lambda key, frame: placed(key, frame), schema)


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = 2048, with_ids: bool = True) -> DataFrame:
    """Pieces of whole documents: doc_id, piece, start, length, ids_crc32, piece_key, ids (little-endian unsigned 32-bit).

    piece_key is a number of each row's own; rewritten tasks give their rows the same.

    A null or empty text has just the end id. Documents without doc_id, and repeated rows, are documents too.
    with_ids=False leaves ids out, for plans that only place the pieces.
    """
    from adjudica.llm.tokenizing import batches, grouped

    small_batches(docs.sparkSession)
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("piece_key", pa.int64())]
    fields += [("ids", pa.binary())] * with_ids
    schema = pa.schema(fields)

    def cut(stream):
        from zlib import crc32

        from pyspark import TaskContext

        encoder, key = batches(vocabulary), TaskContext.get().partitionId() << 40
        for table in grouped(stream):
            counts, ids = encoder.encode(table["text"].combine_chunks() if table.num_rows else pa.array([], pa.string()))
            counts = counts + 1
            ends = np.cumsum(counts)
            all_ids = np.empty(int(ends[-1]), dtype="<u4")
            all_ids[ends - 1] = end_id
            inside = np.ones(len(all_ids), dtype=bool)
            inside[ends - 1] = False
            all_ids[inside] = ids
            data = memoryview(all_ids.tobytes())
            n = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(counts[doc] - start, capacity)
            at = (ends - counts)[doc] + start
            cuts = [data[4 * a : 4 * (a + k)] for a, k in zip(at.tolist(), length.tolist(), strict=True)]
            out = [table["doc_id"].combine_chunks().take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array([crc32(x) for x in cuts], pa.int64()), pa.array(np.arange(key, key + len(doc)))]
            key += len(doc)
            out += [pa.array([bytes(x) for x in cuts], pa.binary())] * with_ids
            whole = pa.RecordBatch.from_arrays(out, schema=schema)
            for k in range(0, whole.num_rows, 2000):
                yield whole.slice(k, 2000)

    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long, piece_key long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, ddl)


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = 2048, with_ids: bool = True) -> DataFrame:
    """Cuts and packs whole documents: the columns of token_pieces with sequence_id and offset.

    Pieces are dealt by their own numbers, so that any count of repeated or nameless rows is shared out evenly.
    """
    pieces = written(token_pieces(docs, vocabulary, end_id, capacity, with_ids), "pieces")
    placed = pack(pieces.drop("ids"), ["doc_id", "piece", "ids_crc32"], ["piece_key"], capacity=capacity)
    if not with_ids:
        return placed.drop("piece_key")
    ids = pieces.select(F.col("piece_key").alias("_key"), "ids")
    return placed.join(ids, F.col("piece_key") == F.col("_key")).drop("piece_key", "_key")
