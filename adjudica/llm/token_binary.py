"""Token ids in shard files of bit-plane-shuffled, zstandard-compressed chunks.

A shard file holds documents in ascending order of doc_id:

    header   MAGIC, version (1 byte), bits or bytes a plane splits by (1 byte: 1 or 8), ids in a whole chunk (4 bytes),
             the shard's number (4 bytes), a line feed
    chunks   each the planes of a block of ids one after another, every plane a zstandard frame, and a line feed
    footer   a zstandard frame of fixed fields: the chunk index (offset, ids, bytes of each
             plane) and the documents (doc_id, whether it is null, ids), and a line feed
    tail     bytes of the footer (8 bytes), MAGIC, a line feed

All numbers are little-endian. Files are written by Spark's own text writer, whose rows are the parts above and whose
line feeds are the bytes between them: so any store that Spark reaches will do, and the commit protocol keeps files of
lost or repeated tasks out. A chunk can be read alone through the index.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adjudica.llm.common import scratch_path, small_batches, written

MAGIC = b"ADJPLANE"
VERSION = 1
#: Ids in a chunk, and bytes of text that a shard takes about.
CHUNK_IDS = 1 << 16
SHARD_BYTES = 32 << 20
HEADER = "<8sBBII"
TAIL = "<Q8s"


def to_planes(ids: np.ndarray, plane_bits: int) -> list[bytes]:
    """The bit planes (1) or byte planes (8) of ids, least significant first; bit planes are padded to whole bytes."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if plane_bits == 8:
        return [raw[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [row.tobytes() for row in np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")]


def from_planes(planes: list[bytes], count: int, plane_bits: int) -> np.ndarray:
    """The ids of which to_planes() made these planes."""
    rows = np.stack([np.frombuffer(p, dtype=np.uint8) for p in planes]) if count else np.empty((len(planes), 0), dtype=np.uint8)
    if plane_bits == 8:
        return np.ascontiguousarray(rows.T).view("<u4").reshape(-1)
    bits = np.unpackbits(rows, axis=1, count=count, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u4").reshape(-1)


def _footer(chunks: list[tuple[int, int, list[int]]], doc_ids: np.ndarray, nulls: np.ndarray, counts: np.ndarray) -> bytes:
    planes = len(chunks[0][2]) if chunks else 0
    index = np.array([[at, n, *sizes] for at, n, sizes in chunks], dtype="<i8").reshape(len(chunks), 2 + planes)
    return struct.pack("<IIQ", len(chunks), planes, len(doc_ids)) + index.tobytes() + doc_ids.astype("<i8").tobytes() + nulls.astype("u1").tobytes() + counts.astype("<i8").tobytes()


def read_index(content: bytes) -> dict:
    """The header, chunk index and documents of a shard file's bytes."""
    import zstandard

    magic, version, plane_bits, chunk_ids, shard = struct.unpack_from(HEADER, content, 0)
    size, end = struct.unpack_from(TAIL, content, len(content) - struct.calcsize(TAIL) - 1)
    if magic != MAGIC or end != MAGIC or version != VERSION:
        raise ValueError("not a shard file of this format")
    stop = len(content) - struct.calcsize(TAIL) - 2
    raw = zstandard.ZstdDecompressor().decompress(content[stop - size : stop])
    n, planes, docs = struct.unpack_from("<IIQ", raw, 0)
    at = 16
    index = np.frombuffer(raw, dtype="<i8", count=n * (2 + planes), offset=at).reshape(n, 2 + planes)
    at += index.nbytes
    doc_ids = np.frombuffer(raw, dtype="<i8", count=docs, offset=at)
    nulls = np.frombuffer(raw, dtype="u1", count=docs, offset=at + 8 * docs).astype(bool)
    counts = np.frombuffer(raw, dtype="<i8", count=docs, offset=at + 9 * docs)
    return {"plane_bits": plane_bits, "chunk_ids": chunk_ids, "shard": shard, "chunks": index, "doc_ids": doc_ids, "nulls": nulls, "counts": counts}


def read_chunk(content: bytes, index: dict, k: int) -> np.ndarray:
    """The ids of chunk k."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    at, count, *sizes = index["chunks"][k].tolist()
    planes = []
    for size in sizes:
        planes.append(unpack(content[at : at + size]))
        at += size
    return from_planes(planes, count, index["plane_bits"])


def write_token_shards(docs: DataFrame, vocabulary: str, end_id: int = 2, path: str | None = None, plane_bits: int = 1, level: int = 3, shard_bytes: int = SHARD_BYTES, chunk_ids: int = CHUNK_IDS) -> str:
    """Encodes whole texts, appends end_id to each, and writes the shard files; returns their folder.

    A null or empty text gives the end id alone. Rows with a null doc_id come first; rows with one doc_id are ordered by
    a hash of their text, so that many of them are shared out among shards too, and equal rows by their place in docs
    (a table: read again, its rows come in the same places). An empty table gives a folder without shards. Other columns
    are not looked at.
    """
    from adjudica.llm.tokenizing import batches, grouped

    spark = docs.sparkSession
    small_batches(spark)
    path = path or scratch_path(spark, "token-shards")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))

    def files(stream):
        import zstandard
        from pyspark import TaskContext

        pack = zstandard.ZstdCompressor(level=level).compress
        encoder = batches(vocabulary)
        frame = lambda x: pa.RecordBatch.from_arrays([pa.array([x], pa.binary())], names=["frame"])
        shard, at, chunks = TaskContext.get().partitionId(), 0, []
        doc_ids, nulls, counts, rest = [], [], [], np.empty(0, dtype="<u4")

        def chunk(ids: np.ndarray) -> bytes:
            nonlocal at
            planes = [pack(p) for p in to_planes(ids, plane_bits)]
            chunks.append((at, len(ids), [len(p) for p in planes]))
            data = b"".join(planes)
            at += len(data) + 1
            return data

        for table in grouped(stream):
            if not at:
                header = struct.pack(HEADER, MAGIC, VERSION, plane_bits, chunk_ids, shard)
                at = len(header) + 1
                yield frame(header)
            n, ids = encoder.encode(table["text"].combine_chunks())
            n = n + 1
            ends = np.cumsum(n)
            held = np.empty(len(rest) + int(ends[-1]), dtype="<u4")
            held[: len(rest)] = rest
            new = held[len(rest) :]
            inside = np.ones(len(new), dtype=bool)
            inside[ends - 1] = False
            new[~inside], new[inside] = end_id, ids
            key = table["doc_id"].combine_chunks()
            nulls.append(np.asarray(key.is_null().to_numpy(zero_copy_only=False)))
            doc_ids.append(key.fill_null(0).to_numpy())
            counts.append(n)
            whole = len(held) // chunk_ids * chunk_ids
            for k in range(0, whole, chunk_ids):
                yield frame(chunk(held[k : k + chunk_ids]))
            rest = held[whole:].copy()
        if at:
            if len(rest):
                yield frame(chunk(rest))
            footer = pack(_footer(chunks, np.concatenate(doc_ids), np.concatenate(nulls), np.concatenate(counts)))
            yield frame(footer)
            yield frame(struct.pack(TAIL, len(footer), MAGIC))

    order = ["doc_id", "_key", "_place"]
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("_key"), F.monotonically_increasing_id().alias("_place"))
    placed = (keyed.repartitionByRange(int(shards), *order) if size else keyed.coalesce(1)).sortWithinPartitions(*order).select("doc_id", "text")
    placed.mapInArrow(files, "frame binary").select(F.col("frame").cast("string").alias("value")).write.text(path, lineSep="\n")
    return path


def read_token_shards(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the shard files: shard, position in it, doc_id, shard_start (ids before it there), n_tokens, ids.

    ids are little-endian unsigned 32-bit numbers. A task holds one file at a time, chunk by chunk decoded.
    """

    def rows(stream):
        for batch in stream:
            for content in batch["content"]:
                data = content.as_py()
                if data:
                    yield from _documents(data)

    ddl = "shard int, position long, doc_id long, shard_start long, n_tokens long, ids binary"
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(rows, ddl)


def _documents(data: bytes, rows: int = 1000):
    index = read_index(data)
    counts = index["counts"]
    starts = np.cumsum(counts) - counts
    held, first, k = np.empty(0, dtype="<u4"), 0, 0  # decoded ids from number `first` on
    schema = pa.schema([("shard", pa.int32()), ("position", pa.int64()), ("doc_id", pa.int64()), ("shard_start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
    for at in range(0, len(counts), rows):
        n = counts[at : at + rows]
        stop = int(starts[at : at + rows][-1] + n[-1])
        parts = [held]
        have = first + len(held)
        while have < stop:
            parts.append(read_chunk(data, index, k))
            have += len(parts[-1])
            k += 1
        held = np.concatenate(parts)
        ids = [held[s - first : s - first + c].tobytes() for s, c in zip(starts[at : at + rows].tolist(), n.tolist(), strict=True)]
        held, first = held[stop - first :], stop
        keys = pa.array(index["doc_ids"][at : at + rows], mask=index["nulls"][at : at + rows])
        m = len(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(m, index["shard"]), pa.int32()), pa.array(np.arange(at, at + m)), keys, pa.array(starts[at : at + m]), pa.array(n), pa.array(ids, pa.binary())], schema=schema)


def with_starts(docs: DataFrame) -> DataFrame:
    """Replaces shard_start by start, the ids of all documents before: shards follow each other by number.

    Reads its input twice; the table of shard totals has a row for each file.
    """
    totals = docs.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long").alias("_before"))
    return docs.join(offsets, "shard").withColumn("start", F.col("shard_start") + F.col("_before")).drop("_before", "shard_start")


def token_digest(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Writes the shard files, reads them back, and returns doc_id, start, n_tokens and the crc32 of each document's ids."""
    path = write_token_shards(docs, vocabulary, end_id)
    read = read_token_shards(docs.sparkSession, path).select("shard", "doc_id", "shard_start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return with_starts(written(read, "token-rows")).select("doc_id", "start", "n_tokens", "ids_crc32", "shard")
