"""Near images by difference hashes: multi-index hashing, then the correlation of thumbnails (G18, J18); near vectors of a block."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.storage import written

#: Bits of a difference hash.
BITS = 64
#: Hashes that share a band are compared among each other up to so many; more are split by bands of their other bits.
CROWD = 1_000
#: Vectors of a block that meet others in one task, about: a block that has more is cut into chunks, and every two of those meet.
CHUNK = 1_024


def hamming(a: Column, b: Column) -> Column:
    """How many bits of two 64-bit hashes differ."""
    return F.bit_count(a.bitwiseXOR(b))


def _cuts(bits: int, bands: int) -> list[tuple[int, int]]:
    """(shift, mask) of so many bands that share the bits as evenly as can be."""
    ends = [bits * k // bands for k in range(bands + 1)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(ends, ends[1:], strict=False)]


def _band(hash_: Column, shift: int, mask: int) -> Column:
    return F.shiftrightunsigned(hash_, shift).bitwiseAND(F.lit(mask))


def near_hashes(hashes: DataFrame, distance: int, hash_: str = "hash") -> DataFrame:
    """a and b, a < b: all pairs of distinct hashes that differ in at most `distance` bits, each once; recall is 1.

    The bits are cut into distance + 1 bands: of two hashes that near, one band at least is equal (pigeonhole). Hashes meet by
    their bands, and a pair counts at the first band that it shares. A band that very many hashes share is split: what else may differ
    lies in the other bits, so those are cut into distance + 1 bands again, and the pairs meet by both.
    """
    one = hashes.filter(F.col(hash_).isNotNull()).select(F.col(hash_).cast("long").alias("h")).distinct()
    if distance < 1:
        return one.select(F.col("h").alias("a"), F.col("h").alias("b")).limit(0)  # distinct hashes differ
    cuts = _cuts(BITS, distance + 1)
    keyed = one.select("h", F.explode(F.array(*[F.struct(F.lit(k).alias("band"), _band(F.col("h"), s, m).alias("value")) for k, (s, m) in enumerate(cuts)])).alias("_b")).select("h", "_b.*")
    keyed = written(keyed, "bands")
    crowds = keyed.groupBy("band", "value").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD).select(F.col("band").alias("_band"), F.col("value").alias("_value"))
    marked = keyed.join(crowds, (F.col("band") == F.col("_band")) & (F.col("value") == F.col("_value")), "left").withColumn("crowded", F.col("_band").isNotNull()).drop("_band", "_value")
    # of a crowd, the other bits in bands of their own; of others, one band that holds all
    others = []
    for k, (shift, mask) in enumerate(cuts):
        width = mask.bit_length()
        low = F.col("h").bitwiseAND(F.lit((1 << shift) - 1)) if shift else F.lit(0).cast("long")
        rest = F.shiftleft(_band(F.col("h"), shift + width, (1 << (BITS - shift - width)) - 1), shift).bitwiseOR(low) if shift + width < BITS else low
        others.append((k, [F.struct(F.lit(j).alias("sub"), _band(rest, s, m).alias("other")) for j, (s, m) in enumerate(_cuts(BITS - width, distance + 1))]))
    subs = F.array(F.struct(F.lit(-1).alias("sub"), F.lit(0).cast("long").alias("other")))
    for k, some in others:
        subs = F.when(F.col("crowded") & (F.col("band") == k), F.array(*some)).otherwise(subs)
    rows = marked.withColumn("_s", F.explode(subs)).select("h", "band", "value", "_s.*")
    left, right = rows.withColumnRenamed("h", "a"), rows.withColumnRenamed("h", "b")
    met = left.join(right, ["band", "value", "sub", "other"]).filter((F.col("a") < F.col("b")) & (hamming(F.col("a"), F.col("b")) <= distance))
    return met.select("a", "b").distinct()


def near_images(images: DataFrame, distance: int = 0, correlation: float = 0.98) -> DataFrame:
    """a, b and r of pairs of images (uid, hash, thumb) whose hashes differ in at most `distance` bits and whose thumbnails correlate.

    thumb is normalised, so a dot product is the correlation. Images of one hash are pairs, too, and come from one group of images with that hash: what
    is made is what is compared. Rows without hash or thumb have no pair.
    """
    known = written(images.filter("hash is not null and thumb is not null").select("uid", F.col("hash").cast("long").alias("hash"), "thumb"), "thumbs")
    near = near_hashes(known, distance) if distance else known.limit(0).select(F.col("hash").alias("a"), F.col("hash").alias("b"))
    both = near.unionByName(known.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("hash").alias("a"), F.col("hash").alias("b")))
    left = known.select(F.col("hash").alias("a"), F.struct("uid", "thumb").alias("x"))
    right = known.select(F.col("hash").alias("b"), F.struct("uid", "thumb").alias("y"))
    met = both.join(left, "a").join(right, "b").filter((F.col("a") != F.col("b")) | (F.col("x.uid") < F.col("y.uid")))
    dot = F.aggregate(F.zip_with("x.thumb", "y.thumb", lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    return met.select(F.least("x.uid", "y.uid").alias("a"), F.greatest("x.uid", "y.uid").alias("b"), dot.alias("r")).filter(F.col("r") >= correlation)


def near_vectors(vectors: DataFrame, least: float, uid: str = "vec_id", vector: str = "embedding", block: str = "block") -> DataFrame:
    """a, b and s, a < b: all pairs of one block whose vectors have a cosine s of at least `least`.

    All pairs of a block are compared, as asked, but a task holds two chunks of it at most. A matrix product tells which pairs may do; of those,
    s is summed up component by component in double precision. Vectors that are null or hold null have no pair, nor do those of unlike length;
    a cosine that is no number, as of a zero vector, is above every bound, as it is in SQL.
    """
    e = F.transform(vector, lambda x: x.cast("double"))
    known = vectors.select(F.col(uid).alias("u"), F.col(block).alias("block"), e.alias("e")).filter(F.col("block").isNotNull() & F.col("u").isNotNull())
    known = known.withColumn("n", F.sqrt(F.aggregate("e", F.lit(0.0), lambda a, x: a + x * x))).withColumn("d", F.size("e")).filter("n is not null")
    sizes = known.groupBy(F.col("block").alias("_block"), F.col("d").alias("_d")).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    dealt = known.join(sizes, (F.col("block") == F.col("_block")) & (F.col("d") == F.col("_d"))).withColumn("chunk", F.pmod(F.xxhash64("u"), F.col("chunks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    met = met.select("block", "d", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "u", "n", "e")

    def compared(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        u, n, chunk = table["u"].combine_chunks(), table["n"].to_numpy(), table["chunk"].to_numpy()
        e = table["e"].combine_chunks().flatten().to_numpy().reshape(len(n), -1)
        left, right = np.flatnonzero(chunk == chunk.min()), np.flatnonzero(chunk == chunk.max())
        with np.errstate(all="ignore"):
            about = (e[left] @ e[right].T) / np.outer(n[left], n[right])
            x, y = np.nonzero(~(about < least - 1e-6))  # what is no number is summed up below
            x, y = left[x], right[y]
            if chunk.min() == chunk.max():
                x, y = x[x < y], y[x < y]
            s = np.zeros(len(x))
            for c in np.ascontiguousarray(e.T):
                s += c[x] * c[y]
            s /= n[x] * n[y]
        x, y, s = (v[~(s < least)] for v in (x, y, s))
        return pa.table({"a": u.take(pa.array(x)), "b": u.take(pa.array(y)), "s": s})

    kind = known.schema["u"].dataType.simpleString()
    found = met.groupBy("block", "d", "i", "j").applyInArrow(compared, f"a {kind}, b {kind}, s double")
    return found.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "s")
