"""Word shingles as sets of 64-bit hashes, their MinHash samples, and odd sketches of those."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from adjudica.llm.slices import text_slices

_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0xD1342543DE82EF95
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd base, those of its inverse, modulo 2^64, and a scattered number for each byte."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        up, down = np.full(size, _BASE, dtype=np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS[:] = [np.cumprod(up), np.cumprod(down), mixed(np.arange(1, 257, dtype=np.uint64) * _C2)]
    return _POWERS[0], _POWERS[1], _POWERS[2]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each text's words begin, and the hashes of all words, A-Z lower-cased. A null text has no words.

    A word's hash is a polynomial of its bytes, taken as a difference of running sums over all bytes.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64, count=texts.offset + len(texts) + 1)[texts.offset :]
    n = int(offsets[-1] - offsets[0])
    if not n:
        return np.zeros(len(texts) + 1, dtype=np.int64), np.empty(0, dtype=np.uint64)
    data = np.frombuffer(buffers[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down, scattered = _powers(n + 1)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(scattered[data] * up[:n])])
    hashes = mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * _C3)
    return np.searchsorted(begin, offsets), hashes


#: Bytes of text that are hashed together, about: what bounds the memory of a worker.
SLICE = 1 << 20


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The set of each text's shingles as a sorted array; fewer words than a shingle has are one shingle, none give none.

    A very long text is hashed in parts, whose words then come together.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    out: list[np.ndarray] = [np.empty(0, dtype=np.uint64)] * len(texts)
    parts: dict[int, list[np.ndarray]] = {}
    for rows, part in text_slices(texts, SLICE):
        starts, words = word_hashes(part)
        joined = _joined(words, width)
        for k, (row, a, b) in enumerate(zip(rows.tolist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
            if row in parts or (k + 1 == len(rows) and len(part) == 1 and _goes_on(texts, row, part)):
                parts.setdefault(row, []).append(words[a:b])
            else:
                out[row] = _set(words[a:b], joined[a : max(b - width + 1, a)], width)
    for row, words in parts.items():
        whole = np.concatenate(words)
        out[row] = _set(whole, _joined(whole, width), width)
    return out


def _goes_on(texts: pa.Array, row: int, part: pa.Array) -> bool:
    """Whether a part is less than its text."""
    size = lambda x: int(pc.binary_length(x).to_numpy(zero_copy_only=False)[0])
    return size(part) < size(texts.slice(row, 1))


def _joined(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of so many words."""
    out = np.zeros(max(len(words) - width + 1, 0), dtype=np.uint64)
    for k in range(width):
        out = mixed(out * _C1 + words[k : k + len(out)] + _C2)
    return out


def _set(words: np.ndarray, joined: np.ndarray, width: int) -> np.ndarray:
    if len(words) >= width or not len(words):
        return np.unique(joined[: max(len(words) - width + 1, 0)])
    h = np.array([len(words)], dtype=np.uint64)
    for k in range(len(words)):
        h = mixed(h * _C3 + words[k : k + 1])
    return h


def minhash(shingles: np.ndarray, a: np.ndarray, b: np.ndarray, block: int = 2048) -> np.ndarray:
    """The least value of each hash a * x + b over a set that isn't empty."""
    low = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(shingles), block):
        part = shingles[k : k + block]
        np.minimum(low, (part[:, None] * a + b).min(axis=0), out=low)
    return low


def coefficients(count: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands for so many MinHash functions."""
    random = np.random.default_rng(seed)
    return random.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1), random.integers(0, 2**63, count, dtype=np.uint64)


def band_keys(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """64-bit keys of the bands of MinHash samples (a row for each set); the band's number is part of a key."""
    h = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=np.uint64) * _C1), (len(samples), bands))
    for k in range(rows):
        h = mixed(h * _C2 + samples[:, k::rows])
    return h


def odd_sketches(samples: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmaps of MinHash samples (a row for each set): each sample, with its number, flips one of so many bits."""
    n, count = samples.shape
    at = mixed(samples + np.arange(1, count + 1, dtype=np.uint64) * _C3) % np.uint64(bits)
    flat = np.arange(n)[:, None] * bits + at.astype(np.int64)
    return np.packbits((np.bincount(flat.ravel(), minlength=n * bits) & 1).reshape(n, bits), axis=1)


def odd_similarity(x: np.ndarray, y: np.ndarray, samples: int) -> np.ndarray:
    """Estimated Jaccard similarity of sets by the population count of their sketches' XOR (rows of x against rows of y)."""
    bits = 8 * x.shape[-1]
    odd = np.bitwise_count(x ^ y).sum(axis=-1)
    return 1 + bits / (4 * samples) * np.log(np.maximum(1 - 2 * odd / bits, 1e-9))


def common(x: np.ndarray, y: np.ndarray) -> int:
    """The size of the intersection of two sorted sets."""
    return len(np.intersect1d(x, y, assume_unique=True))
