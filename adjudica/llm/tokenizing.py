"""Batch tokenization with a tokenizers vocabulary, a few times faster than text by text.

A vocabulary whose normalizer and pre-tokenizer are those of QUICK ends a token at every white space, so texts are taken
in slices of about SLICE bytes, and only a slice's distinct chunks between ASCII white space are looked at. Chunks of
plain letters, digits and punctuation (ASCII and Latin-1) fall into the same words as the vocabulary's own pattern gives;
a distinct word is encoded once by the library's model and kept in a bounded memo. Every other chunk goes through the
library's whole encode(), and so does every whole text where the vocabulary's settings are others. Tests hold the ids
against encode() of the texts.
"""

from __future__ import annotations

import json
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from adjudica.llm.slices import text_slices

#: Bytes of text that are looked at together, about; a longer text is cut at white space.
SLICE = 1 << 20
#: Places of the memo at first (a power of two); words and ids that a worker remembers before the memo starts anew.
PLACES = 1 << 19
MEMO_WORDS, MEMO_IDS = 500_000, 4_000_000

#: The settings for which the quick way is right (fixed values of the vocabularies that have them).
QUICK = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
}

#: Chunks that the quick way may handle: printable ASCII without the apostrophe, and the letters of Latin-1.
PLAIN = "^[!-&(-~À-ÖØ-öø-ÿ]+$"
#: Ends of words inside a plain chunk: a digit alone, or a run of neither letters nor digits.
CUTS = r"([^\pL\pN]+|\pN)"

#: Bytes of a word that the memo knows by its bytes; longer words are rare and encoded again in each slice.
SHORT = 24

_BATCHES: dict[str, "Batches"] = {}


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, then from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def gather(ptr: np.ndarray, flat: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a ragged array: their lengths, and their elements one after another."""
    lengths = (ptr[1:] - ptr[:-1])[rows]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total, dtype=np.int64) - np.repeat(ends - lengths - ptr[rows], lengths)
    return lengths, flat[at]


def _mixed(keys: np.ndarray) -> np.ndarray:
    """A hash of each row of 64-bit numbers."""
    h = np.zeros(len(keys), dtype=np.uint64)
    for column in keys.T:
        h = (h ^ column) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


class Memo:
    """Numbers of words that are known by their very bytes, so that none can pass for another: an open-addressing table."""

    def __init__(self, places: int = PLACES):
        self.keys, self.numbers, self.size = np.empty((places, SHORT // 8), dtype=np.uint64), np.full(places, -1, dtype=np.int64), 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of words, -1 for those that aren't known."""
        out, left, at = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys)), self._home(keys)
        while len(left):
            number = self.numbers[at]
            same = (number >= 0) & (self.keys[at] == keys[left]).all(axis=1)
            out[left[same]] = number[same]
            on = (number >= 0) & ~same
            left, at = left[on], (at[on] + 1) % len(self.numbers)
        return out

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Takes distinct words in that aren't known yet; the table grows before it is half full."""
        if 2 * (self.size + len(keys)) > len(self.numbers):
            held = self.numbers >= 0
            old_keys, old_numbers = self.keys[held], self.numbers[held]
            self.__init__(1 << int(4 * (len(old_keys) + len(keys)) - 1).bit_length())
            self.add(old_keys, old_numbers)
        left, at = np.arange(len(keys)), self._home(keys)
        while len(left):
            free = np.flatnonzero(self.numbers[at] < 0)
            self.numbers[at[free]] = numbers[left[free]]  # of several words for one place, one stays
            won = np.zeros(len(left), dtype=bool)
            won[free] = self.numbers[at[free]] == numbers[left[free]]
            self.keys[at[won]] = keys[left[won]]
            left, at = left[~won], (at[~won] + 1) % len(self.numbers)
        self.size += len(keys)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (_mixed(keys) % np.uint64(len(self.numbers))).astype(np.int64)


class Batches:
    """Encodes Arrow arrays of texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        self.quick = all(settings.get(k) == v for k, v in QUICK.items()) and not settings.get("post_processor")
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        self._forget()

    def _forget(self) -> None:
        self.memo = Memo()
        self.starts, self.n = np.zeros(1 << 16, dtype=np.int64), 0  # by number, where the ids begin; numbers given
        self.flat = np.empty(1 << 18, dtype=np.uint32)

    def _ids(self, words: list[str]) -> list[list[int]]:
        tokenize, letters = self.model.tokenize, self.letters
        return [[t.id for t in tokenize(w if w.isascii() else w.encode().decode("latin-1").translate(letters))] for w in words]

    def _add(self, ids: list[list[int]]) -> np.ndarray:
        """Numbers for new words with these ids."""
        ends = self.starts[self.n] + np.cumsum([len(x) for x in ids])
        first, self.n = self.n, self.n + len(ids)
        self.starts, self.flat = _with_room(self.starts, self.n + 1), _with_room(self.flat, int(ends[-1]))
        self.starts[first + 1 : self.n + 1] = ends
        self.flat[self.starts[first] : ends[-1]] = np.fromiter(chain.from_iterable(ids), dtype=np.uint32)
        return np.arange(first, self.n, dtype=np.int64)

    def _words(self, words: pa.Array) -> np.ndarray:
        """Numbers of distinct words."""
        if self.memo.size > MEMO_WORDS or self.starts[self.n] > MEMO_IDS:
            self._forget()
        offsets = np.frombuffer(words.buffers()[1], dtype=np.int64, count=words.offset + len(words) + 1)[words.offset :]
        data = np.frombuffer(words.buffers()[2], dtype=np.uint8) if words.buffers()[2] is not None else np.empty(0, dtype=np.uint8)
        size = np.diff(offsets)
        numbers = np.empty(len(words), dtype=np.int64)
        short, long = np.flatnonzero(size <= SHORT), np.flatnonzero(size > SHORT)
        if len(short):
            at = offsets[short, None] + np.arange(SHORT)
            inside = np.arange(SHORT) < size[short, None]
            keys = np.where(inside, data[np.minimum(at, len(data) - 1)] if len(data) else 0, 0).astype(np.uint8).view(np.uint64)
            found = self.memo.find(keys)
            new = np.flatnonzero(found < 0)
            if len(new):
                found[new] = self._add(self._ids(words.take(pa.array(short[new])).to_pylist()))
                self.memo.add(keys[new], found[new])
            numbers[short] = found
        if len(long):
            numbers[long] = self._add(self._ids(words.take(pa.array(long)).to_pylist()))
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Counts of ids by text, and all ids one after another; a null text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.quick:
            got = [e.ids for e in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return np.array([len(x) for x in got], dtype=np.int64), np.fromiter(chain.from_iterable(got), dtype=np.uint32)
        counts, out = np.zeros(len(texts), dtype=np.int64), [np.empty(0, dtype=np.uint32)]
        for rows, part in text_slices(texts, SLICE):
            n, ids = self._encode(part)
            np.add.at(counts, rows, n)
            out.append(ids)
        return counts, np.concatenate(out)

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces = pc.ascii_split_whitespace(texts)
        offsets = np.asarray(pieces.offsets)
        coded = pieces.flatten().dictionary_encode()
        codes = np.asarray(coded.indices)
        chunks = coded.dictionary
        n = len(chunks)
        plain = np.asarray(pc.and_(pc.match_substring_regex(chunks, PLAIN), pc.invert(pc.match_substring(chunks, "<|"))).to_numpy(zero_copy_only=False), dtype=bool)
        quick, slow = np.flatnonzero(plain), np.flatnonzero(~plain)
        words = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(chunks.take(pa.array(quick))), CUTS, r" \1 "))
        word_ptr = np.asarray(words.offsets).astype(np.int64)
        of = words.flatten().dictionary_encode()
        numbers = self._words(of.dictionary)
        sizes, ids = gather(self.starts[: self.n + 1], self.flat, numbers[np.asarray(of.indices)])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        lengths = np.zeros(n, dtype=np.int64)
        lengths[quick] = ends[word_ptr[1:]] - ends[word_ptr[:-1]]
        whole = [e.ids for e in self.tokenizer.encode_batch(chunks.take(pa.array(slow)).to_pylist(), add_special_tokens=False)] if len(slow) else []
        lengths[slow] = [len(x) for x in whole]
        # chunks in the order: quick ones, then slow ones
        order = np.concatenate([quick, slow])
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n)
        chunk_ptr = np.concatenate([[0], np.cumsum(lengths[order])])
        chunk_ids = np.concatenate([ids, *[np.asarray(x, dtype=np.uint32) for x in whole]]) if whole else ids
        by_chunk, out = gather(chunk_ptr, chunk_ids, place[codes])
        ends = np.concatenate([[0], np.cumsum(by_chunk)])
        base = offsets - offsets[0]
        return ends[base[1:]] - ends[base[:-1]], out


def _with_room(array: np.ndarray, size: int) -> np.ndarray:
    """The array, or a copy of at least twice its size that holds `size` elements."""
    if size <= len(array):
        return array
    out = np.zeros(max(size, 2 * len(array)), dtype=array.dtype)
    out[: len(array)] = array
    return out


def batches(path: str) -> Batches:
    """The encoder of a vocabulary file, once in each Python worker."""
    if path not in _BATCHES:
        _BATCHES[path] = Batches(path)
    return _BATCHES[path]


def grouped(stream, rows: int = 6000, size: int = 2 << 20):
    """Arrow batches put together, up to a count of rows or bytes; memory that Arrow has no more use for goes back in between."""
    held, n, b = [], 0, 0
    release = pa.default_memory_pool().release_unused
    for batch in stream:
        if batch.num_rows:
            held.append(batch)
            n, b = n + batch.num_rows, b + batch.nbytes
        if n >= rows or b >= size:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n, b = [], 0, 0
            release()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
