"""Parts of bounded size of Arrow arrays of texts, however long the texts are."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

_WHITE = re.compile(rb"[\x20\x09-\x0D]")


def text_slices(texts: pa.Array, size: int):
    """Rows and their texts, about `size` bytes at a time; a longer text comes in parts that end before white space.

    texts is a large_string array without nulls; no bytes are copied.
    """
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=texts.offset + len(texts) + 1)[texts.offset :]
    if not len(texts) or texts.buffers()[2] is None:
        return
    data = texts.buffers()[2]
    at, rows = [int(offsets[0])], []
    for row, (begin, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        while end - begin > size and (white := _WHITE.search(data, begin + size, end)):
            begin = white.start()
            at.append(begin)
            rows.append(row)
        at.append(end)
        rows.append(row)
    at, rows = np.array(at, dtype=np.int64), np.array(rows, dtype=np.int64)
    k = 0
    while k < len(rows):
        stop = max(k + 1, int(np.searchsorted(at, at[k] + size, side="right")) - 1)
        own = np.ascontiguousarray(at[k : stop + 1])
        yield rows[k:stop], pa.LargeStringArray.from_buffers(stop - k, pa.py_buffer(own), data)
        k = stop
