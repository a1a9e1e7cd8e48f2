"""Arrow columns of texts as numpy bytes, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 4 << 20


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a column and the offsets of its texts; NULL is empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def text_blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets from 0) of runs of texts with at most ``limit`` bytes, or of one longer text."""
    data, offsets = buffer_of(texts)
    first, rows = 0, len(texts)
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
