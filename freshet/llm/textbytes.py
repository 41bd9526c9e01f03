"""Vectorized work on the bytes of a batch of texts, for use inside tasks.

A batch is cut into slices of about SLICE bytes, so that the arrays derived from it stay small; a text longer than that
is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 21
# Words and windows up to this many bytes are hashed side by side, longer ones one by one.
LONG_WORD = 64

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

FNV_PRIME = np.uint64(0x100000001B3)
FNV_START = np.uint64(0xCBF29CE484222325)


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive slices of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (finalizer of a multiply-and-shift hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the text that each lies in; no word crosses from one text to the next."""
    inside = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    stop = inside
    stop[:-1] &= ~inside[1:] | edge[1:-1] if len(data) > 1 else True
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, longest: int = LONG_WORD) -> np.ndarray:
    """64-bit hash of each span of bytes. Spans over `longest` are hashed one by one and differently."""
    length = ends - starts
    out = np.full(len(starts), FNV_START, np.uint64)
    for j in range(min(longest, int(length.max(initial=0)))):
        at = np.flatnonzero(length > j)
        out[at] = (out[at] ^ data[starts[at] + j]) * FNV_PRIME
    for i in np.flatnonzero(length > longest):
        out[i] = np.uint64(int.from_bytes(blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "big"))
    return mixed_bits(out)
