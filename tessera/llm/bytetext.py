"""Words of whole Arrow string columns as numpy arrays.

An Arrow string column is one UTF-8 buffer plus offsets, so splitting,
hashing and hashing of word windows run on the buffer without building
a Python string per word.  Null texts count as empty.

Hashes are polynomials over the bytes (or over the mixed word hashes)
modulo 2**64 with an odd base; prefix sums of ``c_k * base**k`` and the
inverse powers of the base give the hash of any slice in constant time.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True

BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**k`` and ``base**-k`` modulo 2**64 for k < n at least."""
    have = _POW.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        up, down = np.full(size, base, U), np.full(size, pow(base, -1, 1 << 64), U)
        up[0] = down[0] = 1
        have = _POW[base] = (np.cumprod(up), np.cumprod(down))
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: every input bit reaches every output bit."""
    h = h.copy()
    h ^= h >> U(30)
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


class Slices:
    """Hash of any slice [s, e) of a sequence of small numbers or hashes."""

    def __init__(self, values: np.ndarray, base: int = BASE_A):
        up, self.down = powers(len(values) + 1, base)
        self.sums = np.zeros(len(values) + 1, U)
        np.cumsum((values.astype(U) + U(1)) * up[:len(values)], out=self.sums[1:])

    def hash(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        return mix((self.sums[e] - self.sums[s]) * self.down[s])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and n + 1 offsets into them (nulls are empty)."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


class Words:
    """Maximal runs of bytes that are not separators, text by text.

    start, end: byte positions in ``data``; doc: index of the text;
    first: n_texts + 1 positions of each text's first word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = ASCII_SPACE):
        n = len(data)
        inside = ~separator[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True  # a text never continues the one before
        start = inside.copy()
        start[1:] &= ~inside[:-1] | edge[1:n]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | edge[1:n]
        self.data, self.offsets = data, offsets
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self._bytes: dict[int, Slices] = {}

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, base: int = BASE_A) -> np.ndarray:
        return self.slices(base).hash(self.start, self.end)

    def slices(self, base: int = BASE_A) -> Slices:
        if base not in self._bytes:
            self._bytes[base] = Slices(self.data, base)
        return self._bytes[base]


def release() -> None:
    """Give freed memory back to the system: workers outlive their task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library, which has its own ways


def chunks(batches: Iterator[pa.RecordBatch], text: str, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds at most ``most`` bytes of text
    (a longer single text stays whole), which bounds the working memory."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = text_buffer(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
            to = min(batch.num_rows, max(at + 1, to))
            yield batch.slice(at, to - at)
            at = to
    release()


def lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow list column: row i holds values[first[i]:first[i + 1]]."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, kind))
