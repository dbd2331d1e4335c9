"""Integer arrays as short byte strings, for rows that carry many of them."""

from __future__ import annotations

import numpy as np

KINDS = (np.uint8, np.uint16, np.uint32, np.int64)


def pack(values: np.ndarray) -> bytes:
    """The narrowest kind that holds the values, after one byte naming it."""
    low, high = (int(values.min()), int(values.max())) if len(values) else (0, 0)
    kind = next((k for k, dt in enumerate(KINDS[:3]) if low >= 0 and high <= np.iinfo(dt).max), 3)
    return bytes([kind]) + values.astype(KINDS[kind]).tobytes()


def unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, KINDS[blob[0]], offset=1).astype(np.int64)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending values as differences."""
    return pack(np.diff(values, prepend=0))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob))
