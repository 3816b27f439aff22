"""Arrays of numbers as short binary values."""

from __future__ import annotations

import numpy as np
import zstandard


def squeeze(values: np.ndarray) -> bytes:
    """Bytes of equal weight together, which compresses numbers better."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes() if len(values) else b""
    return zstandard.ZstdCompressor(level=1).compress(raw)


def spread(body: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, each once. Sorting numbers is much faster here than hashing them."""
    ordered = np.sort(values)
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered
