"""Arrays packed into one compressed value, for compact shuffles."""

from __future__ import annotations

import numpy as np
import zstandard


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block, byte planes apart."""
    planes = [a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(planes))


def unpacked(block: bytes, *shapes: tuple[str, int]) -> list[np.ndarray]:
    data, out, start = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8), [], 0
    for kind, n in shapes:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(data[start : start + n * size].reshape(size, n).T).view(kind).reshape(n))
        start += n * size
    return out
