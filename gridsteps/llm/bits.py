"""Fixed-width bit packing of unsigned ids with numpy.

Eight ids of ``width`` bits fill ``width`` bytes exactly, so ids are handled
as rows of eight lanes; every lane is shifted and masked for all rows at once.
"""

from __future__ import annotations

import numpy as np


def _lanes(width: int):
    for lane in range(8):
        bit = lane * width
        yield lane, bit % 8, bit // 8, (bit + width - 1) // 8


def min_width(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """The ids in ``ceil(n / 8) * width`` bytes; the last row of eight is filled with zeros."""
    if ids.size and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    rows = -(-ids.size // 8)
    lanes = np.zeros(rows * 8, np.uint64)
    lanes[:ids.size] = ids
    lanes = lanes.reshape(rows, 8)
    out = np.zeros((rows, width), np.uint8)
    for lane, shift, low, high in _lanes(width):
        value = lanes[:, lane] << np.uint64(shift)
        for k in range(low, high + 1):
            out[:, k] |= (value >> np.uint64(8 * (k - low))).astype(np.uint8)
    return out.tobytes()


def unpack(data: bytes, width: int, n: int) -> np.ndarray:
    """The first ``n`` ids as unsigned 32-bit integers."""
    rows = np.frombuffer(data, np.uint8).reshape(-1, width)
    out = np.empty((rows.shape[0], 8), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for lane, shift, low, high in _lanes(width):
        value = rows[:, low].astype(np.uint64)
        for k in range(low + 1, high + 1):
            value |= rows[:, k].astype(np.uint64) << np.uint64(8 * (k - low))
        out[:, lane] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[:n]
