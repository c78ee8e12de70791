"""Word shingles of whole texts as sets of 64-bit hashes, with numpy.

Words are runs of bytes other than space and 9 to 13; A to Z count as a to z.
A text of fewer words than a shingle has, but at least one, has its whole
sequence as the only member of its set.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
SEGMENT = 4_000_000

_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(0, 1 << 64, 64 * 256, dtype=np.uint64)
_STEP = _rng.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and hash of each word; a tabulated hash per position and byte, summed."""
    buf = np.frombuffer(data.lower(), np.uint8)
    letter = ~_IS_SPACE[buf]
    edge = np.flatnonzero(np.diff(letter, prepend=False, append=False))
    starts, lengths = edge[::2], edge[1::2] - edge[::2]
    if not starts.size:
        return starts, np.empty(0, np.uint64)
    chars = buf[letter].astype(np.int64)
    at = np.cumsum(lengths) - lengths
    position = np.arange(chars.size) - np.repeat(at, lengths)
    values = _BYTE[((position & 63) << 8) | chars]
    if int(lengths.max()) > 64:
        values *= (2 * (position >> 6) + 1).astype(np.uint64)
    return starts, mix(np.add.reduceat(values, at) + lengths.astype(np.uint64))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """As above, for data of any length: segments are cut at white space."""
    if len(data) <= 2 * SEGMENT:
        return _word_hashes(data)
    found, at = [], 0
    while at < len(data):
        end = min(len(data), at + SEGMENT)
        while end < len(data) and not _IS_SPACE[data[end]]:
            end += 1
        starts, hashes = _word_hashes(data[at:end])
        found.append((starts + at, hashes))
        at = end
    return np.concatenate([s for s, _ in found]), np.concatenate([h for _, h in found])


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    starts, hashes = word_hashes(b"\n".join(texts))
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    first = np.searchsorted(starts, begin)
    n = max(0, hashes.size - words + 1)
    windows = np.zeros(n, np.uint64)
    for k in range(words):
        windows += hashes[k:k + n] * _STEP[k]
    windows = mix(windows)
    sets = []
    for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
        if high - low >= words:
            sets.append(np.unique(windows[low:high - words + 1]))
        elif high > low:
            own = (hashes[low:high] * _STEP[:high - low]).sum(dtype=np.uint64, keepdims=True)
            sets.append(mix(own + np.full(1, high - low, np.uint64) * _STEP[15]))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if a.size > b.size:
        a, b = b, a
    if not a.size:
        return 0
    at = np.searchsorted(b, a)
    at[at == b.size] = b.size - 1
    return int((b[at] == a).sum())
