"""Periodic runs of words by string synchronising sets.

A run is a stretch of words with smallest period q, at least four periods and six
words long, that no neighbouring word extends. For a scale t, a power of two, a
synchronising set holds positions selected by hashes of the t words from each
position: position i is in it when the smallest hash of positions i to i + t,
places inside highly periodic regions left out, is that of i or of i + t. The choice
depends on the 2t words from i only, so a run repeats it once per period, and every
stretch of t positions holds one unless the words around it have a period of t / 3
or less.

So a run with a period q from t to below 2t holds two successive places of equal
context, q apart: each pair of such places proposes its distance as a period. Longer
contexts propose, in the same way, the periods up to 8t / 3 of all stretches of 8t
words; these are the highly periodic regions that larger scales leave out. Periods
too small for the first scale are found by comparing the words with themselves,
shifted. Proposals only say where to look: every stretch is compared and extended
word by word, and of equal stretches the smallest period stays.

The texts of a batch are searched as one sequence with a different mark after each.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridsteps.llm.common import raw_texts, slices

# A run spans this many periods and words at least.
PERIODS, LEAST_WORDS = 4, 6
FIRST_SCALE, SMALL_PERIODS = 4, 5
GATHER = 1 << 20
SEED = 0x9E3779B97F4A7C15

RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _joined(left: np.ndarray, right: np.ndarray, level: int) -> np.ndarray:
    """Hashes of twice as many words."""
    return _mix(left * np.uint64(0xD6E8FEB86659FD93) + right + np.uint64(level))


def _shifted(values: np.ndarray, by: int, fill) -> np.ndarray:
    """values[i + by] at i."""
    out = np.full(values.size, fill, values.dtype)
    if by < values.size:
        out[:values.size - by] = values[by:]
    return out


def synchronising_set(names: np.ndarray, scale: int, periodic: np.ndarray) -> np.ndarray:
    """Positions selected by the hashes of ``scale`` words; ``periodic`` marks the places left out."""
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    ids = np.where(periodic, none, _mix(names ^ np.uint64(SEED)) >> np.uint64(1))
    least, width = ids, 1
    while width < scale:
        least = np.minimum(least, _shifted(least, width, none))
        width *= 2
    last = _shifted(ids, scale, none)
    least = np.minimum(least, last)
    chosen = (least != none) & ((ids == least) | (last == least))
    chosen[max(0, names.size - 2 * scale + 1):] = False
    return np.flatnonzero(chosen)


def _proposed(places: np.ndarray, context: np.ndarray, low: int, high: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of pairs of successive places with equal context, ``low`` to ``high`` words apart.

    Places that follow one another in one stretch are one proposal.
    """
    keys = context[places]
    order = np.lexsort((places, keys))
    at, keys = places[order], keys[order]
    distance = at[1:] - at[:-1]
    good = (keys[1:] == keys[:-1]) & (distance >= low) & (distance <= high)
    start, period = at[:-1][good], distance[good]
    order = np.lexsort((start, period))
    start, period = start[order], period[order]
    new = np.ones(start.size, bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] - start[:-1] > length)
    return start[new], period[new]


def _extent(words: np.ndarray, start: np.ndarray, period: np.ndarray, forward: bool) -> np.ndarray:
    """How many words from ``start`` on (or before it) equal those ``period`` later."""
    n = words.size
    total = np.zeros(start.size, np.int64)
    open_ = np.arange(start.size)
    width = 32
    while open_.size:
        left = []
        for low in range(0, open_.size, max(1, GATHER // width)):
            own = open_[low:low + max(1, GATHER // width)]
            steps = total[own, None] + np.arange(width)
            a = start[own, None] + steps if forward else start[own, None] - 1 - steps
            b = a + period[own, None]
            inside = (a >= 0) & (b < n)
            same = inside & (words[np.where(inside, a, 0)] == words[np.where(inside, b, 0)])
            whole = same.all(axis=1)
            total[own] += np.where(whole, width, same.argmin(axis=1))
            left.append(own[whole])
        open_ = np.concatenate(left)
        width = min(2 * width, 1 << 14)
    return total


def _stretches(words: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Rows (begin, end, period) of the whole stretches around the proposals, each once."""
    if not start.size:
        return np.empty((0, 3), np.int64)
    begin = start - _extent(words, start, period, False)
    end = start + _extent(words, start, period, True) + period
    return np.unique(np.stack([begin, end, period], axis=1), axis=0)


def _small(words: np.ndarray, period: int) -> np.ndarray:
    """The stretches of one small period, three periods long at least."""
    if words.size <= period:
        return np.empty((0, 3), np.int64)
    edge = np.flatnonzero(np.diff(words[period:] == words[:-period], prepend=False, append=False))
    begin, end = edge[::2], edge[1::2] + period
    long = end - begin >= 3 * period
    return np.stack([begin[long], end[long], np.full(int(long.sum()), period)], axis=1)


def _periodic_places(found: np.ndarray, scale: int, n: int) -> np.ndarray:
    """True where the next ``scale`` words have a period of a third of ``scale`` or less."""
    own = found[(3 * found[:, 2] <= scale) & (found[:, 1] - found[:, 0] >= scale)]
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, own[:, 0], 1)
    np.add.at(change, own[:, 1] - scale + 1, -1)
    return np.cumsum(change[:n]) > 0


def find_runs(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows (begin, end, period) of all runs, by begin, then period.

    ``words`` holds a number per word, equal for equal words, and after each text
    a mark that occurs once; ``lengths`` are those of the texts with their mark.
    """
    found = [_small(words, q) for q in range(1, SMALL_PERIODS + 1)]
    names = _mix(words.astype(np.uint64) + np.uint64(SEED))
    place = np.arange(words.size)  # where each word of the texts that are left stands in all
    scale, width = FIRST_SCALE, 1
    while True:
        # A text too short for four periods of this scale has none at larger ones either.
        long = lengths > PERIODS * scale
        if not long.any():
            break
        if not long.all():
            keep = np.repeat(long, lengths)
            place, names, lengths = place[keep], names[keep], lengths[long]
        while width < scale:
            names = _joined(names, _shifted(names, width, 0), width)
            width *= 2
        double = _joined(names, _shifted(names, scale, 0), scale)
        fourfold = _joined(double, _shifted(double, 2 * scale, 0), 2 * scale)
        # Stretches that lie in the texts left; none reaches over the end of its text.
        so_far = np.concatenate(found)
        at = np.searchsorted(place, so_far[:, 0])
        own = at < place.size
        own[own] = place[at[own]] == so_far[own, 0]
        moved = so_far[own] + (at - so_far[:, 0])[own, None] * np.array([1, 1, 0])
        sync = synchronising_set(names, scale, _periodic_places(moved, scale, names.size))
        local = words[place]
        pairs = [_proposed(sync, double, scale, 2 * scale - 1, 2 * scale),
                 _proposed(sync, fourfold, scale, 8 * scale // 3, 4 * scale)]
        start, period = (np.concatenate(c) for c in zip(*pairs))
        new = _stretches(local, start, period)
        new[:, :2] += (place[np.minimum(new[:, 0], place.size - 1)] - new[:, 0])[:, None]
        found.append(new)
        scale *= 2
    every = np.concatenate(found)
    length = every[:, 1] - every[:, 0]
    every = every[(length >= LEAST_WORDS) & (length >= PERIODS * every[:, 2])]
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    first = np.ones(len(every), bool)
    first[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
    every = every[first]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def repeat_some(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the texts, by a checksum of their id, with a stretch of words repeated to the end.

    Rows without id stay as they are.
    """
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a:a + p]
    return words[:a] + (block * (-(-(n - a) // p)))[:n - a]


def periodic_runs(docs: DataFrame, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, runs, collapsed: the periodic runs of every whole text.

    Words are runs of characters other than space and 9 to 13. ``runs`` is ordered
    by start, then period; ``collapsed`` is the text's words with every run cut to
    its first period, joined by spaces. ``rewrite`` changes the words of a row
    before the search. One row per input row, also for repeated rows and rows
    without id; null and empty texts have no words and no runs. Only doc_id and
    text are read, so other columns cannot clash. An empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                numbers: dict = defaultdict()
                numbers.default_factory = numbers.__len__
                ids = part.column(0).to_pylist()
                texts = [(t or b"").split() for t in raw_texts(part)]
                if rewrite:
                    texts = [rewrite(i, w) for i, w in zip(ids, texts)]
                lengths = np.array([len(w) + 1 for w in texts], np.int64)
                ends = np.cumsum(lengths)
                words = np.empty(int(ends[-1]), np.int64)
                for w, end in zip(texts, ends.tolist()):
                    words[end - 1 - len(w):end - 1] = np.fromiter(map(numbers.__getitem__, w), np.int64, len(w))
                words[ends - 1] = -1 - np.arange(len(texts))
                runs = find_runs(words, lengths)
                cut = np.searchsorted(runs[:, 0], [0, *ends.tolist()])
                listed, rest = [], []
                for k, w in enumerate(texts):
                    own = runs[cut[k]:cut[k + 1]] - np.array([1, 1, 0]) * (ends[k] - lengths[k])
                    listed.append([{"start": b, "length": e - b, "period": q} for b, e, q in own.tolist()])
                    rest.append(collapsed(w, own))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(lengths - 1),
                     pa.array(listed, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                     pa.array(rest, pa.binary())], names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(run, RUNS)


def run_digest(found: DataFrame) -> DataFrame:
    """One row per row of ``periodic_runs``: number of runs, the one of most periods, and checksums.

    Of equally many periods the smallest start, then period, counts; without runs
    its four columns are null. Checksums are those of empty bytes where there is
    nothing.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, runs, rest in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "runs", "collapsed"))):
                text, best = hashlib.sha256(), None
                for r in runs:
                    start, length, period = r["start"], r["length"], r["period"]
                    text.update(f"{start},{length},{period}\n".encode())
                    if best is None or length * best[2] > best[1] * period:
                        best = start, length, period
                head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
                out.append((doc_id, len(runs), *head, text.hexdigest(), hashlib.sha256(rest).hexdigest()))
            columns = list(zip(*out)) or [()] * len(DIGEST_NAMES)
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=DIGEST_NAMES)

    return found.mapInArrow(run, ", ".join(
        f"{n} {'string' if n.endswith('sha256') else 'long'}" for n in DIGEST_NAMES))


DIGEST_NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
