"""Best names for texts by an index on letter counts.

The score of two strings rests on their longest common subsequence, which cannot be longer
than what their letters have in common, counted with repeats. Names are kept in small
groups of similar letters; the most of each letter in a group bounds the score of all its
names. A text looks at groups, best bound first, until no group left can beat or tie what it
has; inside a group a name's own letters bound its score before the subsequence is sought.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

GROUP_NAMES = 32
# Letters share this many counters; sharing only loosens bounds.
COUNTERS = 64
BITS = 64
TEXTS = 512
PAIRS = 50_000

FOUND = "query string, score int, pos bigint, name string, code string, scored bigint"


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of each text as a row of numbers, padded with zero, and the lengths."""
    lengths = np.array([len(t) for t in texts], np.int64)
    codes = np.zeros((len(texts), max(1, int(lengths.max(initial=0)))), np.uint32)
    joined = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes[np.arange(codes.shape[1])[None, :] < lengths[:, None]] = joined + 1
    return codes, lengths


def _counts(codes: np.ndarray) -> np.ndarray:
    """How often each counter's letters occur per row."""
    rows, at = np.nonzero(codes)
    counter = (codes[rows, at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(58)).astype(np.int64)
    return np.bincount(rows * COUNTERS + counter, minlength=len(codes) * COUNTERS).reshape(len(codes), COUNTERS)


def scores(lcs: np.ndarray, total: np.ndarray) -> np.ndarray:
    """100 * 2 * LCS / length of both, rounded half to even; two empty strings score 0."""
    return np.rint(100.0 * 2 * lcs / np.maximum(total, 1)).astype(np.int64)


def _lcs_plain(a: str, b: str) -> int:
    """Length of the longest common subsequence of strings of any length, on Python's own integers."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        hit = state & masks.get(c, 0)
        state = (state + hit | state - hit) & full
    return len(a) - state.bit_count()


class NameIndex:
    """Names in groups of similar letters."""

    def __init__(self, texts: list[str], pos: list[int]):
        self.texts, self.pos = texts, np.array(pos, np.int64)
        self.codes, self.lengths = _codes(texts)
        self.counts = _counts(self.codes)
        self.groups: list[np.ndarray] = []
        stack = [np.arange(len(texts))]
        while stack:
            rows = stack.pop()
            own = self.counts[rows]
            spread = own.max(axis=0) - own.min(axis=0)
            if len(rows) <= GROUP_NAMES:
                self.groups.append(rows)
                continue
            order = np.argsort(own[:, int(spread.argmax())], kind="stable")
            stack += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]
        starts = np.cumsum([0] + [len(g) for g in self.groups])
        flat = np.concatenate(self.groups)
        self.most = np.maximum.reduceat(self.counts[flat], starts[:-1], axis=0)
        self.shortest = np.minimum.reduceat(self.lengths[flat], starts[:-1])
        self.longest = np.maximum.reduceat(self.lengths[flat], starts[:-1])
        self.earliest = np.minimum.reduceat(self.pos[flat], starts[:-1])

    def _group_bounds(self, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Per text and group, the best score that any of its names may have."""
        shared = np.zeros((len(counts), len(self.groups)), np.int64)
        for c in np.flatnonzero(counts.any(axis=0)):
            shared += np.minimum(counts[:, c, None], self.most[None, :, c])
        best_length = np.clip(shared, self.shortest[None, :], self.longest[None, :])
        return scores(np.minimum(shared, best_length), lengths[:, None] + best_length)

    def _lcs(self, codes: np.ndarray, lengths: np.ndarray, texts: list[str], t: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Longest common subsequence of pairs of a text and a name; bit i of the state stands for letter i of the name."""
        out = np.zeros(t.size, np.int64)
        short = self.lengths[n] <= BITS
        for i in np.flatnonzero(~short):
            out[i] = _lcs_plain(self.texts[n[i]], texts[t[i]])
        at = np.flatnonzero(short)
        if not at.size:
            return out
        names = np.zeros((at.size, BITS), np.uint32)
        width = min(BITS, self.codes.shape[1])
        names[:, :width] = self.codes[n[at], :width]
        state = np.full(at.size, ~np.uint64(0))
        for j in range(int(lengths[t[at]].max())):
            letter = codes[t[at], j]
            # Past its end a text has zeros, which must not match the padding of names.
            same = (names == letter[:, None]) & (letter != 0)[:, None]
            mask = np.packbits(same, axis=1, bitorder="little").view(np.uint64)[:, 0]
            hit = state & mask
            state = (state + hit) | (state - hit)
        # Positions past the end of a name stay set.
        out[at] = BITS - np.bitwise_count(state).astype(np.int64)
        return out

    def best(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text the score and number of its best name, of the smallest position if several, and pairs scored."""
        codes, lengths = _codes(texts)
        counts = _counts(codes)
        bounds = self._group_bounds(counts, lengths)
        order = np.lexsort((np.broadcast_to(self.earliest, bounds.shape), -bounds), axis=1)
        score, name = np.full(len(texts), -1), np.full(len(texts), -1)
        place = np.full(len(texts), np.iinfo(np.int64).max)
        scored = np.zeros(len(texts), np.int64)
        # The most promising name of the most promising group first, so that little else has to be scored.
        every = np.arange(len(texts))
        sizes = np.array([len(g) for g in self.groups])[order[:, 0]]
        t, n = np.repeat(every, sizes), np.concatenate([self.groups[g] for g in order[:, 0]] or [np.empty(0, np.int64)])
        bound = scores(np.minimum(counts[t], self.counts[n]).sum(axis=1), lengths[t] + self.lengths[n])
        top = np.lexsort((self.pos[n], -bound, t))[np.cumsum(sizes) - sizes]
        self._score(texts, codes, lengths, counts, t[top], n[top], score, name, place, scored)
        at, wave = 0, 1
        while at < len(self.groups):
            next_ = order[:, at:at + wave]
            bound = np.take_along_axis(bounds, next_, axis=1)
            may = (bound > score[:, None]) | ((bound == score[:, None]) & (self.earliest[next_] < place[:, None]))
            if not (bounds[np.arange(len(texts)), order[:, at]] >= score).any():
                break
            t, g = np.nonzero(may)
            for low in range(0, t.size, PAIRS // GROUP_NAMES):
                own = [self.groups[next_[i, j]] for i, j in zip(t[low:low + PAIRS // GROUP_NAMES], g[low:low + PAIRS // GROUP_NAMES])]
                self._score(texts, codes, lengths, counts, np.repeat(t[low:low + len(own)], [len(x) for x in own]),
                            np.concatenate(own), score, name, place, scored)
            at, wave = at + wave, min(2 * wave, 64)
        return score, name, scored

    def _score(self, texts, codes, lengths, counts, t, n, score, name, place, scored) -> None:
        """Score pairs that their letters allow, and keep each text's best."""
        total = lengths[t] + self.lengths[n]
        bound = scores(np.minimum(counts[t], self.counts[n]).sum(axis=1), total)
        may = (bound > score[t]) | ((bound == score[t]) & (self.pos[n] < place[t]))
        t, n, total = t[may], n[may], total[may]
        if not t.size:
            return
        np.add.at(scored, t, 1)
        found = scores(self._lcs(codes, lengths, texts, t, n), total)
        order = np.lexsort((self.pos[n], -found, t))
        t, n, found = t[order], n[order], found[order]
        first = np.flatnonzero(np.diff(t, prepend=-1))
        t, n, found = t[first], n[first], found[first]
        better = (found > score[t]) | ((found == score[t]) & (self.pos[n] < place[t]))
        score[t[better]], name[t[better]], place[t[better]] = found[better], n[better], self.pos[n[better]]


def match_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Best name per query and block of names; rows come by (block, salt), names (tag 0) before texts (tag 1)."""
    group, index, held, waiting = None, None, [], []

    def answer() -> Iterator[pa.RecordBatch]:
        nonlocal index
        if index is None:
            index = NameIndex([r[0] for r in held], [r[1] for r in held])
        score, name, scored = index.best([text for _, text in waiting])
        found = [held[i] for i in name.tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([q for q, _ in waiting], pa.string()), pa.array(score.astype(np.int32)), pa.array([r[1] for r in found], pa.int64()),
             pa.array([r[2] for r in found], pa.string()), pa.array([r[3] for r in found], pa.string()), pa.array(scored)],
            names=["query", "score", "pos", "name", "code", "scored"])
        waiting.clear()

    for batch in batches:
        for block, salt, tag, text, pos, name, code, query in zip(*(c.to_pylist() for c in batch.columns)):
            if (block, salt) != group:
                if waiting and held:
                    yield from answer()
                group, index, held = (block, salt), None, []
                waiting.clear()
            if tag == 0:
                held.append((text, pos, name, code))
            elif held:
                waiting.append((query, text))
                if len(waiting) == TEXTS:
                    yield from answer()
    if waiting and held:
        yield from answer()
