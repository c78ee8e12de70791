"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding by offsets.

Pre-tokenisation runs no regular expression over texts. Every codepoint gets a
class from an array; class and following codepoints give a symbol; each symbol is
a function from states to states. These functions form a small monoid, whose
composition is associative, so the state before every codepoint comes out of a
blocked prefix scan over table lookups. Where a state and a symbol start a new
piece, the text is cut. Distinct pieces are merged by rank once and kept.

Texts of a batch are scanned together with a mark between them; a long text is
scanned in segments, cut where a piece starts whatever came before.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridsteps.llm.common import slices, worker_registry

# Fixed value: the only pattern that the automaton below stands for.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SEGMENT = 1_000_000
BLOCK = 256
CACHED_CHARS, CACHE_ENTRIES = 48, 150_000
SLICE_BYTES = 500_000
SHORT_BYTES, MERGED_PIECES = 48, 20_000
NO_RANK = np.int64(1) << 40
ENCODED = "doc_id long, ids binary, ends binary"
DECODED = "doc_id long, ids binary, data binary"

# Classes of codepoints.
OTHER, LETTER, NUMBER, BLANK = range(4)
# Symbols: end of a text; letter; number; other; a space and another blank before a visible codepoint; a blank
# before a blank or an end; an apostrophe before one and before two letters of a contraction.
END, L, N, O, SPACE, LINE, GAP, SHORT, LONG = range(9)
# States: between pieces; inside letters, numbers, others; after a piece's first space; inside blanks; one and two
# letters of a contraction to go.
(AT, IN_L, IN_N, IN_O, PREFIX, IN_GAP, ONE, TWO) = range(8)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a piece starts at the symbol."""
    if symbol == END:
        return AT, True
    if symbol == GAP:
        return IN_GAP, state != IN_GAP
    if symbol in (SPACE, LINE):
        return (PREFIX if symbol == SPACE else AT), True
    if symbol == L:
        if state in (ONE, TWO):
            return (AT if state == ONE else ONE), False
        return IN_L, state not in (IN_L, PREFIX)
    if symbol == N:
        return IN_N, state not in (IN_N, PREFIX)
    # Others; an apostrophe begins a contraction only where it begins a piece.
    inside = state in (IN_O, PREFIX)
    if inside or symbol == O:
        return IN_O, not inside
    return (ONE if symbol == SHORT else TWO), True


class Automaton:
    """The transition functions of the symbols, closed under composition."""

    def __init__(self):
        states, symbols = range(8), range(9)
        self.starts = np.array([[_step(q, s)[1] for s in symbols] for q in states])
        own = [tuple(_step(q, s)[0] for q in states) for s in symbols]
        elements = {tuple(states): 0}
        queue = [tuple(states)]
        while queue:
            f = queue.pop()
            for g in own:
                h = tuple(g[q] for q in f)
                if h not in elements:
                    elements[h] = len(elements)
                    queue.append(h)
        n, listed = len(elements), list(elements)
        self.size = n
        kind = np.uint8 if n <= 256 else np.uint16
        self.of_symbol = np.array([elements[f] for f in own], kind)
        self.compose = np.array([elements[tuple(g[q] for q in f)] for f in listed for g in listed], kind)
        self.apply = np.array(listed, np.uint8)

    def _then(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return self.compose[first.astype(np.int32) * self.size + second]

    def scan(self, elements: np.ndarray) -> np.ndarray:
        """Composition of all functions up to each position: blocks side by side, then the blocks' totals."""
        n = elements.size
        if n <= 1:
            return elements
        width = min(BLOCK, n)
        rows = -(-n // width)
        padded = np.zeros(rows * width, elements.dtype)
        padded[:n] = elements
        columns = padded.reshape(rows, width).T.copy()
        for j in range(1, width):
            columns[j] = self._then(columns[j - 1], columns[j])
        if rows > 1:
            before = np.zeros(rows, elements.dtype)
            before[1:] = self.scan(columns[-1])[:-1]
            for j in range(width):
                columns[j] = self._then(before, columns[j])
        return columns.T.reshape(-1)[:n]

    def piece_starts(self, symbols: np.ndarray) -> np.ndarray:
        """True where a piece starts; the state before the first symbol is ``AT``."""
        states = np.zeros(symbols.size, np.uint8)
        states[1:] = self.apply[self.scan(self.of_symbol[symbols]), AT][:-1]
        return self.starts[states, symbols]


def codepoint_classes() -> np.ndarray:
    """The class of every codepoint, by the character tables of the tiktoken library itself."""
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    classes = np.zeros(0x110000, np.uint8)
    ranks = {bytes([b]): b for b in range(256)}
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        found = bytes(probe.encode_ordinary(every)).decode()
        classes[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return classes


def _codepoints(text: str) -> np.ndarray:
    if text.isascii():
        return np.frombuffer(text.encode("ascii"), np.uint8)
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Vocabulary:
    """The tokens of a rank file; decodes."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        words = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            words[rank] = token
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(words), np.uint8)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset in the text after each token."""
        return np.cumsum(self.lengths[ids]).astype("<u4")

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> bytes:
        """The bytes of consecutive tokens; offsets say where each token's bytes go."""
        if not ids.size:
            return b""
        lengths = self.lengths[ids]
        base = int(ends[0]) - int(lengths[0])
        place = ends.astype(np.int64) - lengths - base
        at = np.repeat(self.first[ids] - place, lengths)
        return self.letters[at + np.arange(at.size)].tobytes()


class Tokenizer(Vocabulary):
    """Encodes texts by a rank file."""

    def __init__(self, path: str):
        super().__init__(path)
        # All pairs of tokens that make a token, as sorted numbers, and its rank.
        pairs = sorted((self.ranks[w[:k]] << 32 | self.ranks[w[k:]], r) for w, r in self.ranks.items()
                       for k in range(1, len(w)) if w[:k] in self.ranks and w[k:] in self.ranks)
        self.pair_keys, self.pair_ranks = (np.array(c, np.int64) for c in zip(*pairs))
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.classes = codepoint_classes()
        self.automaton = Automaton()
        # Ids of pieces met lately, and of those met before; a full cache becomes the older one.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # --- pieces ---

    def symbols(self, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The symbol of each codepoint; ``ends`` are the places of line ends that stand for the end of a text."""
        classes = self.classes[codes]
        symbols = np.array([O, L, N, LINE], np.uint8)[classes]
        blank = classes == BLANK
        follows = np.append(blank[1:], True)
        symbols[blank & follows] = GAP
        symbols[blank & ~follows & (codes == 0x20)] = SPACE
        quotes = np.flatnonzero(codes == 0x27)
        if quotes.size:
            ahead = np.append(codes, np.zeros(2, codes.dtype))
            one, two = ahead[quotes + 1], ahead[quotes + 2]
            symbols[quotes[np.isin(one, list(b"stmd"))]] = SHORT
            long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            symbols[quotes[long]] = LONG
        symbols[ends] = END
        return symbols

    def pieces(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """All pieces of the texts in order, and how many each text has."""
        joined = "\n".join(texts) + "\n"
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        codes = _codepoints(joined)
        starts = np.flatnonzero(self.automaton.piece_starts(self.symbols(codes, ends)))
        real = np.ones(starts.size, bool)
        real[np.searchsorted(starts, ends)] = False
        last = np.append(starts[1:], len(joined))
        cut = [joined[a:b] for a, b in zip(starts[real].tolist(), last[real].tolist())]
        return cut, np.diff(np.searchsorted(starts[real], ends), prepend=0)

    def segments(self, text: str) -> Iterator[str]:
        """Parts of a long text; each begins with a blank before a visible codepoint, where a piece always starts."""
        at = 0
        while len(text) - at > 2 * SEGMENT:
            look, cut = at + SEGMENT, None
            while cut is None and look < len(text) - 1:
                blank = self.classes[_codepoints(text[look:look + 4096])] == BLANK
                found = np.flatnonzero(blank[:-1] & ~blank[1:])
                if found.size:
                    cut = look + int(found[0])
                look += 4095
            if cut is None:
                break
            yield text[at:cut]
            at = cut
        yield text[at:]

    # --- merging ---

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Id bytes of pieces: ranks after merging, time and again, the leftmost pair of the lowest rank."""
        out: list[bytes] = [b""] * len(pieces)
        short = []
        for i, piece in enumerate(pieces):
            if piece in self.ranks:
                out[i] = self.ranks[piece].to_bytes(4, "little")
            elif len(piece) > SHORT_BYTES:
                out[i] = np.array(self._merge_long(piece), "<u4").tobytes()
            else:
                short.append(i)
        for low in range(0, len(short), MERGED_PIECES):
            own = short[low:low + MERGED_PIECES]
            for i, ids in zip(own, self._merge_short([pieces[i] for i in own])):
                out[i] = ids
        return out

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), self.pair_keys.size - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NO_RANK)

    def _merge_short(self, pieces: list[bytes]) -> list[bytes]:
        """One merge per round in every piece that still has one, side by side."""
        ids = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        lengths = np.array([len(p) for p in pieces], np.int64)
        which = np.arange(len(pieces))  # the pieces that are left
        out: list[bytes] = [b""] * len(pieces)
        ends = np.cumsum(lengths)
        ranks = np.full(ids.size, NO_RANK)
        ranks[:-1] = self._pair_ranks(ids[:-1], ids[1:])
        ranks[ends - 1] = NO_RANK
        while which.size:
            starts = np.cumsum(lengths) - lengths
            best = np.minimum.reduceat(ranks, starts)
            open_ = best < NO_RANK
            if not open_.all():
                final = ids.astype("<u4")
                for k in np.flatnonzero(~open_).tolist():
                    out[which[k]] = final[starts[k]:starts[k] + lengths[k]].tobytes()
                keep = np.repeat(open_, lengths)
                ids, ranks, which, lengths, best = ids[keep], ranks[keep], which[open_], lengths[open_], best[open_]
                if not which.size:
                    break
            owner = np.repeat(np.arange(which.size), lengths)
            hits = np.flatnonzero(ranks == best[owner])
            first = hits[np.diff(owner[hits], prepend=-1) > 0]
            ids[first] = best
            keep = np.ones(ids.size, bool)
            keep[first + 1] = False
            ids, ranks, owner = ids[keep], ranks[keep], owner[keep]
            lengths = lengths - 1
            at = first - np.arange(first.size)
            for left in (at, at - 1):
                left = left[left >= 0]
                right = np.minimum(left + 1, ids.size - 1)
                together = (owner[left] == owner[right]) & (left < right)
                ranks[left] = np.where(together, self._pair_ranks(ids[left], ids[right]), NO_RANK)
        return out

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap; parts are linked by where they begin."""
        ranks, n = self.ranks, len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, end = heapq.heappop(heap)
            # Stale when a part is gone or has grown since.
            if not alive[i] or after[i] >= n or after[after[i]] != end:
                continue
            alive[after[i]] = False
            after[i] = end
            if end < n:
                before[end] = i
                r = ranks.get(piece[i:after[end]])
                if r is not None:
                    heapq.heappush(heap, (r, i, after[end]))
            j = before[i]
            if j >= 0:
                r = ranks.get(piece[j:end])
                if r is not None:
                    heapq.heappush(heap, (r, j, end))
        return [ranks[piece[i:after[i]]] for i in range(n) if alive[i]]

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """Id bytes of each piece."""
        found = list(map(self.known.get, pieces))
        missing = [i for i, v in enumerate(found) if v is None]
        if missing:
            distinct = list({pieces[i] for i in missing})
            new = {p: v for p in distinct if (v := self.older.get(p))}
            fresh = [p for p in distinct if p not in new]
            new.update(zip(fresh, self.merge([p.encode() for p in fresh])))
            for i in missing:
                found[i] = new[pieces[i]]
            if len(self.known) > CACHE_ENTRIES:
                self.known, self.older = {}, self.known
            self.known.update((p, v) for p, v in new.items() if len(p) <= CACHED_CHARS)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; an empty text has none."""
        out: list[bytes] = []
        short: list[str] = []

        def flush() -> None:
            if short:
                pieces, counts = self.pieces(short)
                ids = self._ids(pieces)
                ends = np.cumsum(counts).tolist()
                out.extend(b"".join(ids[a:b]) for a, b in zip([0, *ends], ends))
                short.clear()

        for text in texts:
            if len(text) <= 2 * SEGMENT:
                short.append(text)
                continue
            flush()
            out.append(b"".join(b"".join(self._ids(self.pieces([part])[0])) for part in self.segments(text)))
        flush()
        return out


def held(kind: type, path: str) -> Vocabulary:
    """One per worker process and file; it stays there from task to task."""
    kept = worker_registry()
    if (kind.__name__, path) not in kept:
        kept[kind.__name__, path] = kind(path)
    return kept[kind.__name__, path]


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids, ends: the token ids of every whole text and the byte offset after each token.

    Both are little-endian unsigned 32-bit integers. One row per input row, also
    for repeated rows and rows without id; null and empty texts have no tokens.
    Ids are those of the tiktoken library for ``PATTERN`` without special
    tokens. Only doc_id and text are read, so other columns cannot clash. An
    empty table gives no rows.
    """
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held(Tokenizer, path)
        for batch in batches:
            for part in slices(batch, size=SLICE_BYTES):
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = own.encode(texts)
                ends = [own.ends(np.frombuffer(i, "<u4")).tobytes() for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(ids, pa.binary()), pa.array(ends, pa.binary())],
                    names=["doc_id", "ids", "ends"])

    return docs.select("doc_id", "text").mapInArrow(run, ENCODED)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids, data: the UTF-8 bytes of each row of ``encode_documents``.

    One row per input row; without tokens the bytes are empty. Null ids or
    offsets count as none. Other columns are not read.
    """
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held(Vocabulary, path)
        for batch in batches:
            for part in slices(batch, "ids", SLICE_BYTES):
                rows = zip(part.column(1).to_pylist(), part.column(2).to_pylist())
                data = [own.decode(np.frombuffer(i or b"", "<u4"), np.frombuffer(e or b"", "<u4")) for i, e in rows]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(data, pa.binary())],
                                                 names=["doc_id", "ids", "data"])

    return encoded.select("doc_id", "ids", "ends").mapInArrow(run, DECODED)
