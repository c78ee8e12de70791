"""Token ids of whole texts, as little-endian id bytes.

The byte-level pre-tokenizer never joins what stands on both sides of a space
or line end that a visible character follows, so a text is split there and the
ids of frequent chunks are kept in the worker. Chunks of Latin letters and signs
are split by the pre-tokenizer's own pattern, and the model encodes each
distinct piece once. The ids are those of the whole text; the tokenizer encodes
texts that hold an added token, such as an end mark, as a whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable

import numpy as np

from gridsteps.llm.common import worker_registry

# A space or line end that is not directly followed by a visible character.
_ODD_SPACE = re.compile(r" (?=\s|\Z)")
_ODD_LINE = re.compile(r"\n(?=\s|\Z)")
_CHUNK_START = re.compile(r" (?=\S)")
# In front of chunks that no space precedes, and in place of a line end.
BARE, LINE = "\x01", "\x02"
# Chunks of which every regular expression library has the same view.
_LATIN = re.compile("[\n!-~\u00a1-\u024f]+")
CACHE_ENTRIES, PIECE_ENTRIES = 1_000_000, 300_000

def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str) -> "Encoder":
    """One encoder per worker process and file; it stays there from task to task."""
    held = worker_registry()
    if ("encoder", path) not in held:
        held["encoder", path] = Encoder(path)
    return held["encoder", path]


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def byte_alphabet() -> dict[int, int]:
    """The byte-level alphabet: visible Latin-1 characters stand for themselves, the other bytes for 256 and on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + k for k, b in enumerate(others)}


class Encoder:
    """Encodes batches of texts; ``dtype`` is the narrowest that holds every id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec.get("pre_tokenizer") or {}
        self.chunked = (
            before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space") and not spec.get("normalizer")
        )
        # Texts with one of these are not cut.
        self.marks = (BARE, LINE, *(t["content"] for t in spec.get("added_tokens") or []))
        self.known: dict[str, bytes] = {}
        if self.chunked:
            import public_tokenizers
            import regex

            self.pieces_of = regex.compile(public_tokenizers.PATTERN).findall
            self.model = self.tokenizer.model
            self.code = "H" if self.dtype.itemsize == 2 else "I"
            self.alphabet = byte_alphabet()
            self.pieces: dict[str, bytes] = {}

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes()
                for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _chunks(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of chunks; a space precedes all that are not marked."""
        texts = [c[1:] if c[:1] == BARE else "\n" if c == LINE else " " + c for c in chunks]
        known, pieces, fresh, tokenize, code = self.known, self.pieces, {}, self.model.tokenize, self.code
        if len(pieces) > PIECE_ENTRIES:
            pieces.clear()

        def piece(p: str) -> bytes:
            """Ids of what the pre-tokenizer takes as one word."""
            spaced = p[0] == " "
            found = (known.get(p[1:]) or fresh.get(p)) if spaced else pieces.get(p)
            if not found:
                mapped = (p.replace(" ", "\u0120").replace("\n", "\u010a") if p.isascii()
                          else p.encode().decode("latin-1").translate(self.alphabet))
                found = array(code, [t.id for t in tokenize(mapped)]).tobytes()
                (fresh if spaced else pieces)[p] = found
            return found

        ids: dict[str, bytes] = {}
        others: list[tuple[str, str]] = []
        for chunk, text in zip(chunks, texts):
            word = text.lstrip(" ")
            if not word or not _LATIN.fullmatch(word):
                others.append((chunk, text))
            elif word.isalpha():
                ids[chunk] = piece(text)
            elif word[-1] in ".,;:!?" and word[:-1].isalpha():
                ids[chunk] = piece(text[:-1]) + piece(word[-1])
            else:
                ids[chunk] = b"".join(map(piece, self.pieces_of(text)))
        ids.update(zip([c for c, _ in others], self._plain([t for _, t in others])))
        ids.update((p[1:], v) for p, v in fresh.items())
        return ids

    def _split(self, text: str) -> list[str]:
        if _ODD_SPACE.search(text) or _ODD_LINE.search(text):
            parts = _CHUNK_START.split(text)
            parts[0] = BARE + parts[0]
            return parts
        if "\n" not in text:
            parts = text.split(" ")
            parts[0] = BARE + parts[0]
            return parts
        parts = []
        for line in text.split("\n"):
            words = line.split(" ")
            words[0] = BARE + words[0]
            parts += words
            parts.append(LINE)
        parts.pop()
        return parts

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Id bytes of each text; an empty text has none."""
        texts = list(texts)
        if not self.chunked:
            return self._plain(texts)
        whole = [i for i, t in enumerate(texts) if any(m in t for m in self.marks)]
        if not whole:
            return self._cut(texts)
        held = {*whole}
        found = dict(zip(whole, self._plain([texts[i] for i in whole])))
        others = [i for i in range(len(texts)) if i not in held]
        found.update(zip(others, self._cut([texts[i] for i in others])))
        return [found[i] for i in range(len(texts))]

    def _cut(self, texts: list[str]) -> list[bytes]:
        chunks, ends = [], []
        for text in texts:
            chunks += self._split(text)
            ends.append(len(chunks))
        ids = list(map(self.known.get, chunks))
        missing = [i for i, v in enumerate(ids) if v is None]
        if missing:
            names = [chunks[i] for i in missing]
            new = self._chunks(list(set(names)))
            for i, name in zip(missing, names):
                ids[i] = new[name]
            if len(self.known) + len(new) > CACHE_ENTRIES and 3 * len(missing) > len(chunks):
                self.known = {}  # the texts have changed their vocabulary
            if len(self.known) + len(new) <= CACHE_ENTRIES:
                self.known.update(new)
        return [b"".join(ids[a:b]) for a, b in zip([0, *ends], ends)]
