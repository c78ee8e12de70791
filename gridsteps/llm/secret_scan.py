"""Secret scans: fixed patterns, and random strings found by token efficiency.

A vocabulary learnt from natural text spends many tokens on random characters.
Long unbroken strings with few characters per token are reported, unless they
are known digests or identifiers. Inside a string that readable names make
longer, every stretch of at least as many characters is tested as well.
Offsets count code points, ends exclusive.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate, pairwise

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridsteps.llm.common import raw_texts, slices, worker_registry

KINDS = ("assign", "access", "hex", "random")

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_HINTS = (b"passw", b"secret", b"token", b"api")

# Candidates of the token test.
STRING_CHARS = 20
STRING = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
RATIO = 2.0
# Characters of hexadecimal MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_CHARS = (32, 40, 56, 64, 96, 128)
DIGEST = re.compile(r"(?:(?:md5|sha\d+)[-:=])?[0-9a-fA-F]+")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
# Words of letters joined by single separators, with or without numbers at their ends; words of three and more
# letters must reach the ratio, too.
IDENTIFIER = re.compile(r"[A-Za-z]*[a-z]{3,}[A-Za-z]*\d{0,4}(?:[-_/=+][A-Za-z]*\d{0,4})*|[\d_/=+-]+")
WORD = re.compile(r"[A-Za-z]{3,}")
# Parts between separators: numbers and one or two letters say nothing, a word may have a number at its end.
PART = re.compile(r"[A-Za-z0-9]+")
SHORT = re.compile(r"\d+|[A-Za-z]{1,2}\d{0,4}")
NUMBERED = re.compile(r"([A-Za-z]+)(\d{0,4})")
UUID_INSIDE = re.compile(rf"(?<![A-Za-z0-9]){UUID.pattern}(?![A-Za-z0-9])")

FOUND = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def vocabulary(path: str):
    """The vocabulary of a rank file, loaded once per worker process."""
    held = worker_registry()
    if ("ranks", path) not in held:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        held["ranks", path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                                mergeable_ranks=ranks, special_tokens={})
    return held["ranks", path]


def is_dense(text: str, path: str, ratio: float) -> bool:
    """True for a string with few characters per token."""
    return len(text) < ratio * len(vocabulary(path).encode_ordinary(text))


def is_known(text: str) -> bool:
    """True for a UUID or a digest of a usual length."""
    return bool(UUID.fullmatch(text) or
                DIGEST.fullmatch(text) and len(re.sub(r"^.*[-:=]", "", text)) in DIGEST_CHARS)


def is_random(text: str, path: str, ratio: float = RATIO) -> bool:
    """True for a string with few characters per token that is no known digest or identifier."""
    if is_known(text) or not is_dense(text, path, ratio):
        return False
    return not IDENTIFIER.fullmatch(text) or any(is_dense(w, path, ratio) for w in WORD.findall(text))


def random_parts(text: str, path: str, ratio: float = RATIO) -> list[tuple[int, int]]:
    """(start, end) of the random parts of a string that is not random as a whole.

    Every stretch of at least STRING_CHARS characters that begins and ends at
    tokens is tested; what it touches is reported from separator to separator.
    Numbers, short parts, digests, UUIDs, rows of separators and those beside
    readable parts count as characters without tokens.
    """
    if is_known(text):
        return []
    vocab = vocabulary(path)
    ends = list(accumulate(map(len, vocab.decode_tokens_bytes(vocab.encode_ordinary(text))), initial=0))
    known = [m.span() for m in UUID_INSIDE.finditer(text)]
    plain = bytearray(len(text))  # 1: a character of a token that does not count
    parts: list[tuple[int, int]] = []
    odd: list[tuple[int, int]] = []
    for m in PART.finditer(text):
        s, e = m.span()
        parts.append((s, e))
        word = NUMBERED.fullmatch(m[0])
        if SHORT.fullmatch(m[0]) or is_known(m[0]) or any(a <= s and e <= b for a, b in known):
            plain[s:e] = b"\1" * (e - s)
        elif word and not is_dense(word[1], path, ratio):
            plain[s + len(word[1]):e] = b"\1" * len(word[2])
        else:
            odd.append((s, e))
    starts, stops = {s for s, _ in odd}, {e for _, e in odd}
    at = 0
    for s, e in [*parts, (len(text), len(text))]:
        if s > at and not (s <= at + 2 and at in stops and s in starts):
            plain[at:s] = b"\1" * (s - at)
        at = e
    sums = list(accumulate((ratio * (not plain[a]) - (b - a) for a, b in pairwise(ends)), initial=0.0))
    # A longer stretch above zero has one of these lengths above zero inside.
    most = 2 * STRING_CHARS + max((b - a for a, b in pairwise(ends)), default=0)
    found: list[tuple[int, int]] = []
    near = 0
    for j, end in enumerate(ends):
        while ends[near] <= end - STRING_CHARS:
            near += 1
        i = near - 1
        while i >= 0 and end - ends[i] <= most and sums[i] >= sums[j]:
            i -= 1
        if i >= 0 and end - ends[i] <= most:
            a = ends[i]
            if found and a < found[-1][1]:
                a = min(a, found.pop()[0])
                while found and a < found[-1][1]:
                    a = min(a, found.pop()[0])
            found.append((a, end))
    spans: list[tuple[int, int]] = []
    for a, b in found:
        own = odd[bisect_right(odd, a, key=lambda p: p[1]):bisect_left(odd, b, key=lambda p: p[0])]
        own = own or parts[bisect_right(parts, a, key=lambda p: p[1]):bisect_left(parts, b, key=lambda p: p[0])]
        if spans and own[0][0] < spans[-1][1]:
            spans[-1] = spans[-1][0], own[-1][1]
        else:
            spans.append((own[0][0], own[-1][1]))
    return spans


def random_spans(text: str, base: list[tuple[int, int, int]], path: str, ratio: float = RATIO) -> list[tuple[int, int]]:
    """(start, end) of random strings and parts in what the sorted base spans leave uncovered."""
    spans: list[tuple[int, int]] = []
    k = 0
    for m in STRING.finditer(text):
        at, stop = m.span()
        while k < len(base) and base[k][1] <= at:
            k += 1
        free, i = [], k
        while i < len(base) and base[i][0] < stop:
            free.append((at, base[i][0]))
            at = max(at, base[i][1])
            i += 1
        for s, e in [*free, (at, stop)]:
            if e - s < STRING_CHARS:
                continue
            rest = text[s:e]
            if is_random(rest, path, ratio):
                spans.append((s, e))
            else:
                spans += [(s + a, s + b) for a, b in random_parts(rest, path, ratio)]
    return spans


def scan(raw: bytes, path: str, ratio: float = RATIO) -> list[tuple[int, int, int]]:
    """(start, end, index in KINDS) of all spans of one text, in that order."""
    lowered = raw.lower()
    hinted = any(h in lowered for h in ASSIGN_HINTS)
    longest = max(map(len, raw.split()), default=0)
    if not hinted and longest < HEX_CHARS:
        return []
    text = raw.decode()
    spans: list[tuple[int, int, int]] = []
    if hinted:
        spans += [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if longest >= HEX_CHARS:
        if b"AKIA" in raw:
            spans += [(*m.span(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
        spans += [(*m.span(), 2) for m in HEX.finditer(text)]
        spans += [(s, e, 3) for s, e in random_spans(text, sorted(spans), path, ratio)]
    return sorted(spans)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def scan_documents(docs: DataFrame, path: str | None = None, ratio: float = RATIO) -> DataFrame:
    """Counts per kind, digest of the base spans and all spans of every whole text.

    A null text counts as empty and has no spans. Rows without doc_id and
    repeated rows give a row each; other columns are not read.
    """
    path = path or default_path()

    def find(batches):
        for whole in batches:
            for batch in slices(whole):
                rows = []
                for t in raw_texts(batch):
                    spans = scan(t or b"", path, ratio)
                    base = [s for s in spans if s[2] < 3]
                    rows.append((*(sum(s[2] == k for s in spans) for k in range(4)),
                                 hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]),
                     pa.array(columns[4]), pa.array(columns[5])],
                    names=[c.split()[0] for c in FOUND.split(", ")])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return picked.mapInArrow(find, FOUND)


def redact(docs: DataFrame, mark: str = "[redacted]", path: str | None = None, ratio: float = RATIO) -> DataFrame:
    """The same rows with every span replaced by ``mark``; n_chars of changed rows follows the text."""
    path = path or default_path()
    schema = docs.schema
    counted = "n_chars" in schema.names

    def clean(batches):
        for whole in batches:
            for batch in slices(whole):
                texts, chars, changed = raw_texts(batch), [], False
                if counted:
                    chars = batch.column(batch.schema.get_field_index("n_chars")).to_pylist()
                for i, t in enumerate(texts):
                    spans = scan(t or b"", path, ratio)
                    if not spans:
                        continue
                    changed, text, parts, at = True, t.decode(), [], 0
                    for s, e, _ in spans:
                        if s >= at:
                            parts += [text[at:s], mark]
                        at = max(at, e)
                    text = "".join(parts) + text[at:]
                    texts[i] = text.encode()
                    if counted:
                        chars[i] = len(text)
                if changed:
                    k = batch.schema.get_field_index("text")
                    batch = batch.set_column(k, batch.schema.field(k), pa.array(texts, pa.binary()).cast(batch.schema.field(k).type))
                    if counted:
                        k = batch.schema.get_field_index("n_chars")
                        batch = batch.set_column(k, batch.schema.field(k), pa.array(chars, batch.schema.field(k).type))
                yield batch

    return docs.mapInArrow(clean, schema)
