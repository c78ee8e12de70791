"""Rule bitmask ledger: every rule is evaluated once per document.

The ledger keeps the measurements and one bit per failed rule. Policies are
named bit masks applied to stored ledgers, so a new policy or an ablation never
reads a text again. Words are runs of bytes other than space and 9 to 13.
"""

from __future__ import annotations

import operator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridsteps.llm.common import free_name, raw_texts, slices, stored

SPACES = bytes([0x20, *range(0x09, 0x0E)])
CONTINUATION = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
WINDOW = 8

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_adjacent", "n_upper", "n_lower", "n_exclaim"]

# One bit per rule: name and the condition, on measurements by name, under which a document fails, in whole numbers.
RULES = [
    ("few_words", lambda m: m["n_words"] < 20),
    ("repeated_windows", lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
    ("symbols", lambda m: 100 * m["n_symbols"] > 12 * m["n_words"]),
    ("adjacent_words", lambda m: 100 * m["n_adjacent"] > 20 * m["n_words"]),
    ("capitals", lambda m: 100 * m["n_upper"] > 50 * (m["n_upper"] + m["n_lower"])),
    ("exclamations", lambda m: 100 * m["n_exclaim"] > 30 * m["n_words"]),
    ("repeated_lines", lambda m: 100 * m["n_dup_lines"] > 60 * m["n_lines"]),
    ("word_length", lambda m: m["n_words"] > 0 and not 2 * m["n_words"] <= m["word_chars"] <= 15 * m["n_words"]),
]
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}


def mask(*names: str) -> int:
    return sum(BIT[n] for n in names)


BASE = mask("few_words", "repeated_windows")
POLICIES = {
    "base": BASE,
    "web-1": BASE | mask("symbols", "repeated_lines"),
    "web-2": BASE | mask("symbols", "repeated_lines", "adjacent_words", "capitals", "exclamations", "word_length"),
}

LEDGER = "doc_id long, failed long, " + ", ".join(f"{m} long" for m in MEASURES)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for k in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + (hashes[k:k + n] ^ (hashes[k:k + n] >> np.uint64(29)))
    order = np.sort(mixed)
    if not (order[1:] == order[:-1]).any():
        return 0  # equal windows have equal hashes
    # Exact: rank single words, then pairs of ranks for windows twice as long.
    table: dict[bytes, int] = {}
    ranks = np.fromiter((table.setdefault(w, len(table)) for w in words), np.int64, len(words))
    have = 1
    while have < window:
        step = min(have, window - have)
        pairs = ranks[:ranks.size - step] * np.int64(len(words) + 1) + ranks[step:]
        ranks = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        have += step
    found = (np.bincount(ranks)[ranks] > 1).astype(np.int64)
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += found
    edges[window:] -= found
    return int((np.cumsum(edges) > 0).sum())


def measure(text: bytes) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    n = len(text)
    return (
        len(words), len(text.translate(None, CONTINUATION + SPACES)), n - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)), repeated_words(words), len(lines),
        sum(map(operator.eq, words, islice(words, 1, None))),
        n - len(text.translate(None, UPPER)), n - len(text.translate(None, LOWER)), text.count(b"!"),
    )


def failures(m: tuple[int, ...]) -> int:
    """Bits of the failed rules, of measurements in the order of ``MEASURES``."""
    named = dict(zip(MEASURES, m))
    return sum(1 << k for k, (_, fails) in enumerate(RULES) if fails(named))


def text_key() -> Column:
    """What tells the texts of one doc_id apart: two checksums and the length."""
    return F.concat_ws(":", F.xxhash64("text"), F.crc32(F.encode("text", "utf-8")), F.octet_length("text"))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, failed bits, measurements and text_key of every whole text, written once.

    Policies and ablations read the stored rows. A null text has no words and fails
    ``few_words``; repeated rows and rows without doc_id are measured like any other;
    other columns are not read.
    """

    def evaluate(batches):
        for whole in batches:
            for batch in slices(whole):
                found = [measure(t or b"") for t in raw_texts(batch)]
                failed = pa.array([failures(m) for m in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), failed, *(pa.array(c, pa.int64()) for c in zip(*found)), batch.column(2)],
                    names=["doc_id", "failed", *MEASURES, "text_key"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key().alias("text_key"))
    return stored(picked.mapInArrow(evaluate, LEDGER + ", text_key string"), "rule-ledger")


def apply_policy(ledger_rows: DataFrame, policy: str) -> DataFrame:
    """Adds base_failed and kept to ledger rows; needs no text."""
    return ledger_rows.withColumns({
        "base_failed": F.col("failed").bitwiseAND(BASE) != 0,
        "kept": F.col("failed").bitwiseAND(BASE | POLICIES[policy]) == 0,
    })


def ablations(ledger_rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents that fail it, and that only it rejects.

    Documents are counted by failure bits first, at most one row per bit
    pattern, and the rules are read off those counts.
    """
    full = BASE | POLICIES[policy]
    patterns = ledger_rows.groupBy("failed").agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*(
        F.struct(F.lit(name).alias("rule"), F.lit(bit).cast("long").alias("bit"))
        for name, bit in BIT.items() if full & bit)))
    hit = F.col("failed").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("failed").bitwiseAND(full) == F.col("r.bit")
    return patterns.select("failed", "n", rules.alias("r")).groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("n_only"))


def keep_good(docs: DataFrame, policy: str) -> DataFrame:
    """The rows, with all their columns, that a policy keeps.

    The policy is applied to the stored ledger, and rows are taken by doc_id and text:
    rows that share both fare alike, so repeated rows, rows without id and null texts
    (which every policy rejects) are decided like any other. Columns with the
    ledger's names do no harm. An empty table stays empty.
    """
    kept = apply_policy(ledger(docs), policy).filter("kept")
    doc_id, key = free_name(docs, "kept_id"), free_name(docs, "kept_text")
    good = kept.select(F.col("doc_id").alias(doc_id), F.col("text_key").alias(key)).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(good[doc_id]) & (text_key() == good[key])
    return docs.join(good.hint("shuffle_hash"), same, "left_semi")
