"""Periodic runs, byte-level BPE and the divergence audit: against brute force and the tiktoken library."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from conftest import DATA
from gridsteps.llm import byte_bpe, divergence, periodic
from gridsteps.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n long, runs string, ids string, term string"


def brute_runs(words):
    """(start, length, period) of every run, all periods tried."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((b, e - b, q) for (b, e), q in found.items())


def runs_of(texts):
    words, lengths = [], []
    for k, text in enumerate(texts):
        words += [*text, -1 - k]
        lengths.append(len(text) + 1)
    ends = np.cumsum(lengths)
    found = [[] for _ in texts]
    for b, e, q in periodic.find_runs(np.array(words, np.int64), np.array(lengths, np.int64)).tolist():
        k = int(np.searchsorted(ends, b, side="right"))
        found[k].append((b - int(ends[k]) + lengths[k], e - b, q))
    return found


blocks = st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.integers(1, 6), st.integers(0, 39)), max_size=6)


@given(st.lists(blocks, min_size=1, max_size=5))
@settings(max_examples=300, deadline=None)
def test_runs_are_those_of_brute_force(texts):
    texts = [[w for own, times, rest in t for w in own * times + own[:rest]] for t in texts]
    assert runs_of(texts) == [brute_runs(t) for t in texts]


def test_runs_of_long_periods_and_nested_ones():
    rng = np.random.default_rng(3)
    long = rng.integers(0, 1000, 700).tolist()
    nested = ([1, 2] * 9 + [3] * 7 + long[:50]) * 5
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    texts = [long * 4 + long[:5], long * 4, long * 3 + long[:-1], nested, b, [7] * 3000, [7] * 5, [7] * 6, []]
    assert runs_of(texts) == [brute_runs(t) for t in texts]


def test_synchronising_sets_are_dense_and_consistent():
    rng = np.random.default_rng(5)
    words = np.concatenate([rng.integers(0, 3, 400), np.tile(rng.integers(0, 9, 37), 20), rng.integers(0, 3, 400)])
    for scale in (4, 8, 16):
        names = np.array([int(hashlib.md5(words[i:i + scale].tobytes()).hexdigest()[:15], 16) for i in range(words.size)], np.uint64)
        quiet = np.array([any((words[i:i + scale - q] == words[i + q:i + scale]).all() for q in range(1, scale // 3 + 1))
                          if i + scale <= words.size else False for i in range(words.size)])
        chosen = {*periodic.synchronising_set(names, scale, quiet).tolist()}
        context = {}
        for i in range(words.size - 2 * scale + 1):
            context.setdefault(words[i:i + 2 * scale].tobytes(), set()).add(i in chosen)
            if i + 3 * scale - 1 <= words.size and not quiet[i:i + 2 * scale].all():
                assert any(j in chosen for j in range(i, i + scale))
        assert all(len(v) == 1 for v in context.values())


def brute_digest(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for b, length, q in runs for i in range(b + q, b + length)}
    best = (None,) * 4
    for b, length, q in runs:
        if best[1] is None or length * best[2] > best[1] * q:
            best = b, length, q, 1000 * length // q
    listed = "".join(f"{b},{length},{q}\n" for b, length, q in runs)
    rest = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(rest.encode()).hexdigest())


def edge_rows():
    texts = [None, "", " \t\n", "word", "a a a a a a", "é a é a é a é a é", "x y " * 3000, "中" * 5000, "don't 'tis I'll\n\n  x ",
             "Same text", "Same text", "\x1c\x85a b  ", "<|endoftext|>", "0" * 3000 + "'s's"]
    return [(i, t) for i, t in enumerate(texts)] + [(5, "again"), (None, "lone lone lone lone lone lone lone")]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, *(("en", "s") if i else (None, None)), 1, "r", "i", "t") for i, t in edge_rows()]
    return spark.createDataFrame(rows, SCHEMA)


def order(rows):
    return sorted(map(tuple, rows), key=repr)


def test_run_digest_of_edges(spark, edges):
    got = periodic.run_digest(periodic.periodic_runs(edges, periodic.repeat_some))
    assert got.columns == periodic.DIGEST_NAMES
    assert order(got.collect()) == order(brute_digest(i, t) for i, t in edge_rows())
    assert periodic.run_digest(periodic.periodic_runs(edges.filter("false"))).count() == 0


def test_run_query(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    got = order(QUERIES["op11_synchronising_runs"](spark, DATA).collect())
    assert got == order(brute_digest(r.doc_id, r.text) for r in rows) and sum(r[1] for r in got) > 10


@pytest.fixture(scope="module")
def library():
    import tiktoken

    with open(byte_bpe.default_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    import public_tokenizers

    assert byte_bpe.PATTERN == public_tokenizers.PATTERN
    return byte_bpe.Tokenizer(byte_bpe.default_path())


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


odd = st.text(alphabet=st.one_of(st.sampled_from(list("ab '  \n\t1٣x.,stremvld!éß中　\x1c\x85 ́²Ᲊ")),
                                 st.characters(exclude_categories=["Cs"])), max_size=60)


@given(st.lists(odd, max_size=8))
@settings(max_examples=300, deadline=None)
def test_tokens_are_those_of_the_library(own, library, texts):
    got = own.encode(texts)
    assert [ids_of(g) for g in got] == [library.encode_ordinary(t) for t in texts]
    for data, text in zip(got, texts):
        ids = np.frombuffer(data, "<u4")
        ends = own.ends(ids)
        assert own.decode(ids, ends) == text.encode()
        a, b = ids.size // 3, ids.size - ids.size // 4
        if a < b:  # offsets let any stretch be decoded on its own
            first = int(ends[a - 1]) if a else 0
            assert own.decode(ids[a:b], ends[a:b]) == text.encode()[first:int(ends[b - 1])]


@given(st.lists(st.integers(0, 8), min_size=1, max_size=700))
@settings(max_examples=100, deadline=None)
def test_scan_equals_stepping(own, symbols):
    state, wanted = byte_bpe.AT, []
    for s in symbols:
        nxt, start = byte_bpe._step(state, s)
        wanted.append(start)
        state = nxt
    assert own.automaton.piece_starts(np.array(symbols, np.uint8)).tolist() == wanted


def test_long_texts_are_cut_in_segments(own, library, monkeypatch):
    rng = np.random.default_rng(9)
    texts = ["".join(rng.choice(list("ab '\n\tslé1. 中  "), 900)) for _ in range(40)] + ["x" * 999, " " * 999, "ab" * 5000]
    monkeypatch.setattr(byte_bpe, "SEGMENT", 40)
    assert all("".join(own.segments(t)) == t for t in texts)
    assert sum(len(list(own.segments(t))) for t in texts) > 10 * len(texts)
    assert [ids_of(g) for g in own.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_classes_cover_every_codepoint(own):
    assert {chr(c) for c in np.flatnonzero(own.classes == byte_bpe.BLANK)} >= set(" \t\n\x0b\x0c\r\x85  ")
    assert (own.classes == byte_bpe.LETTER).sum() > 130_000 and own.classes[0x1C] == byte_bpe.OTHER


def test_encode_and_decode_of_edges(spark, edges, library):
    encoded = byte_bpe.encode_documents(edges)
    assert encoded.columns == ["doc_id", "ids", "ends"]
    assert order((r.doc_id, ids_of(r.ids)) for r in encoded.collect()) == order(
        (i, library.encode_ordinary(t or "")) for i, t in edge_rows())
    decoded = byte_bpe.decode_documents(encoded)
    assert order((r.doc_id, bytes(r.data).decode()) for r in decoded.collect()) == order((i, t or "") for i, t in edge_rows())
    assert byte_bpe.decode_documents(byte_bpe.encode_documents(edges.filter("false"))).count() == 0


def test_token_digest_query(spark, library):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    wanted = []
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        wanted.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = QUERIES["op12_vectorised_bpe"](spark, DATA)
    assert dict(got.dtypes)["n_tokens"] == "bigint" and order(got.collect()) == order(wanted)


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_audit(rows, least, smoothing, unit, top):
    counts, documents, langs = {}, {}, {}
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        own = Counter(t.translate(LOWER) for t in TERM.findall(text or ""))
        counts.setdefault((lang, source), Counter()).update(own)
        documents.setdefault(lang, Counter()).update(own.keys())
        langs.setdefault(lang, Counter()).update(own)
    out = []
    for (lang, source), own in counts.items():
        kept = [t for t, n in documents[lang].items() if n >= least]

        def p(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + unit * (count[t] + smoothing) // (total + smoothing * len(kept)) for t in kept}

        mine, whole = p(own), p(langs[lang])
        near = [(-sum(abs(mine[t] - x) for t, x in p(c).items()), s) for (g, s), c in counts.items() if g == lang and s != source]
        out += [(lang, source, "pair", s, -v, k) for k, (v, s) in enumerate(sorted(near, key=lambda r: (r[0], r[1].encode())), 1)]
        more = [(whole[t] - mine[t], t) for t in kept if own[t] and mine[t] > whole[t]]
        out += [(lang, source, "term", t, -v, k)
                for k, (v, t) in enumerate(sorted(more, key=lambda r: (r[0], r[1].encode())), 1) if k <= top]
    return out


def test_audit_equals_brute_force(spark, edges):
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "ZZ", "zz", "ｗ", "\U0001F600", "a1b"]
    rows = [(str(rng.choice(["en", "de", ""])), str(rng.choice(["a", "b", "ß", "z"], p=[.6, .2, .1, .1])),
             " ".join(rng.choice(words, int(rng.integers(0, 30))))) for _ in range(300)]
    rows += [(None, None, "w1 w2"), ("en", None, None), ("", "lone", ""), ("xx", "only", "w1 w1"), ("yy", "p", "w1"), ("yy", "q", "")] + rows[:40]
    docs = spark.createDataFrame([(None, t, g, s, 1, "r", "i", "t") for g, s, t in rows], SCHEMA)
    for least, top in ((1, 3), (5, 50), (30, 2), (10_000, 5)):
        got = divergence.audit(docs, least, 5, 1_000_000_000, top)
        assert order(got.collect()) == order(brute_audit(rows, least, 5, 1_000_000_000, top))
    assert dict(got.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}
    assert divergence.audit(docs.filter("false")).count() == 0
    assert divergence.audit(edges).count() >= 0


def test_counts_are_flushed_and_blocks_cut(spark, monkeypatch):
    """Small bounds for what a task holds give the same rows."""
    rng = np.random.default_rng(12)
    rows = [("en", f"s{rng.integers(0, 9)}", " ".join(f"w{i}" for i in rng.integers(0, 400, 80))) for _ in range(200)]
    docs = spark.createDataFrame([(None, t, g, s, 1, "r", "i", "t") for g, s, t in rows], SCHEMA)
    for name, value in (("HELD_TERMS", 300), ("BLOCK_TERMS", 16), ("BLOCK_CELLS", 64)):
        monkeypatch.setattr(divergence, name, value)
    assert order(divergence.audit(docs, 3).collect()) == order(brute_audit(rows, 3, 5, 1_000_000_000, 50))
