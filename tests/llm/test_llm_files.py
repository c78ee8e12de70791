"""Token files, archives and packing: round trips against plain Python."""

import hashlib
import base64
import zlib
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from gridsteps.llm import bits, packing, token_files, warc
from gridsteps.llm.tokens import default_path, encoder
from gridsteps.sources.files import open_path

TEXTS = [
    "", None, " ", "\n", "plain words, and more.", "a\nb\n\nc  d \t e", " lead", "trail ", "été 日本語 🙂 x", "<|endoftext|>",
    "word " * 3000, "x" * 4000, "tab\there\n'll don't 12,5\r\nend", "\x01 odd \x02", "a b   c",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(3, "again", "c", 2), (3, "again", "c", 2), (None, "no id", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, start int").repartition(4)


def plain_ids(text):
    enc = encoder(default_path())
    return [*enc.tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@given(st.lists(st.text(alphabet=st.sampled_from(list("ab .,\n\t'1é日s")), max_size=30), min_size=1, max_size=8))
@settings(max_examples=200, deadline=None)
def test_chunked_encoding_is_whole_encoding(texts):
    enc = encoder(default_path())
    assert enc.encode(texts) == [np.array(plain_ids(t)[:-1], enc.dtype).tobytes() for t in texts]


MARKED = ["a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> \n<|endoftext|><|endoftext|>é", "words  <|endoftext|>\nmore words", "<|endoftext", "plain"]


@cache
def fresh_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_path())


def fresh_ids(texts):
    return [e.ids for e in fresh_tokenizer().encode_batch(texts, add_special_tokens=False)]


@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|", "|>", "a", " ", "\n", "é", "\x01", ", "]), max_size=12).map("".join), max_size=6))
@settings(max_examples=200, deadline=None)
def test_added_tokens_are_encoded_as_the_file_says(texts):
    enc = encoder(default_path())
    assert fresh_ids(["a<|endoftext|>b"]) == [[64, 50256, 65]]
    for some in (texts, MARKED):
        assert [np.frombuffer(i, enc.dtype).tolist() for i in enc.encode(some)] == fresh_ids(some)


def test_added_tokens_in_files_and_windows(spark):
    docs = spark.createDataFrame(list(enumerate(MARKED)), "doc_id long, text string").repartition(2)
    wanted, at = [], 0
    for i, ids in enumerate(fresh_ids(MARKED)):
        wanted.append((i, at, len(ids) + 1, crc([*ids, 0])))
        at += len(ids) + 1
    got = token_files.read_token_files(token_files.write_token_files(docs)).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == wanted
    pieces = packing.pieces(packing.pack_sequences(docs)).collect()
    assert sorted((p.doc_id, p.doc_tokens, p.ids_crc32) for p in pieces) == [(i, n, c) for i, _, n, c in wanted]


@pytest.mark.parametrize("width", [1, 5, 8, 16, 17, 31, 32])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1001])
def test_bits(width, n):
    ids = np.random.default_rng(n).integers(0, 1 << width, n, dtype=np.uint64).astype(np.uint32)
    packed = bits.pack(ids, width)
    assert len(packed) == -(-n // 8) * width
    assert (bits.unpack(packed, width, n) == ids).all()


def test_bits_refuse_large_ids():
    with pytest.raises(ValueError):
        bits.pack(np.array([8], np.uint32), 3)


def test_token_files(docs):
    manifest = token_files.write_token_files(docs, block_ids=64, docs_per_file=4)
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, plain_ids(r.text)))
    wanted, at = [], 0
    for r in rows:
        ids = plain_ids(r.text)
        wanted.append((r.doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    got = token_files.read_token_files(manifest, with_ids=True).collect()
    assert sorted((g.start, g.n_tokens) for g in got) == [(w[1], w[2]) for w in wanted]
    assert {tuple(g)[:4] for g in got if g.doc_id not in (None, 3)} == {w for w in wanted if w[0] not in (None, 3)}
    assert all(crc(g.ids) == g.ids_crc32 for g in got)
    first = min(manifest.collect(), key=lambda r: r.file)
    reader = token_files.FileReader(first.path)
    stream = [i for _, _, ids in reader.documents() for i in ids.tolist()]
    assert reader.width == 16 and len(stream) == reader.n_ids == first.n_ids
    for start, n in ((0, 1), (3, 0), (max(0, len(stream) - 5), 5)):
        assert reader.ids(start, min(n, len(stream))).tolist() == stream[start:start + n]


@pytest.mark.parametrize("quantiles", [4096, 3])
def test_range_bounds(spark, monkeypatch, quantiles):
    monkeypatch.setattr(token_files, "QUANTILES", quantiles)
    docs = spark.range(0, 9000, 9).withColumnRenamed("id", "doc_id")
    bounds = token_files.range_bounds(docs, 12)
    cut = np.searchsorted(bounds, np.arange(0, 9000, 9), side="left")
    assert bounds == sorted(set(bounds)) and len(bounds) <= 11 and np.bincount(cut).max() <= 2 * 1000 / 12
    assert token_files.range_bounds(docs, 1) == [] == token_files.range_bounds(docs.filter("false"), 5)


def test_empty_tables(docs, spark):
    none = docs.filter("false")
    assert token_files.read_token_files(token_files.write_token_files(none)).count() == 0
    assert packing.pieces(packing.pack_sequences(none)).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_warc(warc.write_warc(pages)).count() == 0


@pytest.mark.parametrize("window", [8, 1024])
def test_packing(docs, window):
    sequences = packing.pack_sequences(docs, window=window)
    pieces = packing.pieces(sequences).collect()
    total = sum(len(plain_ids(r.text)) for r in docs.collect())
    assert sum(p.length for p in pieces) == total
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sorted(by_sequence) == list(range(-(-total // window)))
    for k, spans in by_sequence.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at == (window if (k + 1) * window <= total else total - k * window)
    texts = {r.doc_id: plain_ids(r.text) for r in docs.collect() if r.doc_id not in (3, None)}
    for p in pieces:
        if p.doc_id in texts:
            ids = texts[p.doc_id]
            assert p.doc_tokens == len(ids) and p.ids_crc32 == crc(ids[p.start:p.start + p.length])
    for s in sequences.collect():
        ids = np.frombuffer(bytes(s.ids), encoder(default_path()).dtype)
        for p in s.pieces:
            assert p.ids_crc32 == crc(ids[p.offset:p.offset + p.length])


PAGES = [(1, "http://a/", "<p>one</p>"), (2, "http://b/ c\n", "<p>one</p>"), (3, None, None), (4, "http://d/", ""),
         (5, "http://e/", "WARC/1.1\r\n\r\n" + "é" * 50_000), (6, "http://f/", "<p>one</p>"), (6, "http://f/", "<p>one</p>"),
         (None, "http://g/", "<p>one</p>"), (None, "http://h/", "alone"), (7, "http://i/", "last")]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*p, "clash") for p in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(3)


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("least", [0, 8])
def test_archives(pages, compress, least):
    rows = warc.read_warc(warc.write_warc(pages, min_bytes=least, compress=compress))
    assert warc.gaps(rows).count() == 0
    firsts = {}
    for page_id, _, html in PAGES:
        if page_id is not None and len((html or "").encode()) >= least:
            firsts[html or ""] = min(page_id, firsts.get(html or "", page_id))
    wanted = []
    for page_id, _, html in PAGES:
        first = firsts.get(html or "")
        again = first is not None and first != page_id
        wanted.append((page_id, len((html or "").encode()), sha(html), "revisit" if again else "response", first if again else None))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.page_records(rows).collect()]
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)
    assert sorted(got, key=key) == sorted(wanted, key=key)
    texts = {r.target_uri: bytes(r.payload).decode() for r in rows.filter("record_type = 'response'").collect() if r.target_uri}
    assert texts["http://e/"] == PAGES[4][2]


def damage(path, spans):
    system, inner = open_path(path)
    with system.open_input_file(inner) as f:
        data = bytearray(f.read())
    for at, new in spans:
        data[at:at + len(new)] = new
    with system.open_output_stream(inner, compression=None) as f:
        f.write(bytes(data))
    return bytes(data)


@pytest.mark.parametrize("compress", [True, False])
def test_salvage_recovers_later_records(spark, pages, compress):
    one = pages.filter("page_id <> 5").coalesce(1)
    manifest = warc.write_warc(one, min_bytes=1 << 40, compress=compress)
    paths = [r.path for r in manifest.collect()]
    path = max(paths, key=lambda p: len(list(warc.salvage(p))))
    before = list(warc.salvage(path))
    assert len(before) >= 2 and before[0][1] == 0
    damage(path, [(before[0][1] + 30, b"\xff\xff\xff\xff")])
    after = list(warc.salvage(path))
    assert after[0][2] == "gap" and after[0][1] == 0 and after[0][9] == before[1][1]
    assert after[1:] == before[1:]
    log = warc.gaps(warc.read_warc(manifest)).collect()
    assert [(r.path, r.offset, r.gap_bytes) for r in log] == [(path, 0, before[1][1])] and log[0].reason
    # A file that ends inside a record keeps the records before it.
    system, inner = open_path(path)
    with system.open_input_file(inner) as f:
        data = f.read()
    with system.open_output_stream(inner, compression=None) as f:
        f.write(data[:-3])
    cut = list(warc.salvage(path))
    assert cut[1:-1] == before[1:-1] and cut[-1][2] == "gap" and cut[-1][1] == before[-1][1]


def test_shared_ids_fill_several_files(spark):
    rows = [(None, f"none {i}") for i in range(300)] + [(5, f"five {i % 50}") for i in range(600)] + [(i, f"t{i}") for i in range(10, 110)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    manifest = token_files.write_token_files(docs, docs_per_file=50)
    sizes = [r.n_docs for r in manifest.collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 2 * 50
    got = token_files.read_token_files(manifest).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 300 + [5] * 600 + list(range(10, 110))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens


def test_lost_records_are_reported(spark, pages):
    manifest = warc.write_warc(pages, min_bytes=1 << 40)
    assert warc.read_pages(manifest).count() == pages.count()
    path = max((r.path for r in manifest.collect()), key=lambda p: len(list(warc.salvage(p))))
    damage(path, [(30, b"\xff\xff\xff\xff")])
    lost = warc.lost_records(manifest, warc.read_warc(manifest)).collect()
    assert [(r.path, r.n_records - r.n_found) for r in lost] == [(path, 1)]
    with pytest.raises(ValueError, match="records came back"):
        warc.read_pages(manifest)
    assert warc.read_pages(manifest, strict=False).count() == pages.count() - 1
