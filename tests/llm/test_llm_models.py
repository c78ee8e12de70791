"""Nearest neighbours, sharding, mixing, classifier: against brute force, laws and held-out accuracy."""

import math
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gridsteps.llm import ann, classifier, hilbert, mixing
from gridsteps.llm.common import running_sums



def best(rows, query_ids, k):
    """(query, rank, id, score) by all inner products; equal rows count once."""
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = set()
    for q, v in usable:
        if q in query_ids:
            scores = [(-float((np.array(x) * np.array(v)).sum()), i) for i, x in usable if i != q and len(x) == len(v)]
            out |= {(q, n + 1, i, round(-s, 9)) for n, (s, i) in enumerate(sorted(scores)[:k])}
    return out


def found(df):
    return {(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in df.collect()}


def test_nearest_of_edge_vectors(spark):
    nan = float("nan")
    rows = [(20, [1.0, 2.0]), (20, [1.0, 2.0]), (40, [0.0, 0.0]), (60, None), (80, [nan, 1.0]), (100, [1.0, None]), (1, [3.0, 4.0]),
            (2, [3.0, 4.0]), (3, [-1.0, -2.0]), (4, [math.inf, 0.0]), (120, [1.0, 0.0, 0.0]), (5, [0.5, 0.1, 0.0]), (None, [9.0, 9.0]),
            (140, []), (160, [1e-3, 1e-3])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, v string")
    got = ann.nearest(df, F.col("vec_id") % 20 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert found(got) == best(rows, {i for i, _ in rows if i is not None and i % 20 == 0}, 20)
    assert ann.nearest(df.filter("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_copies_give_the_smallest_ids(spark):
    rows = [(i, [1.0, 1.0]) for i in range(200)] + [(1000 + i, [math.cos(i), math.sin(i)]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    got = found(ann.nearest(df, F.col("vec_id") % 20 == 0))
    assert got == best(rows, {i for i, _ in rows if i % 20 == 0}, 20)


@pytest.mark.parametrize("sizes", [(2048, 4096), (100, 150)])
def test_recall(spark, monkeypatch, sizes):
    monkeypatch.setattr(ann, "CELL_ROWS", sizes[0])
    monkeypatch.setattr(ann, "CHUNK_ROWS", sizes[1])
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 24)) * 2
    x = centres[rng.integers(0, 12, 3000)] + rng.standard_normal((3000, 24)) * rng.uniform(0.2, 1.5, (3000, 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = 0
    for q in range(0, 3000, 20):
        scores = x @ x[q]
        scores[q] = -np.inf
        assert sorted(got[q]) == list(range(1, 21))
        assert all(abs(scores[v] - s) < 1e-9 for v, s in got[q].values())
        hits += len({v for v, _ in got[q].values()} & {*np.argsort(-scores)[:20].tolist()})
    assert hits / (150 * 20) >= 0.95


def test_chi_square_limit():
    draws = (np.random.default_rng(1).standard_normal((200_000, 8)) ** 2).sum(axis=1)
    for p in (0.5, 0.9, 0.97):
        assert abs((draws <= ann.chi_square_limit(p, 8)).mean() - p) < 0.005


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(dimensions, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij")).reshape(dimensions, -1)
    index = hilbert.curve_index(cells, bits)
    assert sorted(index.tolist()) == list(range(1 << bits * dimensions))
    path = cells[:, np.argsort(index)].astype(int)
    assert (np.abs(np.diff(path, axis=1)).sum(axis=0) == 1).all()


def test_running_sums(spark):
    rows = [(i * 7919 % 1000, i % 13) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, w long").repartition(6)
    got, totals = running_sums(df, [F.col("k")], ["w"])
    at = 0
    for n, (k, w) in enumerate(sorted(rows)):
        rows[n] = (k, [n, at])
        at += w
    assert sorted((r.k, r.before) for r in got.collect()) == rows and totals == [1000, at]


@pytest.fixture(scope="module")
def corpus(spark):
    """A third of the rows from one source, nulls in every column, repeated rows, a very long text."""
    rows = [(i, "w " * (i % 37 + 1), ["en", "de", None][i % 3], "hot" if i % 3 == 0 else f"s{i % 11}") for i in range(600)]
    rows += [(7, "again", "en", "s1")] * 3 + [(None, None, None, None), (601, None, "fr", None), (602, "", None, "zero"), (603, "long " * 9000, "en", "s2")]
    return spark.createDataFrame([(*r, "clash") for r in rows],
                                 "doc_id long, text string, lang string, source string, size string").repartition(5)


@pytest.mark.parametrize("shards", [16, 1000])
def test_shards_by_rows(corpus, shards):
    got = hilbert.shard(corpus, shards).collect()
    rows = corpus.collect()
    assert len(got) == len(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted([(r.doc_id, r.size, r.text_crc32) for r in got], key=key) == sorted(
        [(r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows], key=key)
    slots = {}
    for r in got:
        assert r.law == "rows" and r.grown_shard is None
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    counts = [len(slots.get(k, [])) for k in range(shards)]
    assert max(counts) - min(counts) <= 1
    curve = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in curve] == sorted(r.curve for r in got)


def test_shards_by_bytes_and_pruning(spark, corpus, tmp_path):
    small = corpus.filter("doc_id < 600 AND text <> 'again'")
    got = hilbert.shard(small, 8, law="bytes")
    sizes = [r.b for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 2 * 76
    limits = hilbert.bounds(got)
    kept = {r.shard for r in hilbert.prune(limits, "source", "s10", "s10").collect()}
    assert {r.shard for r in got.filter("source = 's10'").collect()} <= kept and len(kept) < 8
    hilbert.write_shards(small, str(tmp_path / "shards"), 8, law="bytes")
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == small.count() and back.drop("_shard").columns == small.columns
    # Null and repeated ids, repeated rows and a column of the folders' name.
    odd = corpus.withColumn("_shard", F.lit("x")).withColumn("row_number", F.lit(1))
    hilbert.write_shards(odd, str(tmp_path / "odd"), 4)
    again = spark.read.parquet(str(tmp_path / "odd"))
    plain = lambda df: sorted(map(repr, df.select("doc_id", "text", "source", "_shard").collect()))
    assert plain(again) == plain(odd)
    assert hilbert.shard(corpus.filter("false")).count() == 0


@given(st.floats(0.01, 0.99), st.integers(1, 50), st.floats(0.01, 0.99), st.integers(1, 50), st.floats(0, 0.999))
@settings(max_examples=200, deadline=None)
def test_pivot_keeps_words(p, a, q, b, u):
    x, y = mixing.pivot(p, a, q, b, u)
    assert x in (0, 1) or y in (0, 1)
    assert 0 <= x <= 1 and 0 <= y <= 1 and abs(x * a + y * b - p * a - q * b) < 1e-6


def plain_targets(sizes, most=3):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        share = left / sum(weight[s] for s in rest) if rest else 0
        over = {s for s in rest if weight[s] * share > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else weight[s] * share for s in names}
        capped |= over


@pytest.mark.parametrize("bucket_rows,fan_in", [(8192, 32), (20, 2)])
def test_mix(corpus, bucket_rows, fan_in):
    short = corpus.filter("doc_id IS NULL OR doc_id <> 603")
    got = mixing.mix(short, bucket_rows=bucket_rows, fan_in=fan_in)
    rows, given_rows = got.collect(), short.collect()
    sizes = {}
    for r in given_rows:
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").split())
    targets = plain_targets(sizes)
    assert sorted((r.doc_id or -1, r["size"]) for r in rows) == sorted((r.doc_id or -1, len((r.text or "").split())) for r in given_rows)
    taken = {}
    for r in rows:
        assert r.taken in [n * r["size"] for n in range(4)]
        key = (r.source_size, round(r.target, 6))
        taken[key] = taken.get(key, 0) + r.taken
    wanted = {}
    for s, n in sizes.items():
        key = (n, round(targets[s], 6))
        wanted.setdefault(key, [0, 0])
        wanted[key][0] += targets[s]
        wanted[key][1] += 37
    assert set(taken) == set(wanted)
    for key, (target, slack) in wanted.items():
        assert abs(taken[key] - target) <= slack
    again = mixing.mix(short.repartition(3, "lang"), bucket_rows=bucket_rows, fan_in=fan_in).collect()
    order = lambda rs: sorted((str(r.doc_id), r["size"], r.source_size, r.taken) for r in rs)
    assert order(again) == order(rows)


def test_mix_is_unbiased(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "w " * (i % 9 + 1), "s", "x") for i in range(90)] + [(100 + i, "w " * 30, "t", "x") for i in range(9)],
                                 "doc_id long, text string, source string, lang string")
    sums = np.zeros(90)
    for seed in range(6):
        monkeypatch.setattr(mixing, "SEED", seed)
        for r in mixing.mix(docs).filter("doc_id < 90").collect():
            sums[r.doc_id] += r.taken / r["size"]
    rate = mixing.mix(docs).filter("doc_id = 0").select(F.col("target") / F.col("source_size")).first()[0]
    assert abs(sums.mean() / 6 - rate) < 0.05 and len({*sums.tolist()}) > 1


def test_mixed_rows(corpus):
    got = mixing.mixed_rows(corpus)
    assert got.columns == corpus.columns
    taken = {}
    for r in mixing.mix(corpus).filter("doc_id IS NOT NULL AND doc_id <> 7").collect():
        if r["size"]:
            taken[r.doc_id] = r.taken // r["size"]
    rows = {}
    for r in got.collect():
        rows[r.doc_id] = rows.get(r.doc_id, 0) + 1
    assert {i: n for i, n in taken.items() if n} == {i: n for i, n in rows.items() if i in taken}
    assert mixing.mixed_rows(corpus.filter("false")).count() == 0
    assert mixing.mix(corpus.filter("text IS NULL")).agg(F.sum("taken")).first()[0] == 0


def test_isotonic():
    w = np.array([1.0, 1, 2, 1, 3])
    assert classifier.isotonic(w, np.array([0.1, 0.5, 0.2, 0.9, 0.8])).round(6).tolist() == [0.1, 0.3, 0.3, 0.825, 0.825]


def test_quality_scores(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    labels = spark.read.parquet(f"{d}/labels.parquet")
    extra = spark.createDataFrame([(None, None, "x", "x", 0), (10**9, "", "x", "x", 0), (10**9 + 1, "long " * 50_000, "x", "x", 0)], docs.schema)
    noisy = labels.unionByName(spark.createDataFrame([(None, 1, 0), (3, None, 0)], labels.schema)).withColumn("x", F.lit("clash"))
    got = classifier.score_quality(docs.unionByName(extra).withColumn("score", F.lit("clash")), noisy)
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == docs.count() + 3
    for i, r in rows.items():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1)
    held = [(rows[r.doc_id], r.quality) for r in labels.collect() if rows[r.doc_id].held_out]
    assert len(held) > 50 and sum(r.predicted == q for r, q in held) / len(held) >= 0.97
    good, bad = ([r.score for r, q in held if q == v] for v in (1, 0))
    assert np.mean([(a > b) + (a == b) / 2 for a in good for b in bad]) >= 0.97
    # Labels of held-out rows change nothing.
    swapped = labels.withColumn("quality", F.when(classifier.remainder(F.col("doc_id")) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in classifier.score_quality(docs, swapped).collect()}
    first = {r.doc_id: r.score for r in classifier.score_quality(docs, labels).collect()}
    assert all(abs(again[i] - s) < 1e-6 for i, s in first.items())
    none = classifier.score_quality(docs.limit(3), labels.filter("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert classifier.score_quality(docs.filter("false"), labels).count() == 0


def test_mixing_splits_what_rows_share(spark, monkeypatch):
    """Most rows without id, or of one id and size: the mix stays near its targets, and buckets stay even."""
    monkeypatch.setattr(mixing, "SALTS", 8)
    rows = [(None if i % 4 else i, "one two", "a") for i in range(2000)] + [(7, "w " * 5, "b")] * 900 + [(i, "w " * (i % 9), "c") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    got = mixing.mix(docs, bucket_rows=64)
    taken, sizes = {}, {}
    for r in got.collect():
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
        sizes[r.source_size] = r.target
        assert r.taken in ([r.size * k for k in range(4)] if r.size else [0])
    assert got.count() == len(rows)
    for size, target in sizes.items():
        assert abs(taken[size] - target) <= 9
    assert got.groupBy().sum("taken").first()[0] == mixing.mix(docs.repartition(3), bucket_rows=64).groupBy().sum("taken").first()[0]


def plain_isotonic(weight, mean):
    """The max-min form of the nearest non-decreasing sequence."""
    n = len(mean)
    avg = lambda a, b: (weight[a:b + 1] * mean[a:b + 1]).sum() / weight[a:b + 1].sum()
    return np.array([max(min(avg(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)])


def test_scores_equal_plain_ridge_and_isotonic(spark):
    """Every step after the statistics with plain numpy: moments, least squares on rows, residuals, bins, pools."""
    from conftest import DATA

    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = docs.collect()
    ids = [r.doc_id for r in rows]
    x = np.array([classifier.statistics((r.text or "").encode()) for r in rows])
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    rest = {i: zlib.crc32(str(i).encode()) % 3 for i in ids}
    quality = {r.doc_id: float(r.quality) for r in labels.collect() if r.quality is not None}
    own = [k for k, i in enumerate(ids) if i in quality and rest[i] != 1]
    y = np.array([quality[ids[k]] for k in own])
    half = np.array([0 if rest[ids[k]] == 0 else 1 for k in own])

    def features(width):
        return classifier._fourier(x, mean, scale, width, classifier.FEATURES, classifier.SEED)

    def fit(f, target, ridge):
        penalty = np.sqrt(np.append(1e-9, np.full(f.shape[1] - 1, ridge * max(1.0, len(f)))))
        return np.linalg.lstsq(np.vstack([f, np.diag(penalty)]), np.append(target, np.zeros(f.shape[1])), rcond=None)[0]

    best = None
    for width in classifier.WIDTHS:
        f = features(width)[own]
        for ridge in classifier.RIDGES:
            error = sum(((f[half != h] @ fit(f[half == h], y[half == h], ridge) - y[half != h]) ** 2).sum() for h in (0, 1))
            if best is None or error < best[0] - 1e-9:
                best = error, width, ridge
    _, width, ridge = best
    f = features(width)
    raw = np.empty(len(own))
    for h in (0, 1):
        raw[half == h] = f[own][half == h] @ fit(f[own][half != h], y[half != h], ridge)
    low, step = -0.5, 2.0 / classifier.BINS
    place = np.clip((raw - low) / step, 0, classifier.BINS - 1).astype(int)
    bins = np.unique(place)
    weight = np.array([(place == b).sum() for b in bins], float)
    levels = plain_isotonic(weight, np.array([y[place == b].mean() for b in bins])).round(12)
    pooled = {v: weight[levels == v].sum() for v in np.unique(levels)}
    levels = plain_isotonic(weight, np.array([(v * pooled[v] + y.mean()) / (pooled[v] + 1) for v in levels]))
    wanted = np.interp(f @ fit(f[own], y, ridge), low + step * (bins + 0.5), levels)
    got = {r.doc_id: r.score for r in classifier.score_quality(docs, labels).collect()}
    assert np.allclose([got[i] for i in ids], wanted, atol=1e-4)
