"""Quality classifier: ridge regression on random Fourier features, calibrated.

Statistics of each whole text are standardised with sums over all documents.
Random cosines of them approximate a Gaussian kernel. Every task sums the normal
equations of its labelled rows, the sums are added up block by block, and the
driver solves one small system. Each half of the labelled rows is scored by the
weights of the other half; isotonic regression on those scores, counted in bins,
turns scores into probabilities.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridsteps.llm.common import raw_texts, slices, stored, width_of
from gridsteps.llm.quality_rules import measure

STATISTICS = ["log_words", "word_chars", "symbols", "repeated_lines", "repeated_windows", "adjacent", "capitals",
              "exclamations", "distinct_words", "longest_word", "line_words", "digits", "signs", "non_ascii", "top_word"]
FEATURES = 256
SEED = 29
# Kernel widths in standard deviations per square root of the number of statistics, and ridges per labelled row.
WIDTHS = (1.0, 2.0, 4.0)
RIDGES = (1e-6, 1e-5, 1e-4, 1e-3, 1e-2)
BINS = 2048
BLOCK_ROWS = 32

_ASCII = bytes(range(128))
_DIGITS = bytes(range(48, 58))
_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def statistics(text: bytes) -> list[float]:
    """The statistics of one text; an empty text has zeros."""
    n_words, chars, symbols, dup_lines, repeats, lines, adjacent, upper, lower, exclaim = measure(text)
    words = text.split()
    n, size = max(1, n_words), max(1, len(text))
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    return [
        math.log1p(n_words), chars / n, math.log1p(100 * symbols / n), dup_lines / max(1, lines), repeats / n,
        math.sqrt(adjacent / n), upper / max(1, upper + lower), math.log1p(100 * exclaim / n),
        len(counts) / n, math.log1p(max(map(len, words), default=0)), math.log1p(n_words / max(1, lines)),
        math.log1p(100 * (len(text) - len(text.translate(None, _DIGITS))) / size),
        (len(text) - len(text.translate(None, _SIGNS))) / size,
        len(text.translate(None, _ASCII)) / size,
        max(counts.values(), default=0) / n,
    ]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and x, the statistics, of every whole text."""

    def find(batches):
        for whole in batches:
            for batch in slices(whole):
                x = [statistics(t or b"") for t in raw_texts(batch)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return picked.mapInArrow(find, "doc_id long, x array<double>")


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; null without id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, width: float, features: int, seed: int) -> np.ndarray:
    """A column of ones and the random cosines of standardised statistics, cut at five deviations."""
    rng = np.random.default_rng(seed)
    frequency = rng.standard_normal((x.shape[1], features)) / (width * math.sqrt(x.shape[1]))
    phase = rng.uniform(0, 2 * math.pi, features)
    z = np.clip((x - mean) / scale, -5, 5)
    return np.concatenate([np.ones((x.shape[0], 1)), math.sqrt(2 / features) * np.cos(z @ frequency + phase)], axis=1)


def normal_equations(train: DataFrame, widths: tuple[float, ...], maps, features: int) -> dict:
    """Per kernel width and half of the rows: the sums of f f', with f the features and the label.

    Partial sums leave each task as blocks of matrix rows and are added where
    blocks of one number meet, one block at a time. The result has a fixed size.
    """
    side, n_stats = features + 2, len(STATISTICS)
    blocks = -(-side // BLOCK_ROWS)

    def partial(batches):
        sums = np.zeros((len(widths), 2, side, side))
        for batch in batches:
            x = _matrix(batch.column(0), n_stats)
            y = batch.column(1).to_numpy(zero_copy_only=False)[:, None]
            half = batch.column(2).to_numpy(zero_copy_only=False)
            for low in range(0, x.shape[0], 2048):
                for k, width in enumerate(widths):
                    f = np.concatenate([maps(x[low:low + 2048], width), y[low:low + 2048]], axis=1)
                    for h in (0, 1):
                        own = f[half[low:low + 2048] == h]
                        sums[k, h] += own.T @ own
        if sums[0, :, 0, 0].any():
            for k in range(len(widths)):
                for h in (0, 1):
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([(k * 2 + h) * blocks + b for b in range(blocks)], pa.int32()),
                        "sums": [sums[k, h, b * BLOCK_ROWS:(b + 1) * BLOCK_ROWS].tobytes() for b in range(blocks)]})

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(*(c.to_pylist() for c in batch.columns)):
                part = np.frombuffer(data)
                totals[block] = totals[block] + part if block in totals else part
        if totals:
            yield pa.RecordBatch.from_pydict({"block": pa.array(list(totals), pa.int32()),
                                              "sums": [t.tobytes() for t in totals.values()]})

    schema = "block int, sums binary"
    parts = train.select("x", "y", "half").mapInArrow(partial, schema)
    summed = parts.repartition(min(2 * blocks * len(widths), width_of(train.sparkSession)), "block").mapInArrow(add, schema)
    found = {r.block: np.frombuffer(bytes(r.sums)) for r in summed.collect()}
    equations = {}
    for k, width in enumerate(widths):
        for h in (0, 1):
            rows = [found.get((k * 2 + h) * blocks + b) for b in range(blocks)]
            equations[width, h] = (np.zeros((side, side)) if rows[0] is None
                                   else np.concatenate(rows).reshape(side, side))
    return equations


def _solve(sums: np.ndarray, ridge: float) -> np.ndarray:
    gram, target = sums[:-1, :-1], sums[:-1, -1]
    penalty = np.full(gram.shape[0], ridge * max(1.0, gram[0, 0]))
    penalty[0] = 1e-9
    return np.linalg.solve(gram + np.diag(penalty), target)


def _error(sums: np.ndarray, w: np.ndarray) -> float:
    """Squared error of weights on the rows of other sums."""
    v = np.append(w, -1.0)
    return float(v @ sums @ v)


def isotonic(weight: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """The nearest non-decreasing sequence, by pooling neighbours that are out of order."""
    pools: list[list[float]] = []
    for w, m in zip(weight, mean):
        pools.append([w, m, 1])
        while len(pools) > 1 and pools[-2][1] >= pools[-1][1]:
            w2, m2, n2 = pools.pop()
            w1, m1, n1 = pools.pop()
            pools.append([w1 + w2, (w1 * m1 + w2 * m2) / (w1 + w2), n1 + n2])
    return np.concatenate([np.full(int(n), m) for _, m, n in pools]) if pools else np.empty(0)


def score_quality(docs: DataFrame, labels: DataFrame, features: int = FEATURES, seed: int = SEED) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Labels count for rows with a remainder other than 1; labels without a
    quality or an id are left out, and every labelled row counts, repeats
    included. Rows without id are scored, are not held out and never teach. A
    null text counts as empty. Without any label all scores are 0.5. Other
    columns are not read.
    """
    n_stats = len(STATISTICS)
    rows = stored(measured(docs), "classifier-statistics")
    moments = rows.agg(F.count("*"), *(F.avg(F.col("x")[k]) for k in range(n_stats)),
                       *(F.stddev_pop(F.col("x")[k]) for k in range(n_stats))).first()
    mean = np.array([v or 0.0 for v in moments[1:n_stats + 1]])
    scale = np.array([v or 1.0 for v in moments[n_stats + 1:]])
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("double").alias("y"))
    known = known.withColumn("rest", remainder(F.col("label_id"))).filter("rest != 1")
    train = stored(rows.join(known, rows["doc_id"] == known["label_id"]).select(
        "x", "y", F.when(F.col("rest") == 0, 0).otherwise(1).alias("half")), "classifier-train")
    maps = lambda x, width: _fourier(x, mean, scale, width, features, seed)
    sums = normal_equations(train, WIDTHS, maps, features)

    options = [(sum(_error(sums[w, 1 - h], _solve(sums[w, h], r)) for h in (0, 1)), w, r) for w in WIDTHS for r in RIDGES]
    _, width, ridge = min(options)
    halves = [_solve(sums[width, 1 - h], ridge) for h in (0, 1)]
    weights = _solve(sums[width, 0] + sums[width, 1], ridge)
    if not sums[width, 0].any() or not sums[width, 1].any():
        halves = [weights, weights]
    low, step = -0.5, 2.0 / BINS  # scores of a 0/1 target; what lies outside falls in the end bins

    def bins_of(batches):
        for batch in batches:
            f = maps(_matrix(batch.column(0), n_stats), width)
            half = batch.column(2).to_numpy(zero_copy_only=False)
            raw = np.where(half == 0, f @ halves[0], f @ halves[1])
            place = np.clip((raw - low) / step, 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(place), batch.column(1)], names=["bin", "y"])

    counted = train.select("x", "y", "half").mapInArrow(bins_of, "bin int, y double").groupBy("bin").agg(
        F.count("*").alias("n"), F.sum("y").alias("s")).orderBy("bin").collect()  # one row per bin
    if counted:
        centres = low + step * (np.array([r.bin for r in counted]) + 0.5)
        # A row of each class is added so that no probability is 0 or 1.
        weight = np.array([r.n for r in counted], float)
        levels = isotonic(weight, np.array([r.s / r.n for r in counted]))
        share = sum(r.s for r in counted) / weight.sum()
        pooled = {v: weight[levels == v].sum() for v in np.unique(levels)}
        levels = np.array([(v * pooled[v] + share) / (pooled[v] + 1) for v in levels])
        levels = isotonic(weight, levels)
    else:
        centres, levels = np.array([0.0]), np.array([0.5])

    def score(batches):
        for batch in batches:
            raw = maps(_matrix(batch.column(1), n_stats), width) @ weights
            # Between calibrated bins the raw score breaks ties, without crossing a bin.
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.interp(raw, centres, levels))],
                                             names=["doc_id", "score"])

    scored = rows.select("doc_id", "x").mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
