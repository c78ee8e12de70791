"""Nearest neighbours by stable random projections and kd-trees.

Vectors get one coordinate more, so that the largest inner product becomes the
smallest distance, and are projected on a few Gaussian directions. Of a vector
at distance s the squared projected distance is s times s times a chi-square
variable, so once the projected distance of the next neighbour is large against
the k-th distance found, the chance that a nearer vector is still unseen is known;
the search stops when it is below ``1 - SURE``.

A kd-tree over projections, fitted on a bounded sample, deals all vectors into
cells; cells are cut into chunks of bounded size with kd-trees of their own. A
query first searches its home cell, then every cell whose box does not pass the
stopping test. Equal vectors are searched as one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gridsteps.llm.common import stored, width_of

DIRECTIONS = 8
SURE = 0.97
SAMPLE = 16_384
CELL_ROWS, MAX_CELLS = 2048, 4096
CHUNK_ROWS, BUCKET_ROWS = 4096, 32
QUERY_ROWS, QUERY_BATCH = 4096, 256
SEED = 43

INDEX = "dim int, cell int, v binary, ids array<long>, low array<double>"
FOUND = "query binary, vec_id long, score double"


def chi_square_limit(p: float, freedom: int) -> float:
    """The value that a chi-square variable with an even number of degrees exceeds with chance 1 - p."""
    def above(x: float) -> float:
        term = total = 1.0
        for j in range(1, freedom // 2):
            term *= x / 2 / j
            total += term
        return math.exp(-x / 2) * total
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if above(mid) > 1 - p else (low, mid)
    return high


def directions(dim: int) -> np.ndarray:
    """Gaussian directions for vectors of ``dim`` components and the added one."""
    return np.random.default_rng([SEED, dim]).standard_normal((dim + 1, DIRECTIONS))


def project(x: np.ndarray, largest: float, query: bool) -> np.ndarray:
    """Projections of vectors; queries are scaled to the largest length, which keeps their order of neighbours."""
    length2 = (x * x).sum(axis=1)
    if query:
        x, added = x * (largest / np.sqrt(length2))[:, None], np.zeros(len(x))
    else:
        added = np.sqrt(np.maximum(0.0, largest * largest - length2))
    return np.concatenate([x, added[:, None]], axis=1) @ directions(x.shape[1])


def split_tree(points: np.ndarray, leaves: int) -> list[tuple]:
    """kd-tree with medians of the widest dimension: (dimension, value, left, right), or (-1, leaf, 0, 0)."""
    nodes: list[tuple] = []
    n_leaves = 0

    def build(rows: np.ndarray, parts: int) -> int:
        nonlocal n_leaves
        at = len(nodes)
        nodes.append(())
        spread = rows.max(axis=0) - rows.min(axis=0) if len(rows) else np.zeros(1)
        if parts > 1 and len(rows) > 1 and spread.max() > 0:
            k = int(spread.argmax())
            value = float(np.median(rows[:, k]))
            left = rows[:, k] <= value
            if left.any() and not left.all():
                nodes[at] = (k, value, build(rows[left], parts // 2), build(rows[~left], parts - parts // 2))
                return at
        nodes[at] = (-1, n_leaves, 0, 0)
        n_leaves += 1
        return at

    build(points, leaves)
    return nodes


def leaf_of(nodes: list[tuple], points: np.ndarray) -> np.ndarray:
    out = np.zeros(len(points), np.int32)
    stack = [(0, np.arange(len(points)))]
    while stack:
        node, rows = stack.pop()
        k, value, left, right = nodes[node]
        if k < 0:
            out[rows] = value
        elif rows.size:
            low = points[rows, k] <= value
            stack += [(left, rows[low]), (right, rows[~low])]
    return out


def _box_distance2(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box."""
    total = np.zeros((len(points), len(low)))
    for k in range(points.shape[1]):
        gap = np.maximum(0.0, np.maximum(low[None, :, k] - points[:, k, None], points[:, k, None] - high[None, :, k]))
        total += gap * gap
    return total


class Chunk:
    """A kd-tree of small buckets over some vectors, searched for many queries at a time."""

    def __init__(self, vectors: np.ndarray, projected: np.ndarray, ids: list[list[int]]):
        order, sizes = [], []
        stack = [np.arange(len(vectors))]
        while stack:
            rows = stack.pop()
            if len(rows) <= BUCKET_ROWS:
                order.append(rows)
                sizes.append(len(rows))
                continue
            own = projected[rows]
            k = int((own.max(axis=0) - own.min(axis=0)).argmax())
            by = np.argpartition(own[:, k], len(rows) // 2)
            stack += [rows[by[len(rows) // 2:]], rows[by[:len(rows) // 2]]]
        n, size = len(sizes), max(sizes)
        # Short buckets repeat their last row; repeats are masked out.
        self.rows = np.stack([np.append(r, np.full(size - len(r), r[-1])) for r in order])
        self.real = np.arange(size)[None, :] < np.array(sizes)[:, None]
        self.vectors, self.ids = vectors, ids
        self.first = np.array([i[0] for i in ids], np.int64)
        boxed = projected[self.rows.ravel()].reshape(n, size, -1)
        self.low, self.high = boxed.min(axis=1), boxed.max(axis=1)

    def search(self, queries: np.ndarray, projected: np.ndarray, largest: float, k: int, least: np.ndarray,
               limit: float) -> list[list[tuple[int, float]]]:
        """Per query (id, inner product) of its k best here that reach ``least``, best first."""
        n = len(queries)
        scale = largest / np.sqrt((queries * queries).sum(axis=1))
        # The squared distance of an inner product, after the added coordinate and the scaling.
        far = lambda s: np.maximum(0.0, 2 * largest * largest - 2 * s * scale)
        lower = _box_distance2(projected, self.low, self.high)
        rank = np.argsort(np.argsort(lower, axis=1, kind="stable"), axis=1)
        kth = least.copy()
        best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))  # query, row, inner product
        begin, end = 0, 2
        while begin < lower.shape[1]:
            # Twice as many of each query's nearest buckets per wave, as long as its test does not hold.
            wave = (rank >= begin) & (rank < end) & (lower <= limit * far(kth)[:, None])
            if not wave.any():
                break
            hits = []
            for b in np.flatnonzero(wave.any(axis=0)):
                q, r = np.flatnonzero(wave[:, b]), self.rows[b][self.real[b]]
                i, j = np.nonzero(queries[q] @ self.vectors[r].T >= kth[q, None] - 1e-9 * largest * largest / scale[q, None])
                hits.append((q[i], r[j]))
            q, r = (np.concatenate(c) for c in zip(*hits))
            score = (self.vectors[r] * queries[q]).sum(axis=1)
            q, r, score = (np.concatenate(c) for c in zip(best, (q, r, score)))
            order = np.lexsort((self.first[r], -score, q))
            q, r, score = q[order], r[order], score[order]
            starts = np.searchsorted(q, np.arange(n))
            keep = np.arange(len(q)) - starts[q] < k
            best = q[keep], r[keep], score[keep]
            full = np.flatnonzero(np.bincount(best[0], minlength=n) == k)
            last = np.searchsorted(best[0], full, side="right") - 1
            kth[full] = np.maximum(kth[full], best[2][last])
            begin, end = end, 2 * end
        out: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for q, r, s in zip(*(c.tolist() for c in best)):
            if s >= least[q]:
                out[q] += [(v, s) for v in self.ids[r]]
        for i in range(n):
            out[i] = sorted(out[i], key=lambda f: (-f[1], f[0]))[:k]
        return out


def _doubles(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, dim, v: vectors with an id, without null or non-finite components, not zero; v holds doubles."""

    def pick(batches):
        for batch in batches:
            out = []
            for vec_id, x in zip(*(c.to_pylist() for c in batch.columns)):
                if vec_id is None or not x or None in x:
                    continue
                v = np.array(x, np.float64)
                if np.isfinite(v).all() and v.any():
                    out.append((vec_id, len(v), (v + 0.0).tobytes()))
            if out:
                ids, dims, data = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()),
                                                  pa.array(data, pa.binary())], names=["vec_id", "dim", "v"])

    picked = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return picked.mapInArrow(pick, "vec_id long, dim int, v binary")


class Index:
    """The stored index table and its small description."""

    def __init__(self, rows: DataFrame, k: int):
        """``rows`` as of ``usable``; every distinct vector keeps its k smallest ids."""
        spark = rows.sparkSession
        distinct = rows.groupBy("dim", "v", "vec_id").agg(F.count("*").alias("copies")).drop("copies")
        first = F.row_number().over(Window.partitionBy("dim", "v").orderBy("vec_id"))
        classes = stored(distinct.withColumn("place", first).filter(F.col("place") <= k).groupBy("dim", "v").agg(
            F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-classes")

        def lengths(batches):
            for batch in batches:
                dims = batch.column(0).to_pylist()
                x = [float(np.square(np.frombuffer(v)).sum()) for v in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(dims, pa.int32()), pa.array(x)], names=["dim", "length2"])

        measured = classes.select("dim", "v").mapInArrow(lengths, "dim int, length2 double")
        self.largest, self.trees = {}, {}
        for dim, length2, n in measured.groupBy("dim").agg(F.max("length2"), F.count("*")).collect():
            self.largest[dim] = math.sqrt(length2)
            drawn = classes.filter(F.col("dim") == dim).orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("v").toArrow()
            points = project(_doubles(drawn.column(0), dim), self.largest[dim], False)
            self.trees[dim] = split_tree(points, max(1, min(MAX_CELLS, n // CELL_ROWS, len(points) // 4)))
        largest, trees = self.largest, self.trees

        def place(batches):
            for batch in batches:
                dims = np.array(batch.column(0).to_pylist())
                for dim in sorted({*dims.tolist()}):
                    own = batch.take(pa.array(np.flatnonzero(dims == dim)))
                    p = project(_doubles(own.column(1), dim), largest[dim], False)
                    yield pa.RecordBatch.from_arrays(
                        [own.column(0), pa.array(leaf_of(trees[dim], p), pa.int32()), own.column(1), own.column(2),
                         pa.array(list(p), pa.list_(pa.float64()))], names=["dim", "cell", "v", "ids", "low"])

        self.table = stored(classes.mapInArrow(place, INDEX), "ann-index")
        boxes = self.table.groupBy("dim", "cell").agg(
            F.count("*").alias("n"), F.array(*(F.min(F.col("low")[i]) for i in range(DIRECTIONS))).alias("low"),
            F.array(*(F.max(F.col("low")[i]) for i in range(DIRECTIONS))).alias("high"))
        self.boxes: dict[int, list] = {}
        for r in boxes.collect():  # MAX_CELLS rows per dimension at most
            self.boxes.setdefault(r.dim, []).append((r.cell, -(-r.n // CHUNK_ROWS), r.low, r.high))


def _search(index: Index, asked: DataFrame, k: int, limit: float, width: int) -> DataFrame:
    """Search cells for the queries sent to them; ``asked``: dim, cell, chunk, query, least."""
    counts = asked.groupBy("dim", "cell").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("salts"))
    chunks = F.array(*(F.struct(F.lit(d).alias("dim"), F.lit(c).alias("cell"), F.lit(n).alias("chunks"))
                       for d, boxes in index.boxes.items() for c, n, _, _ in boxes))
    sizes = index.table.sparkSession.range(1).select(F.inline(chunks))
    known = counts.join(F.broadcast(sizes), ["dim", "cell"])
    # One row per cell, MAX_CELLS per dimension at most.
    data = index.table.join(F.broadcast(known), ["dim", "cell"]).select(
        "dim", "cell", F.pmod(F.xxhash64("v"), F.col("chunks")).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("tag"), "v", "ids",
        F.lit(None).cast("double").alias("least"))
    sent = asked.join(F.broadcast(known), ["dim", "cell"]).select(
        "dim", "cell", "chunk", F.pmod(F.xxhash64("query"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("tag"),
        F.col("query").alias("v"), F.lit(None).cast("array<long>").alias("ids"), "least")
    largest = index.largest

    def run(batches):
        group, tree, held, waiting = None, None, ([], []), []

        def answer():
            dim = group[0]
            v = np.frombuffer(b"".join(q for q, _ in waiting)).reshape(-1, dim)
            least = np.array([-np.inf if b is None else b for _, b in waiting])
            found = tree.search(v, project(v, largest[dim], True), largest[dim], k, least, limit)
            rows = [(q, i, s) for (q, _), near in zip(waiting, found) for i, s in near]
            waiting.clear()
            if rows:
                q, i, s = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.binary()), pa.array(i, pa.int64()), pa.array(s, pa.float64())],
                                                 names=["query", "vec_id", "score"])

        for batch in batches:
            for dim, cell, chunk, salt, tag, v, ids, least in zip(*(c.to_pylist() for c in batch.columns)):
                if (dim, cell, chunk, salt) != group:
                    if waiting:
                        yield from answer()
                    group, tree, held = (dim, cell, chunk, salt), None, ([], [])
                if tag == 0:
                    held[0].append(v)
                    held[1].append(ids)
                elif held[0]:
                    if tree is None:
                        x = np.frombuffer(b"".join(held[0])).reshape(-1, dim)
                        tree = Chunk(x, project(x, largest[dim], False), held[1])
                    waiting.append((v, least))
                    if len(waiting) >= QUERY_BATCH:
                        yield from answer()
        if waiting:
            yield from answer()

    ordered = data.unionByName(sent).repartition(width, "dim", "cell", "chunk", "salt").sortWithinPartitions(
        "dim", "cell", "chunk", "salt", "tag")
    return ordered.mapInArrow(run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """query, near: the k best of each query, best first."""
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("place", place).filter(F.col("place") <= k).groupBy("query").agg(
        F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near"))


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, sure: float = SURE) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of every query row, without its own id.

    ``is_query`` is a condition on vec_id. Vectors that are null, zero or hold
    null or non-finite components take no part, nor do rows without id; vectors
    meet those of equal length only. Ties go to the smaller id, repeated rows
    count once. Other columns are not read. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    width = width_of(spark)
    rows = stored(usable(vectors), "ann-vectors")
    limit = chi_square_limit(sure, DIRECTIONS)
    index = Index(rows, k + 1)
    asking = rows.filter(is_query).select("vec_id", "dim", "v").distinct()
    if not index.boxes:
        return asking.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    queries = stored(asking.select("dim", "v").distinct(), "ann-queries")
    largest, trees = index.largest, index.trees
    boxes = {d: (np.array([b[0] for b in own]), np.array([b[1] for b in own]), np.array([b[2] for b in own]),
                 np.array([b[3] for b in own])) for d, own in index.boxes.items()}
    asked = "dim int, cell int, chunk int, query binary, least double"

    def rows_of(dim, queries, lists, least):
        """A row per query, cell of its list and chunk of that cell."""
        cells, chunks, _, _ = boxes[dim]
        out = [(dim, int(cells[c]), n, q, b) for q, own, b in zip(queries, lists, least) for c in own for n in range(int(chunks[c]))]
        for low in range(0, len(out), 4096):
            d, c, n, q, b = zip(*out[low:low + 4096])
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int32()), pa.array(c, pa.int32()), pa.array(n, pa.int32()),
                                              pa.array(q, pa.binary()), pa.array(b, pa.float64())],
                                             names=["dim", "cell", "chunk", "query", "least"])

    def by_dim(batch):
        dims = np.array(batch.column(0).to_pylist())
        for dim in sorted({*dims.tolist()}):
            own = batch.take(pa.array(np.flatnonzero(dims == dim)))
            for low in range(0, own.num_rows, 512):
                part = own.slice(low, 512)
                yield dim, part, project(_doubles(part.column(1), dim), largest[dim], True)

    def home(batches):
        for batch in batches:
            for dim, part, p in by_dim(batch):
                cells, _, low, high = boxes[dim]
                # The nearest box; ties go to the cell that the tree gives, if it has rows.
                distance = _box_distance2(p, low, high) - 1e-9 * (cells[None, :] == leaf_of(trees[dim], p)[:, None])
                yield from rows_of(dim, part.column(1).to_pylist(), [[c] for c in distance.argmin(axis=1)], [None] * part.num_rows)

    def others(batches):
        for batch in batches:
            for dim, part, p in by_dim(batch):
                cells, _, low, high = boxes[dim]
                v = _doubles(part.column(1), dim)
                least = part.column(2).to_pylist()
                bound = np.array([-np.inf if b is None else b for b in least])
                scale = largest[dim] / np.sqrt((v * v).sum(axis=1))
                far = np.maximum(0.0, 2 * largest[dim] ** 2 - 2 * bound * scale)
                open_ = _box_distance2(p, low, high) <= limit * far[:, None]
                seen = (_box_distance2(p, low, high) - 1e-9 * (cells[None, :] == leaf_of(trees[dim], p)[:, None])).argmin(axis=1)
                open_[np.arange(len(p)), seen] = False
                yield from rows_of(dim, part.column(1).to_pylist(), [np.flatnonzero(o) for o in open_], least)

    near = stored(_search(index, queries.mapInArrow(home, asked), k + 1, limit, width), "ann-home")
    bounds = _best(near, k + 1).select("query", F.when(F.size("near") > k, F.col("near")[k]["score"]).alias("least"))
    second = stored(queries.join(bounds, queries["v"] == bounds["query"], "left").select("dim", "v", "least")
                    .mapInArrow(others, asked), "ann-cells")
    more = _search(index, second, k + 1, limit, width)
    best = _best(near.unionByName(more), k + 1)
    own = F.filter("near", lambda n: n["vec_id"] != F.col("query_id"))
    return (
        asking.select(F.col("vec_id").alias("query_id"), "v").join(best, F.col("v") == F.col("query"))
        .select("query_id", F.posexplode(F.slice(own, 1, k)).alias("at", "n"))
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("n.vec_id").alias("vec_id"), F.col("n.score").alias("score"))
    )
