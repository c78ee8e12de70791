"""Near duplicates: MinHash bands, odd-sketch screening, confirmation on full sets.

1. Each text gives its shingle set, MinHash samples, band keys and an odd sketch:
   the samples folded into a parity bitmap. Equal sets form a class; only the
   class's smallest doc_id goes on.
2. Band keys held by several classes are buckets. In each, the smallest id leads
   and is paired with the others. The XOR population count of two sketches
   estimates their similarity; pairs far below the threshold are dropped there,
   the others are confirmed on full shingle sets of the whole texts.
3. Links give components. In buckets that still hold several components, a few
   other leaders are paired with the members of other components.
4. What is still mixed after that is compared pair by pair across components,
   sketches in memory-bounded blocks, and what passes is confirmed. Buckets
   inside one component have nothing left to find, which is what keeps large
   groups of copies cheap.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gridsteps.llm.common import free_name, numbered, raw_texts, release_cached, slices, stored, width_of
from gridsteps.llm.components import components
from gridsteps.llm.shingles import common, mix, shingle_sets

# Bands times rows samples; a pair at 0.75 misses every band with probability 5e-6, one at 0.3 meets in some band in
# 10 % of cases, at 0.2 in 1.4 %.
BANDS, ROWS, SAMPLES = 45, 5, 1024
SKETCH_BITS = 4096
# XOR bits of a pair at 0.75: 453 on average, standard deviation below 24.5; the bound is four of them above.
MAX_XOR = 551
LEADERS = 4
THRESHOLD = 75
BLOCK = 1024
LEADER_ROWS = 1000
# What a task hashes at a time.
SLICE_BYTES, SLICE_ROWS = 1_000_000, 256

SIGNATURE = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>"

_rng = np.random.default_rng(7919)
_FACTOR = _rng.integers(0, 1 << 31, SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_FLIP = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_KEY = _rng.integers(0, 1 << 63, ROWS + BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minhashes(members: np.ndarray) -> np.ndarray:
    """The smallest permuted value of a set under each of the sample permutations."""
    short = (members >> np.uint64(32)).astype(np.uint32)
    least = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for k in range(0, short.size, 512):
        permuted = (short[None, k:k + 512] ^ _FLIP[:, None]) * _FACTOR[:, None]
        np.minimum(least, permuted.min(axis=1), out=least)
    return least


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One key per band and row of samples; the band is part of its key."""
    rows = samples[:, :BANDS * ROWS].astype(np.uint64).reshape(-1, BANDS, ROWS)
    return mix((rows * _KEY[:ROWS]).sum(axis=2, dtype=np.uint64) + _KEY[ROWS:])


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """64-bit words per row of samples: parities of the samples hashed to as many places as there are bits."""
    n = samples.shape[0]
    tagged = samples.astype(np.uint64) | (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32))
    place = (mix(tagged) >> np.uint64(64 - SKETCH_BITS.bit_length() + 1)).astype(np.int64)
    counts = np.bincount((place + SKETCH_BITS * np.arange(n)[:, None]).ravel(), minlength=n * SKETCH_BITS)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view("<u8").reshape(n, -1)


def signatures(docs: DataFrame) -> DataFrame:
    """Per document: size and hash of its shingle set, band keys, odd sketch."""

    def sign(batches):
        release_cached()
        for whole in batches:
            for batch in slices(whole, size=SLICE_BYTES, rows=SLICE_ROWS):
                sets = shingle_sets([t or b"" for t in raw_texts(batch)])
                samples = np.stack([minhashes(s) for s in sets])
                bands = band_keys(samples).view(np.int64)
                filled = [b if s.size else None for s, b in zip(sets, bands)]
                sketch = odd_sketches(samples).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([s.size for s in sets], pa.int64()),
                     pa.array(np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)),
                     pa.array(np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)),
                     pa.array(filled, pa.list_(pa.int64())), pa.array(list(sketch), pa.list_(pa.int64()))],
                    names=[c.split()[0] for c in SIGNATURE.split(", ")])

    return docs.mapInArrow(sign, SIGNATURE)


def _screen(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and sketches allow the threshold."""
    side = reps.select("doc_id", "n_shingles", "sketch")
    left = side.select(*(F.col(c).alias(f"a_{c}") for c in side.columns))
    joined = pairs.join(side, pairs.b == side.doc_id).join(left, F.col("a") == F.col("a_doc_id"))
    differ = F.zip_with("sketch", "a_sketch", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int"))
    bits = F.aggregate(differ, F.lit(0), lambda total, n: total + n)
    sizes = (100 * F.least("n_shingles", "a_n_shingles") >= THRESHOLD * F.greatest("n_shingles", "a_n_shingles"))
    return joined.filter(sizes & (bits <= MAX_XOR)).select("a", "b")


def confirm(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold.

    Each pair moves the text of b to the text of a; a leader with many pairs is
    copied to several tasks, each with at most about ``LEADER_ROWS`` partners.
    """
    copies = pairs.groupBy("a").agg(F.ceil(F.count("*") / LEADER_ROWS).cast("int").alias("copies"))
    leaders = copies.select("a", F.col("a").alias("doc_id"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"))
    others = pairs.join(copies, "a").select(
        "a", F.col("b").alias("doc_id"), F.pmod(F.xxhash64("b"), F.col("copies")).cast("int").alias("salt"))
    wanted = leaders.unionByName(others).withColumnRenamed("doc_id", "wanted")
    moved = texts.join(wanted, texts.doc_id == wanted.wanted).select(
        "a", "salt", (F.col("a") != F.col("doc_id")).alias("other"), "doc_id", "text")

    def check(batches):
        release_cached()
        leader, own = None, None
        for whole in batches:
            for batch in slices(whole, size=SLICE_BYTES, rows=SLICE_ROWS):
                found = []
                sets = shingle_sets([t or b"" for t in raw_texts(batch)])
                keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for key, other, doc_id, s in zip(keys, batch.column(2).to_pylist(), batch.column(3).to_pylist(), sets):
                    if not other:
                        leader, own = key, s
                    elif key == leader:
                        both = common(own, s)
                        if 100 * both >= THRESHOLD * (own.size + s.size - both):
                            found.append((key[0], doc_id))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    ordered = moved.repartition(width, "a", "salt").sortWithinPartitions("a", "salt", "other")
    return ordered.mapInArrow(check, "a long, b long")


def _across(rows: DataFrame, width: int) -> DataFrame:
    """Pairs of different components in one bucket that pass the sketch and size tests.

    ``rows``: key, band, blocks, doc_id, component, n_shingles, bands, sketch. A
    bucket is cut into blocks; each pair of blocks is compared in memory, and a
    pair leaves the task only if it passes, in the first band that it shares.
    """
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    i = F.least(F.col("block"), F.col("with"))
    j = F.greatest(F.col("block"), F.col("with"))
    dealt = rows.withColumn("block", block).withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", i.alias("i"), j.alias("j"), (F.col("block") == i).alias("left"), "band",
        "doc_id", "component", "n_shingles", "bands", "sketch")

    def pairs_of(rows: list[tuple]) -> list[tuple[int, int]]:
        a = [r for r in rows if r[3]]
        b = a if rows[0][1] == rows[0][2] else [r for r in rows if not r[3]]
        if not a or not b:
            return []
        band, out = rows[0][4], []

        def arrays(side):
            return (*(np.array([r[k] for r in side], np.int64) for k in (5, 6, 7)),
                    np.array([r[8] for r in side], np.int64), np.array([r[9] for r in side], np.int64).view(np.uint64))

        b_id, b_comp, b_n, b_bands, b_sketch = arrays(b)
        for low in range(0, len(a), 256):
            a_id, a_comp, a_n, a_bands, a_sketch = arrays(a[low:low + 256])
            ok = (a_comp[:, None] != b_comp) & (
                100 * np.minimum(a_n[:, None], b_n) >= THRESHOLD * np.maximum(a_n[:, None], b_n))
            if a is b:
                ok &= a_id[:, None] < b_id
            x, y = np.nonzero(ok)
            for at in range(0, len(x), 1 << 14):
                p, q = x[at:at + (1 << 14)], y[at:at + (1 << 14)]
                near = np.bitwise_count(a_sketch[p] ^ b_sketch[q]).sum(axis=1, dtype=np.int64) <= MAX_XOR
                near &= ~(a_bands[p, :band] == b_bands[q, :band]).any(axis=1)
                u, v = a_id[p[near]], b_id[q[near]]
                out += zip(np.minimum(u, v).tolist(), np.maximum(u, v).tolist())
        return out

    def compare(batches):
        key, held = None, []
        for batch in batches:
            found = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != key:
                    if held:
                        found += pairs_of(held)
                    key, held = row[:3], []
                held.append(row)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])
        if held and (found := pairs_of(held)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    ordered = dealt.repartition(width, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    return ordered.mapInArrow(compare, "a long, b long")


def _mixed(buckets: DataFrame, where: DataFrame) -> DataFrame:
    """Rows of the buckets in which several components meet, with their component."""
    placed = buckets.join(where, "doc_id")
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter(
        "low != high").select("key")
    return placed.join(mixed, "key")


def _merged(where: DataFrame, links: DataFrame) -> DataFrame:
    """Components after links (a, b) between documents have been added."""
    ends = [where.select(F.col("doc_id").alias(f"{e}_id"), F.col("component").alias(f"{e}_in")) for e in "ab"]
    lifted = links.join(ends[0], F.col("a") == F.col("a_id")).join(ends[1], F.col("b") == F.col("b_id"))
    found = components(lifted.select("a_in", "b_in")).withColumnRenamed("component", "joined")
    return stored(where.join(found, F.col("component") == F.col("vertex"), "left").select(
        "doc_id", F.coalesce("joined", "component").alias("component")), "near-components")


def _repeated(named: DataFrame) -> bool:
    """Whether any doc_id occurs more than once."""
    counts = named.groupBy("doc_id").agg(F.count("*").alias("copies"))
    return counts.agg(F.max("copies")).first()[0] not in (None, 1)


def linked(rows: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for rows (doc_id, text) of different ids; the component's smallest id."""
    spark = rows.sparkSession
    width = width_of(spark)
    named = rows
    signed = stored(signatures(named), "near-signatures")

    filled = signed.filter("n_shingles > 0")
    identity = ["n_shingles", "set_a", "set_b"]
    classes = filled.groupBy(*identity).agg(F.min("doc_id").alias("rep"))
    members = stored(filled.select("doc_id", *identity).join(classes, identity).select("doc_id", "rep"), "near-members")
    reps = stored(signed.join(members.filter("doc_id = rep").select("doc_id"), "doc_id"), "near-classes")

    banded = reps.select("doc_id", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("key").agg(F.min("doc_id").alias("leader"), F.count("*").alias("size")).filter("size > 1")
    buckets = stored(banded.join(shared, "key"), "near-buckets")
    holders = stored(buckets.select("doc_id", F.col("doc_id").alias("component")).distinct(), "near-holders")
    texts = stored(named.join(holders.select(F.col("doc_id").alias("holder")), F.col("doc_id") == F.col("holder"),
                              "left_semi"), "near-candidates", "zstd")

    # Every member with the leader of its bucket.
    first = stored(_screen(buckets.filter("doc_id != leader").select(
        F.col("leader").alias("a"), F.col("doc_id").alias("b")).distinct(), reps), "near-pairs")
    where = _merged(holders, stored(confirm(first, texts, width), "near-links"))

    # Where components still meet, with a few more leaders.
    rows = stored(_mixed(buckets.select("key", "doc_id"), where), "near-mixed")
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("doc_id", F.lit(LEADERS)), "doc_id"))
    leaders = rows.withColumn("place", place).filter(F.col("place") <= LEADERS).select(
        F.col("key").alias("led"), F.col("doc_id").alias("head"), F.col("component").alias("head_in"))
    led = rows.join(leaders, (F.col("key") == F.col("led")) & (F.col("component") != F.col("head_in"))).select(
        F.least("doc_id", "head").alias("a"), F.greatest("doc_id", "head").alias("b")).distinct()
    second = stored(_screen(led.join(first, ["a", "b"], "left_anti"), reps), "near-pairs")
    where = _merged(where, stored(confirm(second, texts, width), "near-links"))

    # The rest, exactly.
    rows = _mixed(buckets.select("key", "band", "doc_id", "size"), where).join(
        reps.select("doc_id", "n_shingles", "bands", "sketch"), "doc_id").withColumn(
        "blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    third = stored(_across(rows, width).join(first.unionByName(second), ["a", "b"], "left_anti"), "near-pairs")
    where = _merged(where, stored(confirm(third, texts, width), "near-links"))

    final = members.join(where.select(F.col("doc_id").alias("vertex"), "component"), F.col("rep") == F.col("vertex"), "left")
    final = final.select("doc_id", F.coalesce("component", "rep").alias("component_id"))
    result = signed.select("doc_id", "n_shingles").join(
        final.withColumnRenamed("doc_id", "member"), F.col("doc_id") == F.col("member"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return result


def _distinct(numbered_rows: DataFrame, number: str) -> DataFrame:
    """key, doc_id, text, copies: every distinct (doc_id, text) once; its key is the smallest number of its rows."""
    return stored(numbered_rows.groupBy("doc_id", "text").agg(F.min(number).alias("key"), F.count("*").alias("copies")).select(
        "key", "doc_id", "text", "copies"), "near-rows")


def _of_texts(rows: DataFrame) -> DataFrame:
    """key, id, copies, n_shingles, component for rows of ``_distinct``; components by links between texts only."""
    found = linked(rows.select(F.col("key").alias("doc_id"), "text")).withColumnRenamed("doc_id", "of_key")
    ids = rows.select("key", F.col("doc_id").alias("id"), "copies")
    return stored(ids.join(found, F.col("key") == F.col("of_key")).select(
        "key", "id", "copies", "n_shingles", F.col("component_id").alias("component")), "near-found")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row.

    A null or wordless text has an empty set and is linked with nothing. Rows
    without doc_id are linked with nothing and kept, with a null component. Rows
    that share a doc_id are documents of their own, each with its own text; what one
    of them reaches, its doc_id reaches, and all of them report the smallest doc_id
    that theirs does. Other columns are not read.
    """
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = every.filter("doc_id IS NOT NULL")
    if _repeated(named):
        found = _of_texts(_distinct(numbered(named, "row"), "row"))
        # Components that hold rows of one id are one for what is reported.
        firsts = found.groupBy("id").agg(F.min("component").alias("first"))
        joined = components(found.select("id", "component").distinct().join(firsts, "id").filter("component != first").select(
            "first", "component")).withColumnRenamed("component", "joined")
        placed = found.join(joined, F.col("component") == F.col("vertex"), "left").withColumn(
            "whole", F.coalesce("joined", "component"))
        least = placed.groupBy("whole").agg(F.min("id").alias("component_id"))
        result = placed.join(least, "whole").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
            F.col("id").alias("doc_id"), "n_shingles", "component_id")
    else:
        result = linked(named)
    result = result.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    nameless = signatures(every.filter("doc_id IS NULL")).select(
        "doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))
    return result.unionByName(nameless)


def keep_one(docs: DataFrame) -> DataFrame:
    """One row, with all columns, of each group of near duplicates.

    The row of the smallest doc_id stays; of several rows with that id one does. A row
    goes only if its own text has a near duplicate, or a copy, that stays: rows that share
    a doc_id but not their text stay apart. Rows without doc_id, and one row of each id
    and null or empty text, stay. Clashing column names do no harm.
    """
    if not _repeated(docs.filter("doc_id IS NOT NULL")):
        name = free_name(docs, "dropped_id")
        dropped = near_duplicates(docs).filter("NOT kept").select(F.col("doc_id").alias(name)).distinct()
        return docs.join(dropped, docs["doc_id"] == dropped[name], "left_anti")
    row, stays = free_name(docs, "row"), free_name(docs, "stays")
    rows = numbered(docs, row)
    named = rows.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(row).alias("row"))
    found = _of_texts(_distinct(named, "row"))
    kept = found.groupBy("component").agg(F.min_by("key", F.struct("id", "key")).alias(stays)).select(stays)
    return rows.filter("doc_id IS NULL").drop(row).unionByName(
        rows.join(kept, rows[row] == kept[stays], "left_semi").drop(row))
