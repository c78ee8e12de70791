"""Mixing sources to target weights by pivotal dependent rounding.

A source whose target is r times its size takes floor(r) copies of each document
and one more with probability r - floor(r). These fractions are rounded in
pairs: words move at random from one document of a pair to the other until one
fraction is 0 or 1, which keeps the expected copies of each document and the
words of the pair. Documents are rounded inside buckets; at most one residual
per bucket is left, and residuals are combined level by level in a tree until one
per source remains, which is rounded by itself. So a source misses its target
by less than one document.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from gridsteps.llm.common import free_name, raw_texts, running_sums, slices, stored, width_of

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BUCKET_ROWS = 8192
FAN_IN = 32
SALTS = 256
SEED = 17

OPEN = "row long, source_rank long, bucket long, doc_id long, size long, p double, extra int"


def _uniform(*keys: int) -> float:
    """A number in [0, 1) that depends on the keys only."""
    h = 0x9E3779B97F4A7C15
    for k in keys:
        h = (h ^ (k & 0xFFFFFFFFFFFFFFFF)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
        h = (h ^ (h >> 27)) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
        h ^= h >> 31
    return (h >> 11) / (1 << 53)


def pivot(p: float, size_p: int, q: float, size_q: int, u: float) -> tuple[float, float]:
    """Move words between two fractions, at random, until one of them is 0 or 1."""
    up = min(size_p * (1 - p), size_q * q)  # p gains
    down = min(size_p * p, size_q * (1 - q))  # p loses
    if u * (up + down) < down:
        new_p = 1.0 if up == size_p * (1 - p) else p + up / size_p
        new_q = 0.0 if up == size_q * q else q - up / size_q
    else:
        new_p = 0.0 if down == size_p * p else p - down / size_p
        new_q = 1.0 if down == size_q * (1 - q) else q + down / size_q
    snap = lambda x: 0.0 if x < 1e-12 else 1.0 if x > 1 - 1e-12 else x
    return snap(new_p), snap(new_q)


def tagged(docs: DataFrame, whole: bool) -> tuple[DataFrame, str, str]:
    """The rows, written once, with a number of their own and their words; names of the two columns."""
    row, size = free_name(docs, "row_number"), free_name(docs, "n_words")
    kept = docs if whole else docs.select("doc_id", "source", "text")
    schema = kept.schema if whole else kept.drop("text").schema
    at = kept.columns.index("text")

    def tag(batches):
        number = TaskContext.get().partitionId() << 33
        for every in batches:
            for batch in slices(every):
                words = [len((t or b"").split()) for t in raw_texts(batch)]
                columns = [c for i, c in enumerate(batch.columns) if whole or i != at]
                names = [c for i, c in enumerate(batch.schema.names) if whole or i != at]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(range(number, number + len(words)), pa.int64()), pa.array(words, pa.int64())],
                    names=[*names, row, size])
                number += len(words)

    added = type(schema)([*schema.fields]).add(row, "long").add(size, "long")
    return stored(kept.mapInArrow(tag, added), "mixing-rows"), row, size


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_rank, source_size, target, base, frac.

    Sources in code point order, null last, take the weights in turn. All
    targets share the words of all sources; a target stops at ``most`` times its
    source, and what is over goes to the others by weight. Only sums over the
    source table reach the driver, once per round.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked, (n, total) = running_sums(sizes, [F.col("source").asc_nulls_last()], ["source_size"])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("before")[0] % len(weights) + 1).cast("int"))
    table = stored(ranked.select("source", F.col("before")[0].alias("source_rank"), "source_size",
                                 weight.cast("long").alias("weight")), "mixing-sources")
    words, shares = total, table.agg(F.sum("weight")).first()[0] or 0
    while True:
        # The share of a weight is words / shares; whole numbers keep the comparison exact.
        over = F.expr(f"cast(weight AS decimal(20,0)) * {words} > cast({most} * source_size AS decimal(20,0)) * {max(shares, 1)}")
        row = table.agg(F.sum(F.when(over, most * F.col("source_size")).otherwise(0)),
                        F.sum(F.when(over, 0).otherwise(F.col("weight")))).first()
        left, rest = total - (row[0] or 0), row[1] or 0
        if (left, rest) == (words, shares) or not rest:
            break
        words, shares = left, rest
    share = words / shares if shares else 0.0
    cap = most * F.col("source_size")
    target = F.when(over, cap.cast("double")).otherwise(F.col("weight") * F.lit(share))
    rate = F.when(over, F.lit(float(most))).when(F.col("source_size") > 0, F.least(
        F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    return table.withColumn("target", target).withColumn("rate", rate).select(
        "source", "source_rank", "source_size", "target", F.floor("rate").cast("int").alias("base"),
        (F.col("rate") - F.floor("rate")).alias("frac"))


def _round(rows: DataFrame, width: int) -> DataFrame:
    """Round the open rows (p not null) of each source and bucket; one at most stays open."""

    def step(batches):
        group, held = None, None
        for batch in batches:
            out = []
            for row, source, bucket, doc_id, size, p, extra in zip(*(c.to_pylist() for c in batch.columns)):
                if (source, bucket) != group:
                    if held:
                        out.append((*held, None))
                    group, held = (source, bucket), None
                if p is None or size == 0 or p <= 0.0 or p >= 1.0:
                    out.append((row, source, bucket, doc_id, size, None,
                                extra if p is None else int(size > 0 and p >= 1.0)))
                    continue
                now = (row, source, bucket, doc_id, size, p)
                if held is None:
                    held = now
                    continue
                u = _uniform(SEED, held[3] or 0, doc_id or 0, held[4], size)
                a, b = pivot(held[5], held[4], p, size, u)
                stay = None
                for x, value in ((held, a), (now, b)):
                    if value in (0.0, 1.0):
                        out.append((*x[:5], None, int(value)))
                    else:
                        stay = (*x[:5], value)
                held = stay
            if out:
                yield _open_batch(out)
        if held:
            yield _open_batch([(*held, None)])

    ordered = rows.select(*[c.split()[0] for c in OPEN.split(", ")]).repartition(
        width, "source_rank", "bucket").sortWithinPartitions(
        "source_rank", "bucket", F.col("size").desc(), F.xxhash64("doc_id", F.lit(SEED)), "doc_id", "row")
    return ordered.mapInArrow(step, OPEN)


def _open_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 5 + [pa.float64(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      names=[c.split()[0] for c in OPEN.split(", ")])


def copies_of(rows: DataFrame, bucket_rows: int = BUCKET_ROWS, fan_in: int = FAN_IN,
              weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """row, doc_id, size, source_size, target, copies for rows (row, doc_id, source, size).

    Equal rows (same source, id and size) are one entry of the rounding: of m of them, m times the
    fraction take one copy more, and only what is left of that number is rounded. Which of them take it is
    settled per ``SALTS`` parts of an entry, so an id, or no id, that most rows share is dealt like any other.
    """
    width = width_of(rows.sparkSession)
    targets = stored(source_targets(rows, weights, most), "mixing-targets")
    joined = rows.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        "row", "source_rank", "doc_id", "size", "frac", F.pmod(F.xxhash64("row", F.lit(SEED + 3)), F.lit(SALTS)).alias("salt"))
    equal = ["source_rank", "doc_id", "size"]
    parts = stored(joined.groupBy(*equal, "salt").agg(
        F.count("*").alias("n"), F.min("row").alias("row"), F.first("frac").alias("frac")), "mixing-parts")
    # At most SALTS rows per entry.
    inside = Window.partitionBy(*equal)
    before = F.sum("n").over(inside.orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumns({"m": F.sum("n").over(inside), "before": F.coalesce(before, F.lit(0)), "entry": F.min("row").over(inside)})
    parts = stored(parts.withColumn("share", F.col("m") * F.col("frac")), "mixing-entries")
    entries = parts.filter("entry = row")
    buckets = max(1, -(-entries.count() // bucket_rows))
    p = F.col("share") - F.floor("share")
    opened = entries.select("row", "source_rank", F.pmod(F.xxhash64("doc_id", "size", F.lit(SEED + 1)), F.lit(buckets)).alias("bucket"),
                            "doc_id", "size", F.when(p > 0, p).alias("p"), F.lit(0).alias("extra"))
    rounded = stored(_round(opened, width), "mixing-rounded")
    settled, residual = [], rounded.filter("p IS NOT NULL")
    while buckets > 1:
        buckets = -(-buckets // fan_in)
        level = stored(_round(residual.withColumn("bucket", F.col("bucket") % buckets), width), "mixing-level")
        settled.append(level.filter("p IS NULL").select("row", F.col("extra").alias("late")))
        residual = level.filter("p IS NOT NULL")
    # One residual per source.
    last = F.xxhash64("doc_id", "size", F.lit(SEED + 2)).bitwiseAND((1 << 53) - 1) / float(1 << 53) < F.col("p")
    settled.append(residual.select("row", last.cast("int").alias("late")))
    late = settled[0]
    for more in settled[1:]:
        late = late.unionByName(more)
    late = stored(late, "mixing-settled")
    drawn = rounded.join(late.withColumnRenamed("row", "late_row"), F.col("row") == F.col("late_row"), "left").select(
        F.col("row").alias("entry"), F.coalesce("late", "extra", F.lit(0)).alias("drawn"))
    # Of each part, the rows whose place in the entry lies below the number that take one copy more.
    quota = parts.join(drawn, "entry").select(
        *(F.col(c).alias(f"of_{c}") for c in (*equal, "salt")),
        F.greatest(F.floor("share") + F.col("drawn") - F.col("before"), F.lit(0)).alias("quota"))
    place = F.row_number().over(Window.partitionBy(*equal, "salt").orderBy("row"))
    same = F.lit(True)
    for c in (*equal, "salt"):
        same &= F.col(c).eqNullSafe(F.col(f"of_{c}"))
    return (
        joined.withColumn("place", place).join(quota, same).join(targets.drop("source", "frac"), "source_rank")
        .select("row", "doc_id", "size", "source_size", "target",
                (F.col("base") + (F.col("place") <= F.col("quota")).cast("int")).alias("copies"))
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row.

    A null text has no words and takes none; rows without doc_id and repeated
    rows are rounded like any other; a null source is a source of its own, last
    in order. The result depends on the rows only, not on their partitions,
    except which of several equal rows is taken. Other columns are not read.
    """
    rows, row, size = tagged(docs, False)
    narrow = rows.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("source").cast("string").alias("source"), F.col(size).alias("size"))
    return copies_of(narrow, **options).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row as often as it is taken, with its own columns."""
    rows, row, size = tagged(docs, True)
    narrow = rows.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("source").cast("string").alias("source"), F.col(size).alias("size"))
    taken = copies_of(narrow, **options).filter("copies > 0").select(
        F.col("row").alias(free_name(rows, "taken_row")), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias(free_name(rows, "copy")))
    return rows.join(taken, rows[row] == taken[taken.columns[0]]).select(*(rows[c] for c in docs.columns))
