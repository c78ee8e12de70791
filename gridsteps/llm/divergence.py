"""How far the sources of a language differ in their use of terms.

Occurrences are counted per task before anything is shuffled. The terms of a
group (one source of one language) fall into cells of equal counts in the group
and in the language; a term's value depends on its cell only, so cells are
evaluated and ranked by how many terms stand before them, cells of equal value are
merged, and only those that reach the wanted ranks are expanded into terms.
Distances between sources are summed per block of terms, sources side by side.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gridsteps.llm.common import raw_texts, stored, width_of

LEAST_DOCUMENTS, SMOOTHING, UNIT, TOP = 30, 5, 1_000_000_000, 50
HELD_TERMS = 400_000
BLOCK_TERMS, BLOCK_CELLS = 4096, 1 << 20

# Bytes of a term stay, A to Z as a to z; all others separate. Bytes from 128 on belong to characters of a term.
_TERM = bytes.maketrans(bytes(range(128)), bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32 for c in range(128)))

COUNTED = "lang string, source string, term string, n long, documents long"


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, documents: occurrences and documents per term, added up within parts of tasks.

    A term may have several rows, to be summed. A row without term stands for the
    group itself.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def rows(lang: str, source: str, terms: list, n: list[int], documents: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                 pa.array(terms, pa.string()), pa.array(n, pa.int64()), pa.array(documents, pa.int64())],
                names=["lang", "source", "term", "n", "documents"])

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, documents) in held.items():
                yield rows(lang, source, [None], [0], [0])
                keys = list(n)
                for low in range(0, len(keys), 8192):
                    own = keys[low:low + 8192]
                    yield rows(lang, source, [k.decode() for k in own], [n[k] for k in own], [documents[k] for k in own])
            held.clear()

        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, source, text in zip(langs, sources, raw_texts(batch)):
                n, documents = held.setdefault((lang, source), (Counter(), Counter()))
                own = Counter(text.translate(_TERM).split())
                size -= len(n)
                n.update(own)
                documents.update(own.keys())
                size += len(n)
                if size > HELD_TERMS:
                    yield from flush()
                    size = 0
        yield from flush()

    empty = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    return docs.select(*empty).mapInArrow(run, COUNTED)


def share(n: Column, total: Column, terms: Column, smoothing: int, unit: int) -> Column:
    """The smoothed share of a term in whole units, rounded down, plus one; exact for any counts."""
    top = (n + smoothing).cast("decimal(20,0)") * F.lit(unit).cast("decimal(10,0)")
    return F.call_function("div", top, (total + smoothing * terms).cast("decimal(20,0)")) + 1


class Audit:
    """Groups and kept terms of a corpus, stored once; parts are computed from them."""

    def __init__(self, docs: DataFrame, least: int = LEAST_DOCUMENTS, smoothing: int = SMOOTHING, unit: int = UNIT):
        by_term = Window.partitionBy("lang", "term")
        counts = (
            # A term's rows meet once; sums per source and per language then need no further exchange.
            term_counts(docs).repartition(width_of(docs.sparkSession), "lang", "term")
            .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
            .withColumn("lang_n", F.sum("n").over(by_term)).withColumn("in_documents", F.sum("documents").over(by_term))
            .withColumn("first", F.row_number().over(by_term.orderBy("source")) == 1)
            .filter(F.col("term").isNull() | (F.col("in_documents") >= least))
        )
        counts = stored(counts.select("lang", "source", "term", "n", "lang_n", "first"), "audit-counts")
        kept = counts.filter(F.col("term").isNotNull())
        totals = kept.groupBy("lang").agg(F.count_if("first").alias("terms"), F.sum("n").alias("lang_total"))
        # One row per source and language.
        self.groups = stored(
            counts.groupBy("lang", "source").agg(F.sum("n").alias("total")).join(totals, "lang", "left")
            .fillna(0, ["terms", "lang_total"])
            .withColumn("base", F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms"), smoothing, unit))),
            "audit-groups")
        shares = [share(F.col(n), F.col(t), F.col("terms"), smoothing, unit).alias(out)
                  for n, t, out in (("n", "total", "p"), ("lang_n", "lang_total", "q"))]
        # Cells, not terms, are evaluated: p and q depend on the two counts only.
        self.cells = stored(
            kept.groupBy("lang", "source", "n", "lang_n").agg(F.count(F.lit(1)).alias("size"))
            .join(self.groups, ["lang", "source"]).select("lang", "source", "n", "lang_n", "size", *shares), "audit-cells")
        self.kept = kept
        self.setting = smoothing, unit

    def terms(self, top: int = TOP) -> DataFrame:
        """lang, source, part, item, value, rank: terms that a group uses more than its language, by excess."""
        cells = self.cells.filter("p > q").withColumn("value", F.col("p") - F.col("q"))
        by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
        # Each value holds a term at least, so the first ``top`` values hold all wanted ranks.
        values = (
            cells.groupBy("lang", "source", "value").agg(F.sum("size").alias("size"))
            .withColumn("place", F.row_number().over(by_value)).filter(F.col("place") <= top)
            .withColumn("before", F.sum("size").over(by_value) - F.col("size")).filter(F.col("before") < top)
            .select("lang", "source", "value", "before")
        )
        reached = cells.join(values, ["lang", "source", "value"]).select("lang", "source", "n", "lang_n", "value", "before")
        own = Window.partitionBy("lang", "source", "value", "before").orderBy("term")
        return (
            self.kept.join(reached, ["lang", "source", "n", "lang_n"])
            .withColumn("place", F.row_number().over(own)).filter(F.col("place") <= top)
            .withColumn("rank", (F.col("before") + F.col("place")).cast("int")).filter(F.col("rank") <= top)
            .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
        )

    def pairs(self) -> DataFrame:
        """lang, source, part, item, value, rank: the other sources of a group's language, by summed difference."""
        width = width_of(self.kept.sparkSession)
        blocks = F.greatest(F.ceil(F.col("terms") / BLOCK_TERMS), F.lit(1)).cast("int")
        # Every block of terms begins with the language's sources and the share of a term that they lack.
        heads = self.groups.select(
            "lang", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(None).cast("string").alias("term"),
            "source", F.coalesce("base", F.lit(0)).alias("p"))
        p = share(F.col("n"), F.col("total"), F.col("terms"), *self.setting)
        rows = self.kept.join(self.groups, ["lang", "source"]).select(
            "lang", F.pmod(F.xxhash64("term"), blocks).cast("int").alias("block"), "term", "source", p.alias("p"))
        dealt = heads.unionByName(rows).repartition(width, "lang", "block").sortWithinPartitions(
            "lang", "block", F.col("term").asc_nulls_first(), "source")
        summed = dealt.mapInArrow(_differences, "lang string, source string, item string, value long")
        ranks = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
        return (
            summed.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
            .withColumn("rank", F.row_number().over(ranks))
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
        )


class _Sums:
    """Summed differences between the sources of one language, over terms given one after the other."""

    def __init__(self, block: int):
        self.block, self.sources, self.base, self.rows, self.used, self.last = block, {}, [], None, 0, None

    def add_source(self, source: str, base: int) -> None:
        self.sources[source] = len(self.base)
        self.base.append(base)

    def add(self, term: tuple, source: str, p: int) -> None:
        if self.rows is None:
            k = len(self.base)
            self.rows = np.empty((max(1, BLOCK_CELLS // k), k), np.int64)
            self.total = np.zeros((k, k), np.int64)
        if term != self.last:
            if self.used == len(self.rows):
                self.sum_up()
            self.rows[self.used] = self.base
            self.used, self.last = self.used + 1, term
        self.rows[self.used - 1, self.sources[source]] = p

    def sum_up(self) -> None:
        rows = self.rows[:self.used]
        for i in range(rows.shape[1]):
            self.total[i] += np.abs(rows - rows[:, i:i + 1]).sum(axis=0)
        self.used = 0

    def result(self, lang: str) -> Iterator[pa.RecordBatch]:
        names = list(self.sources)
        if self.rows is not None:
            self.sum_up()
        total = np.zeros((len(names), len(names)), np.int64) if self.rows is None else self.total
        for i, name in enumerate(names):
            others = [j for j in range(len(names)) if j != i]
            if others:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(others), pa.string()), pa.array([name] * len(others), pa.string()),
                     pa.array([names[j] for j in others], pa.string()), pa.array(total[i, others])],
                    names=["lang", "source", "item", "value"])


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's part of the differences; rows come by language and block, in each the sources before the terms."""
    lang, sums = None, None
    for batch in batches:
        for own, block, term, source, p in zip(*(c.to_pylist() for c in batch.columns)):
            if own != lang:
                if sums:
                    yield from sums.result(lang)
                lang, sums = own, _Sums(block)
            if term is not None:
                sums.add((block, term), source, p)
            elif block == sums.block:  # later blocks of a language repeat its sources
                sums.add_source(source, p)
    if sums:
        yield from sums.result(lang)


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, smoothing: int = SMOOTHING, unit: int = UNIT,
          top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: both parts of the audit.

    Null text, lang and source count as ''. Repeated rows count as often as they
    occur, whatever their id. A language without kept terms has pairs of value 0
    and no terms; a language of one source has no pairs. Other columns are not
    read. An empty table gives no rows.
    """
    found = Audit(docs, least, smoothing, unit)
    return found.pairs().unionByName(found.terms(top))
