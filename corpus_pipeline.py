"""Corpus pipeline: quality rules, near duplicates, secrets, mix, packed sequences.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage
before kept. All but the last return the columns of ``documents``. Further columns,
whatever their names, are carried along; an empty table stays empty. What stages do
with nulls, empty texts and repeated rows is said at each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridsteps.llm import mixing, near_dup, packing, quality_rules, secret_scan
from gridsteps.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the newest policy keeps, by its stored ledger.

    Null and empty texts have no words and go. Repeated rows and rows without doc_id are judged by
    their text like any other.
    """
    return quality_rules.keep_good(docs, "web-2")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id.

    Equal rows are copies of each other. Rows that share a doc_id but not their text stay apart. Null and empty
    texts, and rows without doc_id, are linked with nothing and stay.
    """
    return near_dup.keep_one(docs)


def scrub(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and n_chars counted anew where text changed.

    Null and empty texts stay as they are; repeated rows and rows without doc_id are treated like any other.
    """
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it, not at all or up to three times.

    Null and empty texts have no words and are not taken; a null source is a source of its own; repeated rows
    and rows without doc_id take part each for itself.
    """
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences; a document taken several times has pieces for each time.

    A null or empty text is a document of its end id only; rows without doc_id have pieces without one.
    """
    return packing.pieces(packing.pack_sequences(docs))


STAGES = [("quality", quality), ("near_duplicates", deduplicate), ("secrets", scrub), ("mix", mix), ("pack", pack)]

# Random rounding and tokenization have no SQL counterpart; tests rebuild the rows by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each result written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
