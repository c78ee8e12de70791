"""Connected components of a distributed edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridsteps.llm.common import stored


def _print_of(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every vertex links its larger neighbours to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter("v > u AND v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every vertex links itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(vertex, component): the smallest vertex that each linked vertex reaches.

    ``links`` has two columns of vertices in any order; the smallest vertex of a
    component has no row. Both steps are sums over edges and joins, so a vertex
    with very many links is split like any skewed key. Each round is written to
    the shared folder; rounds end when the edges no longer change.
    """
    a, b = links.columns
    edges = stored(links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "components")
    before = _print_of(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)), "components")
        now = _print_of(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
