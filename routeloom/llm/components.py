"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """One row per linked node: ``node`` and ``component``, the smallest node it reaches.

    Alternates two steps until nothing changes: every node sends its larger neighbours,
    then its smaller ones, to the smallest node it knows. Neighbourhoods are only ever
    reduced to a minimum and joined back, so a node with very many links is no single
    group: minima combine before the shuffle and the join splits skewed nodes. Each round
    is a written table. Null ends and self links are ignored; an empty table gives none.
    """
    ends = (F.col(left).alias("a"), F.col(right).alias("b"))
    clean = links.select(*ends).filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    state = stored(
        clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    before = _mark(state)
    while before[0]:
        state = stored(_to_smallest(_to_smallest(state, larger=True), larger=False), "links")
        after = _mark(state)
        if after == before:
            break
        before = after
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _mark(links: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
    )


def _to_smallest(links: DataFrame, larger: bool) -> DataFrame:
    """Links of every node's larger (or smaller) neighbours to its smallest neighbour."""
    if larger:
        around = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        around = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    lowest = around.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    joined = around.join(lowest, "u")
    if larger:
        moved = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            lowest.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return moved.filter("a <> b").distinct()
