"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsim.session import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(high, low))").alias("x")).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``links`` (``high``, ``low``, with high > low) to ``node``, ``root``: the least node reachable.

    Only linked nodes are returned, and roots are not. Each round hangs every node under the least
    neighbour of its neighbours (large star), then flattens the trees (small star), and is written to
    the shared folder; it stops when a round changes nothing. Rounds grow with the logarithm of the
    longest path. A node with very many neighbours is only ever one side of a join or a minimum.
    """
    edges = written(links.select("high", "low").distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).union(
            edges.select(F.col("low").alias("u"), F.col("high").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("high"), F.col("m").alias("low")).distinct()
        )
        large = written(large, "large-star")
        lowest = large.groupBy("high").agg(F.min("low").alias("m"))
        hung = large.join(lowest, "high").where("low > m").select(F.col("low").alias("high"), F.col("m").alias("low"))
        edges = written(hung.union(lowest.select("high", F.col("m").alias("low"))).distinct(), "small-star")
        state, before = _state(edges), state
        if state == before:
            break
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root"))
