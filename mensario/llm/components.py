"""Connected components of an edge table by alternating star contraction.

Only grouped minima (combined before the shuffle) and joins that adaptive execution can
split, so a node with very many neighbours does not end in one task. Each round is
written to the shared folder. Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensario.llm.common import cut


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first()
    return int(row[0]), int(row[1])


def _star(directed: DataFrame, both_ends: bool) -> DataFrame:
    """Every neighbour ``b`` of ``a`` is linked to the least of ``a`` and its neighbours."""
    least = directed.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = directed.join(least, "a")
    if both_ends:  # b is the smaller end: keep a's own link as well
        pairs = joined.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
    else:
        pairs = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return pairs.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (columns a, b of one type): the least node reachable.

    Rows with a NULL end and loops are ignored; no edges give no rows.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    while state[0]:
        large = _star(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), False)
        new = cut(_star(large, True))
        now = _state(new)
        edges, done, state = new, now == state, now
        if done:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
