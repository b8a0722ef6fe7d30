"""Connected components of a graph given as edges, by alternating stars.

Every round is two groupings on a vertex and one table in the shared folder;
the number of rounds grows with the logarithm of the longest path, and no
vertex, edge or component reaches the driver.  The smallest neighbour of a
vertex is an aggregate that each task forms for its own rows first; the join
that hands it to the neighbours is a plain equi-join, which adaptive execution
splits where one vertex has very many of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from drayline.session import RunFolder


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _hook(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Link each vertex's neighbours to the smallest of them and itself.

    ``larger_only`` moves the neighbours above the vertex (large star), else
    the neighbours below it (small star).
    """
    near = _both_ways(edges) if larger_only else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = near.join(least, "a")
    if larger_only:
        out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(linked.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, run: RunFolder, label: str = "components") -> DataFrame:
    """``vertex`` and ``component`` (its smallest member) for every vertex of ``edges(a, b)``.

    Loops and repeated edges are allowed, edges with a null end are ignored.  A
    vertex without any other neighbour is not listed.
    """
    edges = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct()
    edges = run.keep(edges, f"{label}-0")
    mark, turn = None, 0
    while True:
        turn += 1
        starred = run.keep(_hook(_hook(edges, True), False), f"{label}-{turn}")
        now = starred.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        edges = starred
        if tuple(now) == mark:
            return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct()
            )
        mark = tuple(now)
