"""Connected components by contraction: each round every node moves to its smallest neighbour.

Groups are never gathered: a round is one aggregated minimum per node, a few joins that follow the
pointers to their ends, and a distinct over the edges that are left. Every table of a round is
written to the shared folder, so a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.tables import is_empty
from scrubline.workspace import written


def _ordered(edges: DataFrame) -> DataFrame:
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.where("a < b").distinct()


def _to_ends(pointers: DataFrame) -> DataFrame:
    """Follow ``node -> target`` to the end, doubling the distance in every step."""
    while True:
        onward = pointers.select(F.col("node").alias("target"), F.col("target").alias("onward"))
        step = written(
            pointers.join(onward, "target").select(
                "node", F.col("onward").alias("target"), (F.col("onward") < F.col("target")).alias("moved")
            ),
            "pointers",
        )
        pointers = step.select("node", "target")
        if is_empty(step.where("moved")):
            return pointers


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node of ``edges (a, b)``.

    Loops, repeated edges and either direction are fine; no edges give no rows. Every round takes
    nodes away, so it ends; a star takes two rounds whatever its numbers, and a path of any length
    folds within one, because pointers are followed by doubling.
    """
    edges = written(_ordered(edges), "edges")
    found = None
    while not is_empty(edges):
        both = edges.union(edges.select("b", "a")).toDF("node", "other")
        nearest = both.groupBy("node").agg(F.min("other").alias("other"))
        pointers = _to_ends(
            written(nearest.select("node", F.least("node", "other").alias("target")), "nearest")
        )
        if found is None:
            found = pointers
        else:
            onward = pointers.select(F.col("node").alias("target"), F.col("target").alias("onward"))
            found = written(
                found.join(onward, "target", "left").select(
                    "node", F.coalesce("onward", "target").alias("target")
                ),
                "found",
            )
        a = pointers.toDF("a", "new_a")
        b = pointers.toDF("b", "new_b")
        moved = edges.join(a, "a").join(b, "b")
        edges = written(_ordered(moved.select(F.col("new_a").alias("a"), F.col("new_b").alias("b"))), "edges")
    if found is None:
        return edges.toDF("node", "component")
    return found.toDF("node", "component")
