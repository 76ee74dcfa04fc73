"""Connected components by minimum labels, all in Spark.

Each round hooks every node to its smallest neighbour, follows the pointers a
few steps and contracts the edges to the roots found. The edges shrink with
every round; tables between rounds are written to the shared folder. Nothing
is collected but the answer to "are there edges left".
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import dropped, written

JUMPS = 3


def _roots(edges: DataFrame) -> DataFrame:
    """(node, root): pointers to the smallest neighbour, followed JUMPS times."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    p = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("root"))
    for _ in range(JUMPS):
        q = p.select(F.col("node").alias("root"), F.col("root").alias("next"))
        p = p.join(q, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return p


def components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (node, comp) updated by the edges (a, b) between nodes.

    The result is a written table; a component's label is its smallest node
    if that holds for ``labels``, too.
    """
    comp_a = labels.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
    comp_b = labels.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
    left = written(edges.join(comp_a, "a").join(comp_b, "b")
                   .select(F.col("ca").alias("a"), F.col("cb").alias("b"))
                   .filter("a <> b").distinct(), "component-edges")
    while not left.isEmpty():
        roots = written(_roots(left), "component-roots")
        ra = roots.withColumnsRenamed({"node": "a", "root": "ra"})
        rb = roots.withColumnsRenamed({"node": "b", "root": "rb"})
        after = written(left.join(ra, "a").join(rb, "b")
                        .select(F.col("ra").alias("a"), F.col("rb").alias("b"))
                        .filter("a <> b").distinct(), "component-edges")
        moved = roots.withColumnsRenamed({"node": "comp", "root": "to"})
        labels = written(labels.join(moved, "comp", "left")
                         .select("node", F.coalesce("to", "comp").alias("comp")), "component-labels")
        dropped(left)
        dropped(roots)
        left = after
    return labels
