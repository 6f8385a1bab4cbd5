"""Connected components by contraction: each round every node takes its least neighbour, chains are halved, edges shrink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_out


def _roots(parents: DataFrame) -> DataFrame:
    """(v, root) of a forest (v, p) with p <= v: jump until every p is a root."""
    while True:
        up = parents.select(F.col("v").alias("p"), F.col("p").alias("q"))
        jumped = write_out(parents.join(up, "p", "left").select("v", F.coalesce("q", "p").alias("p"), (F.col("q") < F.col("p")).alias("moved")), "roots")
        if not jumped.filter("moved").limit(1).count():
            return jumped.select("v", F.col("p").alias("root"))
        parents = jumped.select("v", "p")


def components(edges: DataFrame) -> DataFrame:
    """(v, root) of each node of the edges (a, b): root is the least node it is connected with.

    Rounds are at most logarithmic in the number of nodes. Tables of links and
    roots stay with the executors; a hot node is met by map-side minima and by
    joins that adaptive execution splits.
    """
    edges = edges.select("a", "b").filter("a <> b")
    found = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("b"))
        roots = _roots(near.select("v", F.least("v", "b").alias("p")))
        if found is None:
            found = roots
        else:
            step = roots.select(F.col("v").alias("root"), F.col("root").alias("next"))
            found = write_out(found.join(step, "root", "left").select("v", F.coalesce("next", "root").alias("root")), "components")
        ends = [roots.select(F.col("v").alias(c), F.col("root").alias(f"r{c}")) for c in ("a", "b")]
        edges = write_out(
            edges.join(ends[0], "a").join(ends[1], "b").select(F.col("ra").alias("a"), F.col("rb").alias("b")).filter("a <> b").distinct(), "edges"
        )
        if not edges.limit(1).count():
            return found
