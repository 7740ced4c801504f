"""Connected components by hash-to-min, on rows rather than collected lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boreal.session import discard, written


def hash_to_min(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 40) -> DataFrame:
    """Component of each node of an undirected graph: ``node, component``, the component being its least node.

    Each node v keeps a cluster, one row per member. In a round v sends its whole cluster to the cluster's
    minimum m and m to every member, until no cluster changes. A cluster is rows keyed by (node, member), so
    a component that holds a third of all nodes is spread by row and never gathered in a list. Every round is
    written to the shared folder, which cuts the lineage and survives lost executors.

    Null ends and self loops tie nothing (a node with only a self loop still gets its own component). An
    empty table gives an empty result. Raises RuntimeError if ``most_rounds`` did not suffice: the number of
    rounds is about the logarithm of the longest chain.
    """
    ends = edges.select(F.col(a).alias("node"), F.col(b).alias("member")).where("node is not null and member is not null")
    both = ends.union(ends.select("member", "node")).union(ends.select("node", "node"))
    clusters = written(both.union(ends.select("member", "member")).distinct(), "clusters")
    mark = None
    for _ in range(most_rounds):
        # Rows of a cluster are distinct, so their number and hash sum tell whether a round changed any.
        before, mark = mark, clusters.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "member").cast("decimal(20,0)"))).first()
        if before == mark or not mark[0]:
            return clusters.groupBy("node").agg(F.min("member").alias("component"))
        least = clusters.groupBy("node").agg(F.min("member").alias("least"))
        pair = lambda a, b: F.struct(F.col(a).alias("node"), F.col(b).alias("member"))
        sent = clusters.join(least, "node").select(F.inline(F.array(pair("least", "member"), pair("member", "least"))))
        last, clusters = clusters, written(sent.distinct(), "clusters")
        discard(last)
    raise RuntimeError(f"components not stable after {most_rounds} rounds")
