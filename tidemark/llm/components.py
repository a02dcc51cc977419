"""Connected components of a graph given as rows, none of which passes the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import SMALL
from tidemark.plans.joins import join_checked
from tidemark.plans.storage import stage

MAX_ROUNDS = 60


class Forest:
    """Disjoint sets within one task; the smallest member is the root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True

    def links(self) -> list[tuple[int, int]]:
        return [(x, self.find(x)) for x in list(self.parent)]


def _toward_smallest(pairs: DataFrame) -> DataFrame:
    """Each neighbour (column b) of a node (column a), with the smallest node around that node (column m)."""
    smallest = stage(pairs.groupBy("a").agg(F.min("b").alias("m")), "components-min")
    return join_checked(pairs, smallest, ["a"], limit=SMALL)


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: bigint, none null) to (node, component), the component's smallest node, for every node with an edge.

    Alternates two steps until nothing changes: larger neighbours of a node, then
    smaller ones, are attached to the smallest node around it.  The number of
    rounds is about the logarithm of the longest path.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                "components")
    mark = None
    for _ in range(MAX_ROUNDS):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _toward_smallest(both).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        large = stage(large.where("a <> b").distinct(), "components-large")
        # Every node keeps one edge to its smallest neighbour; the others are attached there.
        star = _toward_smallest(large)
        small = star.select("a", F.col("m").alias("b")).union(star.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        now = stage(small.distinct(), "components")
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == mark:
            break
        mark = state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b"), F.col("b")).distinct())
