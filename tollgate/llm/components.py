"""Connected components: union-find inside tasks, star operations between them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import Store

EDGES = "node long, root long"


def forests(batches):
    """Union-find over the edges of one task: each node with the smallest node it is linked to.

    A task holds the nodes of its own edges, which Spark bounds as it bounds any partition.
    """
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    rows = [(x, find(x)) for x in parent if find(x) != x]
    for first in range(0, len(rows), 100_000):
        nodes, roots = zip(*rows[first : first + 100_000], strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], names=["node", "root"]
        )


def linked_up(edges: DataFrame) -> DataFrame:
    """One round on edges node > root: every larger neighbour of a node, then every smaller one, moves to
    the smallest. Minima are added up in the tasks first; the joins' large partitions can be split."""
    both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
    low = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("low"))
    larger = edges.select(F.col("root").alias("node"), F.col("node").alias("far"))
    larger = larger.join(low, "node").select(F.col("far").alias("node"), F.col("low").alias("root"))
    own = edges.join(low, "node").select("node", F.col("low").alias("root"))
    large = larger.unionByName(own).where("node > root").distinct()
    least = large.groupBy("node").agg(F.min("root").alias("low"))
    small = large.join(least, "node").select(F.col("root").alias("node"), F.col("low").alias("root"))
    return small.unionByName(least.select("node", F.col("low").alias("root"))).where("node > root").distinct()


def components(store: Store, edges: DataFrame) -> DataFrame:
    """For every linked node but the smallest of its component: (node, root), root being the smallest.

    edges: any two long columns. Ends when every node has one root and no root has one of its own;
    rounds grow with the logarithm of the longest path that the tasks' forests leave.
    """
    tree = store.keep(edges.mapInArrow(forests, EDGES), "forest")
    while True:
        several = tree.groupBy("node").count().where("count > 1").limit(1)
        chained = tree.join(tree.select(F.col("node").alias("root")).distinct(), "root", "left_semi").limit(1)
        if several.isEmpty() and chained.isEmpty():
            return tree
        next_tree = store.keep(linked_up(tree).mapInArrow(forests, EDGES), "forest", within=(tree,))
        store.drop(tree)
        tree = next_tree
