"""Connected components of a graph given as edges, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.sources.tables import snapshot


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (u, v): label is the smallest node it can reach.

    In each round every node points to its smallest neighbour, and the edges are rewritten to the nodes pointed
    to, so each round leaves a fraction of them. Minima are taken in the map task first; the joins meet one row
    per node, and adaptive execution splits them where a node has very many edges. An empty graph has no nodes.
    """
    edges = edges.select("u", "v").filter("u <> v")
    labels = None
    while True:
        both = edges.union(edges.select("v", "u"))
        parent = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least"))
        parent = snapshot(parent.select("node", F.least("node", "least").alias("parent")), "parents")
        if labels is None:
            labels = parent.withColumnRenamed("parent", "label")
        else:
            step = parent.withColumnsRenamed({"node": "label", "parent": "next"})
            labels = labels.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
        first = edges.join(parent, F.col("u") == F.col("node")).select(F.col("parent").alias("u"), "v")
        both = first.join(parent, F.col("v") == F.col("node")).select("u", F.col("parent").alias("v")).filter("u <> v")
        edges = snapshot(both.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "contracted")
        if edges.isEmpty():
            return snapshot(labels, "labels")
