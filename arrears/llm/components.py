"""Connected components of a distributed edge list, and spanning forests of small dense graphs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm.tables import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (u long, v long); the component is its smallest node.

    Labels spread along edges and then jump to the label of their label, so the
    number of rounds grows with the logarithm of the longest path. Every round
    is a written table.
    """
    both = written(edges.select("u", "v").union(edges.select("v", "u")).where("u != v").distinct(), "edges")
    labels = written(both.groupBy(F.col("u").alias("node")).agg(F.min(F.least("u", "v")).alias("component")), "labels")
    while True:
        seen = both.join(labels, F.col("v") == F.col("node")).groupBy("u").agg(F.min("component").alias("near"))
        spread = written(
            labels.join(seen, F.col("node") == F.col("u")).select(
                "node", F.col("component").alias("was"), F.least("component", "near").alias("component")
            ),
            "labels",
        )
        if spread.where("was != component").isEmpty():
            return labels
        over = spread.select(F.col("node").alias("at"), F.col("component").alias("beyond"))
        labels = written(
            spread.join(over, F.col("component") == F.col("at")).select("node", F.least("component", "beyond").alias("component")),
            "labels",
        )


def forest(linked: np.ndarray) -> np.ndarray:
    """For each node of a symmetric boolean matrix, the lowest node of its component."""
    root = np.full(len(linked), -1)
    for i in range(len(linked)):
        if root[i] >= 0:
            continue
        root[i] = i
        todo = [i]
        while todo:
            fresh = np.flatnonzero(linked[todo.pop()] & (root < 0))
            root[fresh] = i
            todo.extend(fresh.tolist())
    return root
