"""Connected components of links, in Spark and within one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.session import stage


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 linked as ``a[i] - b[i]``: the smallest node of each one's component."""
    label = np.arange(n)
    while True:
        left, right = label[a], label[b]
        apart = left != right
        if not apart.any():
            return label
        a, b, left, right = a[apart], b[apart], left[apart], right[apart]
        np.minimum.at(label, np.maximum(left, right), np.minimum(left, right))
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped


def star(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between values, reduced to one per value: (value, smallest value of its component).

    ``a`` and ``b`` are places in ``nodes``, which may repeat values. Components keep
    together and no more than one link per distinct value remains.
    """
    values, place = np.unique(nodes, return_inverse=True)
    roots = local_roots(len(values), place[a], place[b])
    linked = np.flatnonzero(roots != np.arange(len(values)))
    return values[linked], values[roots[linked]]


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b), the component its smallest node.

    Alternates two steps on links oriented from the larger to the smaller node until all
    are stars. One sends each larger neighbour of a node to the node's smallest neighbour,
    the other all smaller neighbours of a node; both keep components and the
    number of links, and the rounds needed grow with the logarithm of the
    largest component. Each step is written to the shared folder. A hub meets
    its links in a join of two exchanges, which Spark can split.
    """
    current = stage(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct(),
        "links",
    )
    while True:
        least = stage(
            current.groupBy("hi").agg(F.min("lo").alias("least"), F.count(F.lit(1)).alias("n"))
            .withColumnRenamed("hi", "node"),
            "least",
        )
        larger = stage(
            current.join(least.select("node", "least"), current["lo"] == least["node"], "left")
            .select(
                "hi",
                F.coalesce("least", "lo").alias("lo"),
                F.col("least").isNotNull().alias("moved"),
            ),
            "larger",
        )
        moved = larger.agg(F.coalesce(F.count_if("moved"), F.lit(0))).first()[0]
        several = least.agg(F.coalesce(F.count_if(F.col("n") > 1), F.lit(0))).first()[0]
        if not moved and not several:
            roots = current.select(F.col("lo").alias("node")).distinct()
            return current.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
                roots.select("node", F.col("node").alias("component"))
            )
        pairs = larger.select("hi", "lo")
        smallest = pairs.groupBy("hi").agg(F.min("lo").alias("least"))
        onto = pairs.join(smallest.withColumnRenamed("hi", "node"), F.col("hi") == F.col("node"))
        current = stage(
            onto.where(F.col("lo") != F.col("least"))
            .select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
            .union(smallest.select("hi", F.col("least").alias("lo")))
            .distinct(),
            "links",
        )
