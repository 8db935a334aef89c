"""Connected components of a link table, by alternating large and small stars.

Each step hangs the neighbours of every node on the least of them and keeps the components. A node
with very many links is never gathered: its least neighbour is a partial aggregate, and the join that
hands it out can be split.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.tables import stored
from skyledger.operators.joins import own_shuffle


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links a-b held in one task, and the least node each one reaches."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        least = root.copy()
        np.minimum.at(least, left, root[right])
        np.minimum.at(least, right, root[left])
        np.minimum.at(least, root[left], least[left])
        np.minimum.at(least, root[right], least[right])
        least = least[least]
        if (least == root).all():
            return nodes, nodes[root]
        root = least


def large_star(links: DataFrame) -> DataFrame:
    """Hangs the greater neighbours of a node on its least neighbour (or on itself)."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(own_shuffle(least, ["u"]), "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Hangs a node and its lesser neighbours on the least of them. Links go from greater to lesser."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    hung = links.join(own_shuffle(least, ["a"]), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.where("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component_id) of every node that has a link; the component is its least node.

    ``links`` has two columns a and b in any order; repeated links and links to oneself are fine.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    links = stored(ordered.distinct(), "links")
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    before = None
    while True:
        # Links between stars' centres and members stay as they are; then the work is done.
        links = stored(small_star(large_star(links)), "links")
        now = links.agg(mark.alias("mark")).first()
        if now == before:
            return links.select(F.col("a").alias("id"), F.col("b").alias("component_id")).unionByName(
                links.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct()
            )
        before = now
