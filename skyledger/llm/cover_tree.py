"""Embedding near-dedup: exact threshold pairs by dual traversal of cover trees.

Unit vectors with a cosine of at least c lie within sqrt(2 - 2c) of each other. A cover tree splits
its points into nodes around centres, level by level, until a node's radius is halved or its fan-out
is used up. Two nodes are dropped together when their centres are further apart than both radii and
the threshold allow. Equal vectors become one point that counts as often as it occurs. Every block of
a bounded number of points becomes a tree and goes to all tasks; each task turns its rows into a tree
of its own, too, and traverses both. Leaves that meet are tested tile by tile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.components import components, local_roots
from skyledger.llm.tables import stored
from skyledger.llm.textscan import flat_ranges, thrifty
from skyledger.llm.vectors import matrix, usable_rows
from skyledger.operators.joins import own_shuffle

FAN_OUT = 64
LEAF = 256
# Rows of either side that are tested at once, and pairs of them in double precision.
TILE = 512, 2048
PAIRS = 65_536
# Links that a task holds before it replaces them by the least node each one reaches.
HELD = 1 << 20
# Room for rounding in bounds; the threshold itself is tested on the cosine in double precision.
SLACK = 1e-6


class CoverTree:
    """Nodes in breadth-first order, as arrays: centre, radius, children and points of each."""

    def __init__(self, points: np.ndarray, reach: float):
        centres, radii, groups, children = [], [], [np.arange(len(points))], []
        at = 0
        while at < len(groups):
            group = groups[at]
            centre = points[group].mean(axis=0)
            radius = float(np.sqrt(((points[group] - centre) ** 2).sum(axis=1)).max()) + SLACK
            parts = [] if len(group) <= LEAF or radius <= reach / 2 else split(points[group], radius)
            children.append((len(groups), len(parts)) if len(parts) > 1 else (0, 0))
            if len(parts) > 1:
                groups += [group[part] for part in parts]
            centres.append(centre)
            radii.append(radius)
            at += 1
        self.centres, self.radii, self.groups = np.array(centres), np.array(radii), groups
        self.first, self.count = np.array(children, dtype=np.int64).T

    def opened(self, nodes: np.ndarray) -> np.ndarray:
        """Children of the nodes; leaves stay."""
        inner = self.count[nodes] > 0
        return np.concatenate((nodes[~inner], flat_ranges(self.first[nodes[inner]], self.count[nodes[inner]])))


def split(points: np.ndarray, radius: float) -> list[np.ndarray]:
    """Groups of unit vectors: furthest points become centres until all are within half the radius of
    one, or the fan-out is used up."""
    nearest = np.full(len(points), np.inf)
    owner = np.zeros(len(points), dtype=np.int64)
    pick = 0
    for number in range(min(FAN_OUT, len(points))):
        away = 2 - 2 * (points @ points[pick])
        closer = away < nearest
        owner[closer] = number
        nearest = np.minimum(nearest, away)
        pick = int(np.argmax(nearest))
        if nearest[pick] <= radius**2 / 4:
            break
    order = np.argsort(owner, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(owner[order])) + 1)


def meeting_leaves(left: CoverTree, right: CoverTree, reach: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index groups of both trees that may hold pairs within ``reach``: a left leaf and what meets it."""

    def near(node: int, others: np.ndarray) -> np.ndarray:
        away = np.sqrt(((right.centres[others] - left.centres[node]) ** 2).sum(axis=1))
        return others[away <= right.radii[others] + left.radii[node] + reach]

    stack = [(0, np.array([0]))]
    while stack:
        node, others = stack.pop()
        others = near(node, others)
        if not len(others):
            continue
        if left.count[node]:
            # Both sides open one level.
            others = near(node, right.opened(others))
            stack += [(child, others) for child in range(left.first[node], left.first[node] + left.count[node])]
            continue
        while (right.count[others] > 0).any():
            others = near(node, right.opened(others))
        if len(others):
            yield left.groups[node], np.concatenate([right.groups[other] for other in others])


def near_pairs(left: np.ndarray, right: np.ndarray, left_tree: CoverTree, right_tree: CoverTree, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows, as indices into both sides, with at least the given cosine."""
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + SLACK
    # What single precision may be off by.
    doubt = 1e-4 + left.shape[1] * 2.0**-23
    left32, right32 = left.astype(np.float32), right.astype(np.float32)
    for a, b in meeting_leaves(left_tree, right_tree, reach):
        for top in range(0, len(a), TILE[0]):
            rows = a[top : top + TILE[0]]
            for first in range(0, len(b), TILE[1]):
                columns = b[first : first + TILE[1]]
                cosines = left32[rows] @ right32[columns].T
                x, y = np.nonzero(cosines >= cosine - doubt)
                exact = np.ones(len(x), dtype=bool)
                unsure = np.flatnonzero(cosines[x, y] < cosine + doubt)
                x, y = rows[x], columns[y]
                for at in range(0, len(unsure), PAIRS):
                    some = unsure[at : at + PAIRS]
                    exact[some] = np.einsum("ij,ij->i", left[x[some]], right[y[some]]) >= cosine
                yield x[exact], y[exact]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by the largest component first, which cannot overflow."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def near_duplicates(rows: DataFrame, cosine: float = 0.95, id: str = "vec_id", vector: str = "embedding", block: int = 16384) -> DataFrame:
    """Links all pairs with at least the given cosine: (id, n_links, component_id, kept).

    ``n_links`` counts the other vectors linked directly, ``component_id`` is the least id reachable,
    ``kept`` tells whether that is the row's own. Vectors that are null, empty, zero, of an unusual
    length, or that hold null or non-finite components link with nothing, nor does a null id, whose
    component is null. Ids are unique; if one has several vectors, their links are its own, and
    each of them counts in the links of others. Vectors of one id do not link, and equal rows count once. Distinct vectors visit all blocks of about ``block``,
    one pass after another; a pass sends one block to all tasks and moves nothing else.
    """
    if not 0 < cosine <= 1:
        raise ValueError("the cosine lies between 0 and 1")
    spark = rows.sparkSession
    sound, length = usable_rows(rows, id, vector)
    points, homes = distinct_points(sound)
    total = points.count()
    passes = -(-total // block)
    found = []
    for number in range(passes):
        chosen = points.where(F.pmod("name", F.lit(passes)) == number).toArrow()
        residents = unit(matrix(chosen.column("vector").combine_chunks(), length)) if chosen.num_rows else np.zeros((0, length))
        if not len(residents):
            continue
        reach = float(np.sqrt(2 - 2 * cosine)) + SLACK
        sent = spark.sparkContext.broadcast((chosen.column("node").to_numpy(), chosen.column("times").to_numpy(), residents, CoverTree(residents, reach)))
        found.append(stored(points.mapInArrow(thrifty(links_with(sent, length, cosine)), "a long, b long, n long"), "near-pairs"))
        sent.destroy()
    out = rows.select(F.col(id).alias("id"))
    if not found:
        return out.select(F.col("id").alias(id), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    counts = links.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    groups = components(links.select("a", "b")).withColumnRenamed("id", "node")
    linked = own_shuffle(counts.join(groups, "node"), ["node"])
    component = F.coalesce("component_id", "node", "id")
    return out.join(own_shuffle(homes, ["id"]), "id", "left").join(linked, "node", "left").select(
        F.col("id").alias(id),
        (F.coalesce("n", F.lit(0)) + F.coalesce(F.col("times") - 1, F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def distinct_points(sound: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct vectors of (id, vector): as points (node, times, name, check, vector), and where
    each id lies: (id, node, times). A node is the least id of a vector, ``times`` the number of its
    ids. Vectors of an id that has several are points of their own, with the id as their node.

    Equal vectors meet under two names of 64 bits; a frequent one is reduced before it travels.
    """
    named = sound.select("id", "vector", F.xxhash64("vector").alias("name"), F.xxhash64(F.lit(1), "vector").alias("check"))
    named = stored(named, "vectors")
    members = stored(named.select("id", "name", "check").distinct(), "members")
    several = stored(members.groupBy("id").count().where("count > 1").select("id", F.lit(True).alias("several")), "repeated-ids")
    if not several.isEmpty():

        def apart(df: DataFrame) -> DataFrame:
            own = F.when(F.col("several"), F.xxhash64("check", "id")).otherwise(F.col("check"))
            return df.join(own_shuffle(several, ["id"]), "id", "left").withColumn("check", own).drop("several")

        named, members = apart(named), apart(members)
    counted = members.groupBy("name", "check").agg(F.min("id").alias("node"), F.count("*").alias("times"))
    vectors = named.groupBy("name", "check").agg(F.first("vector").alias("vector"))
    points = stored(counted.join(vectors, ["name", "check"]).select("node", "times", "name", "check", "vector"), "points")
    nodes = own_shuffle(points.select("name", "check", "node", "times"), ["name", "check"])
    return points, members.join(nodes, ["name", "check"]).select("id", "node", "times").distinct()


def links_with(sent, length: int, cosine: float):
    """For each point that is linked into the block: (point, itself, links); and links that join the
    points which meet in the task, with a count of 0."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resident_ids, times, residents, tree = sent.value
        reach = float(np.sqrt(2 - 2 * cosine)) + SLACK
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("node").to_numpy()
            vectors = unit(matrix(batch.column("vector"), length))
            own = CoverTree(vectors, reach)
            counts = np.zeros(len(ids), dtype=np.int64)
            held, size = [], 0
            for x, y in near_pairs(vectors, residents, own, tree, cosine):
                other = ids[x] != resident_ids[y]
                x, y = x[other], y[other]
                if not len(x):
                    continue
                np.add.at(counts, x, times[y])
                held.append(joined(ids[x], resident_ids[y]))
                size += len(held[-1][0])
                if size > HELD:
                    held = [joined(*map(np.concatenate, zip(*held)))]
                    size = 0
            if not held:
                continue
            nodes, roots = joined(*map(np.concatenate, zip(*held)))
            linked = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((ids[linked], nodes))),
                    pa.array(np.concatenate((ids[linked], roots))),
                    pa.array(np.concatenate((counts[linked], np.zeros(len(nodes), dtype=np.int64)))),
                ],
                names=["a", "b", "n"],
            )

    return scan


def joined(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the links a-b do, one for each node but the least ones."""
    nodes, roots = local_roots(a, b)
    hung = nodes != roots
    return nodes[hung], roots[hung]
