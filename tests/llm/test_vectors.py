"""Embedding dedup and nearest neighbours against brute force."""

from __future__ import annotations

import math
import tracemalloc
import types

import numpy as np
import pyarrow as pa
import pytest

from skyledger.llm.cover_tree import TILE, CoverTree, distinct_points, near_duplicates, near_pairs, unit
from skyledger.llm.nearest import nearest, rotation, search_batch, within

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed, number, length):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(max(2, number // 12), length))
    points = centres[draw.integers(0, len(centres), number)] + draw.normal(size=(number, length)) * draw.choice([0.0, 0.05, 0.25], (number, 1))
    return points.astype(np.float32)


def odd_rows():
    nan, inf = float("nan"), float("inf")
    return [(9001, None, 1), (9002, [0.0] * 6, 1), (9003, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (9004, [nan] * 6, None),
            (9005, [inf, 1.0, 1.0, 1.0, 1.0, 1.0], 2), (9006, [], 2), (9007, [1.0, 2.0], 2)]


def table(spark, points, more=()):
    rows = [(7 * at - 30, [float(x) for x in point], at % 3) for at, point in enumerate(points)]
    return spark.createDataFrame([*rows, *more], SCHEMA).repartition(5).selectExpr("*", "1 AS id", "2 AS vector", "3 AS a"), rows


@pytest.mark.parametrize("seed,number,block", [(1, 150, 40), (2, 400, 10_000), (3, 1, 8)])
def test_links_match_brute_force(spark, seed, number, block):
    df, rows = table(spark, vectors(seed, number, 6), odd_rows())
    found = {row.vec_id: (row.n_links, row.component_id, row.kept) for row in near_duplicates(df, block=block).collect()}
    points = np.array([row[1] for row in rows])
    points /= np.sqrt((points**2).sum(axis=1, keepdims=True))
    near = points @ points.T >= 0.95
    np.fill_diagonal(near, False)
    ids = np.array([row[0] for row in rows])
    component = ids.copy()
    for _ in ids:
        component = np.array([min([component[at], *component[near[at]]]) for at in range(len(ids))])
    wanted = {int(id): (int(near[at].sum()), int(component[at]), bool(component[at] == id)) for at, id in enumerate(ids)}
    wanted |= {row[0]: (0, row[0], True) for row in odd_rows()}
    assert found == wanted


def test_dual_traversal_finds_all_pairs():
    for seed in range(6):
        points = unit(vectors(seed, 2400, 5).astype(float))
        left, right = points[:900], points[900:]
        reach = math.sqrt(2 - 2 * 0.95) + 1e-6
        trees = [CoverTree(one, reach) for one in (left, right)]
        found = [pair for x, y in near_pairs(left, right, *trees, 0.95) for pair in zip(x.tolist(), y.tolist())]
        assert len(found) == len(set(found))
        assert set(found) == set(zip(*(at.tolist() for at in np.nonzero(np.einsum("ik,jk->ij", left, right) >= 0.95))))


def test_nearest_match_brute_force(spark):
    df, rows = table(spark, vectors(5, 500, 12), odd_rows())
    found = {}
    for row in nearest(df, df.where("pmod(vec_id, 10) = 0"), k=10, block=20).collect():
        found.setdefault(row.query_id, []).append((row["rank"], row.vec_id, row.score))
    points, ids = np.array([row[1] for row in rows]), np.array([row[0] for row in rows])
    hits = total = 0
    for query, answers in found.items():
        own = points[list(ids).index(query)]
        away = np.sqrt(((points - own) ** 2).sum(axis=1))
        away[ids == query] = np.inf
        best = np.lexsort((ids, away))[:10]
        answers.sort()
        assert [answer[0] for answer in answers] == list(range(1, 11))
        for _, id, score in answers:
            assert abs(score - np.sqrt(((points[list(ids).index(id)] - own) ** 2).sum())) < 1e-12
        assert answers == sorted(answers, key=lambda answer: (answer[2], answer[1]))
        hits += len({answer[1] for answer in answers} & set(ids[best].tolist()))
        total += 10
    assert set(found) == {int(id) for id in ids if id % 10 == 0}
    assert hits / total >= 0.99


def test_search_keeps_its_memory_bounded_however_many_pairs_are_open():
    """Vectors without structure leave most pairs of a chunk open; they are measured a bounded number at a time."""
    random = np.random.default_rng(9)
    points, queries = unit(random.normal(size=(1024, 64))), unit(random.normal(size=(2048, 64)))
    turn = rotation(64, 7)
    turned = points @ turn.T
    columns = [
        pa.array(range(1024)),
        pa.array(points.tolist()),
        pa.array([row.tobytes() for row in np.packbits(turned > 0, axis=1)]),
        pa.array(np.ones(1024)),
        pa.array(np.abs(turned).sum(axis=1) / 8),
    ]
    batch = pa.RecordBatch.from_arrays(columns, names=["id", "vector", "signs", "norm", "share"])
    sent = types.SimpleNamespace(value=(np.arange(2048) + 5000, queries))
    tracemalloc.start()
    (found,) = search_batch(sent, np.zeros(64), turn, 10)(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
    away = ((points[None, :, :8] - queries[:, None, :8]) ** 2).sum(axis=2)
    for place in range(8, 64, 8):
        away += ((points[None, :, place : place + 8] - queries[:, None, place : place + 8]) ** 2).sum(axis=2)
    wanted = {(query + 5000, row) for query, best in enumerate(np.argpartition(away, 10, axis=1)[:, :10]) for row in best}
    pairs = set(zip(found.column("query_id").to_pylist(), found.column("vec_id").to_pylist()))
    assert len(pairs) == 20480 and len(pairs & wanted) >= 0.99 * len(wanted)


def test_pairs_are_passed_over_only_where_they_are_too_far():
    random = np.random.default_rng(2)
    queries, points = random.normal(size=(40, 6)), np.concatenate((random.normal(size=(60, 6)) * 2, np.full((1, 6), 1e200)))
    away = np.sqrt(((queries[:, None] - points) ** 2).sum(axis=2))
    near = within(queries, points, np.where(np.arange(40) < 20, np.median(away, axis=1), np.inf))
    assert near[20:].all() and (near[:20] == (away[:20] <= np.median(away, axis=1)[:20, None]))[:, :60].all()


def test_few_candidates_ties_and_empty(spark):
    rows = [(0, [1.0, 0.0], 0), (100, [1.0, 0.0], 0), (3, [0.0, 1.0], 0), (2, [2.0, 1.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    answers = [(r.query_id, r["rank"], r.vec_id) for r in nearest(df, df.where("vec_id = 0"), k=10).collect()]
    assert sorted(answers) == [(0, 1, 100), (0, 2, 2), (0, 3, 3)]
    empty = spark.createDataFrame([], SCHEMA)
    assert nearest(empty, empty).count() == 0
    assert near_duplicates(empty).count() == 0
    only_odd = spark.createDataFrame([(1, None, 0), (None, [1.0], 0)], SCHEMA)
    assert sorted(map(tuple, near_duplicates(only_odd).collect()), key=str) == [(1, 0, 1, True), (None, 0, None, False)]


def test_repeated_rows_of_one_id(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.01], 0)]
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, found.collect())) == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False)]


def test_close_vectors_are_tested_in_tiles():
    """A group of close vectors cannot be split; its pairs come a bounded number at a time."""
    points = unit(np.random.default_rng(4).normal(size=(3000, 4)) * 1e-3 + 1)
    tree = CoverTree(points, math.sqrt(2 - 2 * 0.95) + 1e-6)
    sizes = [len(x) for x, _ in near_pairs(points, points, tree, tree, 0.95)]
    assert sum(sizes) == 3000**2
    assert max(sizes) <= TILE[0] * TILE[1]


def test_equal_vectors_are_one_point(spark):
    rows = [(id, [0.6, 0.8], 0) for id in range(3000)] + [(5000 + id, [0.6, 0.8 + 1e-4 * (id + 1)], 0) for id in range(20)]
    df = spark.createDataFrame([*rows, (9000, [-1.0, 0.0], 0)], SCHEMA).repartition(4)
    points, homes = distinct_points(df.selectExpr("vec_id AS id", "embedding AS vector"))
    assert points.count() == 22 and homes.count() == 3021
    assert sorted(row.times for row in points.collect())[-2:] == [1, 3000]
    found = {tuple(row)[1:3] for row in near_duplicates(df).collect()}
    assert found == {(3019, 0), (0, 9000)}


def test_all_vectors_of_a_repeated_id_count(spark):
    up, right, down = [0.0, 1.0], [1.0, 0.0], [0.0, -1.0]
    rows = [(1, up, 0), (1, up, 0), (2, up, 0), (2, right, 0), (2, [1.0, 0.01], 0), (3, right, 0), (4, down, 0), (5, down, 0)]
    found = sorted(map(tuple, near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()))
    two = [(2, 3, 1, False)] * 3
    assert found == [(1, 1, 1, True)] * 2 + two + [(3, 2, 1, False), (4, 1, 4, True), (5, 1, 4, False)]


def test_repeated_rows_count_once(spark):
    random = np.random.default_rng(3)
    rows = [(number, random.normal(size=8).tolist()) for number in range(40)]
    once = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    often = spark.createDataFrame(rows + rows[::2] + rows[:5] * 3, "vec_id long, embedding array<float>").repartition(5)
    wanted = nearest(once, once.where("vec_id % 10 = 0"), k=10).collect()
    found = nearest(often, often.where("vec_id % 10 = 0"), k=10).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, wanted)) and len(found) == 40
    # Another vector of an id is another answer, and an id is none to itself.
    moved = often.unionByName(spark.createDataFrame([(7, rows[20][1]), (20, rows[7][1])], "vec_id long, embedding array<float>"))
    first = [row for row in nearest(moved, once.where("vec_id = 20"), k=2).collect() if row["rank"] == 1]
    assert [(row.vec_id, row.score) for row in first] == [(7, 0.0)]
