from __future__ import annotations

import numpy as np
import pytest

from skyledger.operators.clustered_search import ClusteredCorpus, build_clusters
from skyledger.operators.retrieval import topk_similar
from skyledger.session import work_dir

CORPUS, QUERIES = "chunk_id long, embedding array<float>", "query_id string, embedding array<float>"


def vectors(seed, centres, each, spread, width=16):
    draw = np.random.default_rng(seed)
    middles = draw.normal(size=(centres, width))
    return (middles[:, None, :] + spread * draw.normal(size=(centres, each, width))).reshape(-1, width)


def both(spark, corpus, queries, k, pivots=64):
    corpus = spark.createDataFrame(corpus, CORPUS).repartition(6)
    queries = spark.createDataFrame(queries, QUERIES)
    folder = work_dir(spark, "clusters")
    build_clusters(corpus, folder, pivots=pivots)
    found, scored = ClusteredCorpus(spark, folder).topk(queries, k)
    wanted = topk_similar(queries, corpus, k).select(*found.columns)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, wanted.collect()), key=repr)
    return scored


def rows(values):
    return [(number, value.tolist()) for number, value in enumerate(values)]


def test_most_of_a_clustered_corpus_is_not_scored(spark):
    corpus = rows(vectors(1, 40, 60, 0.05))
    queries = [(str(number), value) for number, value in corpus[::97]]
    scored = both(spark, corpus, queries, 5)
    assert 0 < scored < 0.25 * len(corpus) * len(queries)


@pytest.mark.parametrize("pivots, k", [(1, 3), (7, 10), (64, 500)])
def test_answers_are_exact_without_structure(spark, pivots, k):
    corpus = rows(vectors(2, 300, 1, 1.0, width=5))
    queries = [(str(number), value.tolist()) for number, value in enumerate(vectors(3, 20, 1, 1.0, width=5))]
    both(spark, corpus, queries, k, pivots)


def test_odd_vectors(spark):
    nan = float("nan")
    corpus = rows(vectors(4, 20, 3, 0.1, width=3))
    corpus += [(1000 + n, [0.0, 0.0, 0.0]) for n in range(4)] + [(1010, [nan, 1.0, 0.0]), (1011, None), (1012, [None, 1.0, 2.0])]
    corpus += [(2000 + n, corpus[5][1]) for n in range(30)] + [(5, corpus[5][1])]
    queries = [("zero", [0.0, 0.0, 0.0]), ("far", (-np.array(corpus[5][1])).tolist()), ("same", corpus[5][1]), ("none", None), (None, corpus[9][1])]
    both(spark, corpus, queries, 7, 8)
    both(spark, corpus, queries, 100, 8)
    both(spark, [(1, [0.0, 0.0])], [("a", [1.0, 0.0])], 2)
    both(spark, [], [("a", [1.0, 0.0])], 2)
    both(spark, rows(vectors(4, 2, 2, 0.1)), [], 2)
