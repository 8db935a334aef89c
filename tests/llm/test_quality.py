"""The quality classifier: held-out accuracy, and scores of odd texts."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm.quality import THRESHOLD, bags, fit, held_out, score, train, word_features

from .samples import documents, frame

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = train(docs, labels, sample_rows=300)
    rows = score(docs, model).withColumn("held_out", held_out()).join(labels, "doc_id").collect()
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in rows)
    fold = [row for row in rows if row.held_out]
    assert len(fold) > 50
    right = sum((row.score >= THRESHOLD) == (row.quality == 1) for row in fold)
    assert right / len(fold) >= 0.97


def test_held_out_labels_teach_nothing(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 120")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("doc_id < 120")
    turned = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = train(docs, labels), train(docs, turned)
    assert one.bias == other.bias and (one.features == other.features).all()


def test_scores_of_odd_texts(spark):
    model = fit(["good text here", "bad bad bad bad"] * 20, np.array([1, 0] * 20))
    rows = documents()
    found = {row.doc_id: row.score for row in score(frame(spark, rows, extra=True), model).collect()}
    assert len(found) == len(rows) and all(0 <= one <= 1 for one in found.values())
    empty = {found[row[0]] for row in rows if not (row[1] or "").split()}
    assert len(empty) == 1
    again = [(1, "bad bad bad", None, None, None)] * 2 + [(None, "good text", None, None, None)]
    low, low_again, high = sorted(row.score for row in score(frame(spark, again), model).collect())
    assert low == low_again < 0.5 < high
    assert score(frame(spark, []), model).count() == 0
    carried = score(frame(spark, rows, extra=True), model, carry=True)
    assert set(frame(spark, rows, extra=True).columns) == set(carried.columns)


def test_scores_are_sums_over_features(spark):
    model = fit(["alpha beta beta", "gamma delta", "x y z"] * 5, np.array([1, 0, 1] * 5))
    text = "alpha gamma gamma zeta é日本 x"
    (features, weights), = bags([text])
    assert abs(weights.sum() - 1) < 1e-6
    wanted = 1 / (1 + np.exp(-(weights @ model.features[features] + model.bias)))
    found = score(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first().score
    assert abs(found - wanted) < 1e-6


def test_without_both_labels(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = frame(spark, documents())
    assert {row.score for row in score(docs, train(docs, empty)).collect()} == {0.5}
    ones = spark.createDataFrame([(row[0], 1) for row in documents()] + [(None, 0), (1, None)], "doc_id long, quality int")
    assert min(row.score for row in score(docs, train(docs, ones)).collect()) > 0.9


@pytest.mark.parametrize("words", [["a"], ["a", "ab", "abc", "é日本", "x" * 300]])
def test_word_features(words):
    import pyarrow as pa

    buckets, offsets = word_features(pa.array([word.encode() for word in words]))
    for word, first, last in zip(words, offsets[:-1], offsets[1:]):
        assert last - first == 1 + sum(max(0, len(word) + 2 - n + 1) for n in (3, 4))
        alone, _ = word_features(pa.array([word.encode()]))
        assert (buckets[first:last] == alone).all()
