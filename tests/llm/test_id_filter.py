"""The filter keeps every row asked for, and few others."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm.id_filter import key_bits, maybe_asked, with_mark
from skyledger.llm.substring_dedup import remove_repeats
from skyledger.llm.suffix_dedup import remove_repeated_bytes

from .samples import frame


def test_no_row_asked_for_is_lost(spark):
    rows = spark.range(-20_000, 20_000).withColumn("text", F.lit("x"))
    asked = spark.range(-20_000, 20_000, 100)
    kept = {row.id for row in maybe_asked(rows, asked, "id").collect()}
    assert set(range(-20_000, 20_000, 100)) <= kept and len(kept) < 450
    marked = with_mark(rows, key_bits(asked, "id"), "id")
    assert marked.columns == ["id", "text", "_asked"] and marked.count() == 40_000 and marked.where("_asked IS NULL").isEmpty()


def test_nulls_and_empty_tables(spark):
    rows = spark.createDataFrame([(None,), (1,), (1,), (2,)], "id long")
    none = spark.createDataFrame([], "id long")
    assert maybe_asked(rows, none, "id").count() == 0
    assert maybe_asked(none, rows, "id").count() == 0
    assert [row.id for row in maybe_asked(rows, spark.createDataFrame([(1,)], "id long"), "id").collect()] == [1, 1]


def test_int_rows_meet_long_keys(spark):
    rows = spark.range(100).selectExpr("cast(id AS int) id")
    assert [row.id for row in maybe_asked(rows, spark.createDataFrame([(7,)], "id long"), "id").collect()] == [7]


def branch_not_moved(df):
    """The rows that a result takes without moving them: the first branch of its union."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Union":
        plan = plan.children().apply(0)
    return plan.children().apply(0).toString()


def test_texts_without_repeats_are_not_moved(spark):
    passage = " ".join(f"w{n}" for n in range(120))
    rows = [(1, passage, "en", "s", 1), (2, f"a b {passage}", "en", "s", 1), (3, "x y z", "en", "s", 1), (4, None, "en", "s", 1), (None, passage, "en", "s", 1)]
    docs = frame(spark, rows)
    words = remove_repeats(docs, width=50)
    found = {row.doc_id: (row.kept, row.n_words, row.n_removed, row.runs is None) for row in words.collect()}
    assert found == {1: (passage, 120, 0, True), 2: ("a b", 122, 120, False), 3: ("x y z", 3, 0, True), 4: ("", 0, 0, True), None: (passage, 120, 0, True)}
    bytes_ = remove_repeated_bytes(docs)
    size = len(passage)
    found = {row.doc_id: (row.n_bytes, row.n_removed) for row in bytes_.collect()}
    assert found == {1: (size, size), 2: (size + 4, size), 3: (5, 0), 4: (0, 0), None: (size, 0)}
    one = corpus_pipeline.keep_one_of_each_group(spark, docs, "")
    assert sorted((row.doc_id for row in one.collect()), key=str) == [1, 3, 4, None]
    for df in (words, bytes_, one):
        branch = branch_not_moved(df)
        assert branch.count("Join") == 1 and "strategy=broadcast" in branch
