"""The pipeline, stage by stage, against what each stage may keep; and the registered queries."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from skyledger.llm.queries import ORACLES, QUERIES
from skyledger.llm.tables import stored

from ..compare import difference, oracle_connection
from .samples import documents, frame
from .test_jaccard_join import brute
from .test_repeats import brute_words

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_queries_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert difference(df, duck, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_stages_and_columns(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "substring dedup", "mixing sources", "best-fit packing",
    ]
    docs = frame(spark, documents(), extra=True)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_DIR), "stage")
        assert docs.columns == corpus_pipeline.COLUMNS
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() >= docs.count()


def test_one_of_each_group_stays(spark):
    rows = documents(6)
    kept = corpus_pipeline.keep_one_of_each_group(spark, frame(spark, rows), SF_DIR).collect()
    assert sorted(row.doc_id for row in kept) == sorted(id for id, _, component in brute(rows, 5, 80) if id == component)
    twice = [(1, "a b c d e f", "en", "s", 1)] * 2 + [(2, "a b c d e f", "en", "s", 1), (None, "x y", "en", "s", 1), (None, "x y", "en", "s", 1)]
    kept = corpus_pipeline.keep_one_of_each_group(spark, frame(spark, twice), SF_DIR).collect()
    assert sorted((row.doc_id for row in kept), key=str) == [1, None, None]


def test_repeated_passages_are_cut(spark):
    rows = documents(6)
    cut = {row.doc_id: row.text for row in corpus_pipeline.cut_repeated_passages(spark, frame(spark, rows), SF_DIR).collect()}
    wanted = {id: removed for id, total, removed, _ in brute_words(rows, 50) if removed < total or not total}
    assert set(cut) == set(wanted)
    sizes = {row[0]: len((row[1] or "").encode().split()) for row in rows}
    assert all(len(text.encode().split()) == sizes[id] - wanted[id] for id, text in cut.items())


def test_mix_writes_the_words_it_takes(spark):
    from skyledger.llm.mixing import mix_sources

    rows = documents(6)
    taken = Counter()
    for row in corpus_pipeline.mix_to_targets(spark, frame(spark, rows), SF_DIR).collect():
        taken[row.doc_id] += len(row.text.encode().split())
        assert row.n_chars == len(row.text)
    wanted = {row.doc_id: row.taken for row in mix_sources(frame(spark, rows)).collect() if row.taken}
    assert taken == wanted


def test_quality_stage_keeps_clean_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {row.doc_id: row.quality for row in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    kept = {row.doc_id for row in corpus_pipeline.keep_good_quality(spark, docs, "/root/testdata/sf0.01").collect()}
    wrong = sum((id in kept) != (quality == 1) for id, quality in labels.items())
    assert wrong <= 0.01 * len(labels)


def test_empty_documents_run_through(spark):
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), "stage")
    assert docs.count() == 0


def test_documents_with_nothing_to_cut_stay_as_they_are(spark):
    passage = " \n".join(f"p{at}" for at in range(50))
    rows = [(1, f" a\t\tb\n{passage}  c ", "en", "s", 7), (2, f" d\t{passage}\r\n e \n", "en", "s", 7), (3, passage, "en", "s", 7),
            (4, " x \n\n y\t", "en", "s", 7), (5, "", "en", "s", 0), (6, " \n", "en", "s", 2), (7, f"f\n{passage}", "en", "s", 7)]
    cut = corpus_pipeline.cut_repeated_passages(spark, frame(spark, rows, extra=True), SF_DIR).collect()
    kept = [rows[0], (2, " d\te \n", "en", "s", 6), *rows[3:6], (7, "f\n", "en", "s", 2)]
    assert sorted(map(tuple, cut)) == kept


def test_repeated_ids_keep_their_dissimilar_texts(spark):
    one, other, third = ("a b c d e f", "g h i j k l", "m n o p q r")
    rows = [(1, one, "en", "s", 11), (1, one, "en", "s", 11), (1, other, "en", "t", 11), (2, other, "en", "s", 11), (2, third, "en", "s", 11),
            (3, one, "en", "s", 11), (4, None, "en", "s", 0), (4, "", "en", "s", 0), (None, one, "en", "s", 11)]
    kept = corpus_pipeline.keep_one_of_each_group(spark, frame(spark, rows, extra=True), SF_DIR).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([rows[0], rows[2], rows[4], rows[6], rows[7], rows[8]], key=str)
