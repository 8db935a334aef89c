from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.operators import retrieval
from skyledger.operators.retrieval import embed_chunks, fit_embedder, sync_index, topk_similar
from skyledger.plans import registry
from skyledger.plans.documents import search_chunks

CHUNKS = "chunk_id string, source_document string, section string, chunk_text string"


def brute_topk(queries, corpus, k):
    found = set()
    for query_id, query in queries:
        scored = []
        for row_id, vector in corpus:
            if vector is None:
                continue
            length = np.linalg.norm(query) * np.linalg.norm(vector)
            scored.append((-round(float(np.dot(query, vector) / length), 6) if length else 0.0, row_id))
        found |= {(query_id, row_id, position) for position, (_, row_id) in enumerate(sorted(scored)[:k], 1)}
    return found


@pytest.fixture(scope="module")
def vectors():
    draw = random.Random(1)
    vector = lambda: [float(draw.randrange(-3, 4)) for _ in range(6)]
    corpus = [(f"c{i:03}", vector()) for i in range(150)]
    copy = vector()
    corpus += [(f"copy{i:03}", copy) for i in range(90)] + [("zero", [0.0] * 6), ("none", None)]
    return [(i, vector()) for i in range(25)] + [(99, copy)], corpus


@pytest.mark.parametrize("block", [1024, 7])
def test_topk_matches_brute_force(spark, vectors, block, monkeypatch):
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", block)
    queries, corpus = vectors
    found = topk_similar(
        spark.createDataFrame(queries, "query_id int, embedding array<double>").repartition(3),
        spark.createDataFrame(corpus, "chunk_id string, embedding array<float>").repartition(6),
        k=8,
    )
    rows = found.collect()
    assert len(rows) == len(queries) * 8
    assert {(r.query_id, r.chunk_id, r.position) for r in rows} == brute_topk(queries, corpus, 8)


def test_topk_edges(spark):
    corpus = spark.createDataFrame([("a", "doc", [1.0, 0.0]), ("b", "doc", [0.0, 1.0])], "chunk_id string, source_document string, embedding array<float>")
    none = spark.createDataFrame([(1, None)], "query_id int, embedding array<double>")
    assert topk_similar(none, corpus).count() == 0
    asked = spark.createDataFrame([(1, [1.0, 0.5])], "query_id int, embedding array<double>")
    hits = topk_similar(asked, corpus, k=9, payload=["source_document"]).orderBy("position").collect()
    assert [(h.chunk_id, h.source_document) for h in hits] == [("a", "doc"), ("b", "doc")]
    with pytest.raises(Exception, match="3 values"):
        topk_similar(spark.createDataFrame([(1, [1.0, 0.5, 2.0])], "query_id int, embedding array<double>"), corpus).collect()


@pytest.fixture(scope="module")
def chunks(spark):
    texts = ["refund for a cancelled flight", "lost baggage claim", "boarding with a pet", "seat upgrade rules", ""]
    return spark.createDataFrame([(f"d::chunk_{i}", "d", f"s{i}", text) for i, text in enumerate(texts)], CHUNKS)


def test_lexical_search_cites_document_and_section(spark, chunks):
    embedder = fit_embedder(chunks)
    index = embed_chunks(chunks, embedder)
    assert index.filter((F.size("embedding") != 256)).count() == 0
    questions = spark.createDataFrame([(1, "Is there a REFUND, cancelled flight?"), (2, "my baggage is lost")], "query_id int, text string")
    best = {r.query_id: r for r in search_chunks(questions, index, embedder, k=2).filter("position = 1").collect()}
    assert (best[1].section, best[2].section, best[1].source_document) == ("s0", "s1", "d")


def test_sync_embeds_only_what_changed(spark, chunks):
    embedder = fit_embedder(chunks)
    new = chunks.filter("chunk_id <> 'd::chunk_4'").withColumn(
        "chunk_text", F.when(F.col("section") == "s1", "new baggage text").otherwise(F.col("chunk_text"))
    ).unionByName(spark.createDataFrame([("e::chunk_0", "e", "s", "another document")], CHUNKS))
    embedded = []

    def embed(changed):
        embedded.extend(row.chunk_id for row in changed.collect())
        return embed_chunks(changed, embedder)

    synced = sync_index(embed_chunks(chunks, embedder), chunks, new, embed)
    assert sorted(embedded) == ["d::chunk_1", "e::chunk_0"]
    rows = lambda df: sorted((r.chunk_id, r.chunk_text, r.embedding) for r in df.collect())
    assert rows(synced) == rows(embed_chunks(new, embedder))


def murmur3(data: bytes, seed: int = 42) -> int:
    """The 32-bit hash by which words get their dimension, signed."""
    mask, h = 0xFFFFFFFF, seed

    def mixed(k):
        k = k * 0xCC9E2D51 & mask
        return ((k << 15 | k >> 17) & mask) * 0x1B873593 & mask

    whole = len(data) // 4 * 4
    for at in range(0, whole, 4):
        h ^= mixed(int.from_bytes(data[at : at + 4], "little"))
        h = ((h << 13 | h >> 19) & mask) * 5 + 0xE6546B64 & mask
    if data[whole:]:
        h ^= mixed(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ h >> shift) * factor & mask
    return h - (1 << 32) if h >> 31 else h


def brute_vectors(texts, fitted, dimensions):
    counts = lambda text: np.bincount([murmur3(word.encode()) % dimensions for word in re.findall(r"[^\W_]+", (text or "").lower())] or [0],
                                      minlength=dimensions) * (1 if re.search(r"[^\W_]", text or "") else 0)
    found = np.array([counts(text) for text in fitted])
    rarity = np.log((len(fitted) + 1) / ((found > 0).sum(axis=0) + 1))
    vectors = np.array([counts(text) for text in texts]) * rarity
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, lengths, out=np.zeros_like(vectors), where=lengths > 0)


def test_vectors_are_weighted_word_counts(spark):
    draw = random.Random(8)
    words = ["flight", "Delay", "é", "日本", "gate", "a", "x1", "under_score", "longerwordthanfour", "bc", "bcd"]
    texts = [" ".join(draw.choice(words) + draw.choice(["", ",", " --"]) for _ in range(draw.randint(0, 30))) for _ in range(60)] + [None, "", "...", "never seen"]
    fitted = texts[:50]
    frame = lambda some: spark.createDataFrame([(str(n), "d", "s", text) for n, text in enumerate(some)], CHUNKS)
    for dimensions in (16, 256):
        embedder = fit_embedder(frame(fitted), dimensions)
        rows = embed_chunks(frame(texts), embedder).collect()
        found = np.array([row.embedding for row in sorted(rows, key=lambda row: int(row.chunk_id))])
        assert np.allclose(found, brute_vectors(texts, fitted, dimensions), atol=1e-6)


def test_answers_of_the_query_are_those_of_brute_force(spark):
    """Vectors, cosines and ranks of the search over the test tables, from the texts alone."""
    folder = "/root/testdata/sf0.001"
    chunks = registry.document_section_chunks(spark, folder).orderBy("chunk_id").collect()
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    found = {(row.query_id, row.chunk_id): row.similarity for row in registry.answer_benchmark_items(spark, folder).collect()}
    texts = [row.chunk_text for row in chunks]
    vectors = brute_vectors(texts, texts, 256)
    asked = brute_vectors([row.text for row in items], texts, 256)
    scores = asked @ vectors.T
    place = {row.chunk_id: n for n, row in enumerate(chunks)}
    for number, item in enumerate(items):
        mine = {chunk: score for (query, chunk), score in found.items() if query == item.item_id}
        best = sorted(scores[number], reverse=True)[: len(mine)]
        assert mine and np.allclose(sorted(mine.values(), reverse=True), best, atol=2e-5)
        assert all(abs(scores[number, place[chunk]] - score) < 2e-5 for chunk, score in mine.items())
