"""Chunk embeddings, nearest chunks, and index upkeep."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import work_dir
from ..sources.tables import change_feed

SIMILARITY_DIGITS = 6
QUERY_BLOCK = 1024


def fit_embedder(chunks: DataFrame, dimensions: int = 256) -> PipelineModel:
    """Fit a lexical embedder on ``chunk_text``: hashed word counts, weighted by rarity, unit length.

    It stands in for a hosted model and matches words, not meaning.
    """
    stages = [
        RegexTokenizer(inputCol="chunk_text", outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dimensions),
        IDF(inputCol="_counts", outputCol="_weighted"),
        Normalizer(inputCol="_weighted", outputCol="_vector"),
    ]
    return Pipeline(stages=stages).fit(chunks.select(F.coalesce("chunk_text", F.lit("")).alias("chunk_text")))


def embed_chunks(chunks: DataFrame, embedder: PipelineModel) -> DataFrame:
    """Rows with an ``embedding`` column made from ``chunk_text``; no shuffle."""
    filled = chunks.withColumn("chunk_text", F.coalesce("chunk_text", F.lit("")))
    vectors = embedder.transform(filled)
    return vectors.select(*chunks.columns, vector_to_array("_vector", "float32").alias("embedding"))


def unit_rows(values: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(values, axis=1, keepdims=True)
    return np.divide(values, lengths, out=np.zeros_like(values), where=lengths > 0)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if flat.size != len(column) * width:
        raise ValueError(f"every embedding must have {width} values")
    return flat.reshape(-1, width)


def _search_block(
    block: Sequence[tuple], corpus: DataFrame, query_field: T.StructField, id_field: T.StructField, k: int
) -> tuple[DataFrame, Broadcast]:
    """Nearest corpus rows of a block of queries, and the broadcast to destroy afterwards.

    The queries travel as one matrix of bounded size. Every task multiplies its rows with it and
    keeps ``k`` rows per query, so the final ranking sees ``k`` rows per query and task.
    """
    spark = corpus.sparkSession
    width = len(block[0][1])
    shared = spark.sparkContext.broadcast(
        ([row[0] for row in block], unit_rows(np.array([row[1] for row in block], dtype=np.float64)))
    )
    output = T.StructType([query_field, id_field, T.StructField("similarity", T.DoubleType())])
    id_name, names = id_field.name, output.names
    output_types = [to_arrow_type(field.dataType) for field in output.fields]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = shared.value
        best: list[np.ndarray] = []  # query, similarity and id of the best rows so far
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = unit_rows(matrix(batch.column("embedding"), width))
            scores = np.round(queries @ rows.T, SIMILARITY_DIGITS)
            cut = min(k, rows.shape[0])
            floors = np.partition(scores, rows.shape[0] - cut, axis=1)[:, rows.shape[0] - cut]
            query, row = np.nonzero(scores >= floors[:, None])
            ids = batch.column(id_name).to_numpy(zero_copy_only=False)
            found = [query, scores[query, row], ids[row]]
            best = keep_best([np.concatenate(pair) for pair in zip(best, found)] if best else found, k)
        if best:
            query, score, ids = best
            columns = [[query_ids[place] for place in query], score, ids]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, type=kind) for values, kind in zip([columns[0], columns[2], columns[1]], output_types)],
                names=names,
            )

    return corpus.select(id_name, "embedding").mapInArrow(search, output), shared


def keep_best(found: list[np.ndarray], k: int) -> list[np.ndarray]:
    """The first ``k`` of each query by similarity, then id."""
    query, score, ids = found
    order = np.lexsort((np.unique(ids, return_inverse=True)[1], -score, query))
    query = query[order]
    heads = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1])))
    rank = np.arange(len(query)) - np.repeat(heads, np.diff(np.append(heads, len(query))))
    return [values[order[rank < k]] for values in found]


def comparable(rows: DataFrame) -> DataFrame:
    """Rows whose embedding is there and holds numbers only."""
    sound = F.forall("embedding", lambda value: value.isNotNull() & ~F.isnan(value))
    return rows.filter(F.col("embedding").isNotNull() & sound)


def topk_similar(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    query_id: str = "query_id",
    corpus_id: str = "chunk_id",
    payload: Sequence[str] = (),
) -> DataFrame:
    """The ``k`` corpus rows with the largest cosine to each query, exact, ties by ``corpus_id``.

    Both sides have an ``embedding`` array column; the cosine is rounded to six digits before it
    is ranked, and is 0 for a zero vector. Rows without an embedding, or with a missing or undefined
    number in it, are not compared. ``payload`` columns of the corpus (source document, section) come
    back with each hit, next to ``position``.

    Up to ``QUERY_BLOCK`` queries make one pass over the corpus. More are dealt to blocks of about that
    many, however they were partitioned; then the corpus vectors are written once, each block makes one
    pass over them, and its hits are written, too.
    """
    spark = corpus.sparkSession
    query_field, id_field = queries.schema[query_id], corpus.schema[corpus_id]
    near = spark.createDataFrame([], T.StructType([query_field, id_field, T.StructField("similarity", T.DoubleType())]))
    asked, vectors = comparable(queries.select(query_id, "embedding")), comparable(corpus.select(corpus_id, "embedding"))
    few = asked.limit(QUERY_BLOCK + 1).collect()
    passes = 0
    if 0 < len(few) <= QUERY_BLOCK:
        near, _ = _search_block(few, vectors, query_field, id_field, k)
    elif few:
        folder = work_dir(spark, "nearest")
        asked.write.parquet(f"{folder}/queries")
        vectors.write.parquet(f"{folder}/corpus")
        asked = spark.read.schema(asked.schema).parquet(f"{folder}/queries")
        vectors = spark.read.schema(vectors.schema).parquet(f"{folder}/corpus")
        passes = -(-asked.count() // QUERY_BLOCK)
    for number in range(passes):
        block = asked.filter(F.pmod(F.xxhash64(query_id, "embedding"), F.lit(passes)) == number).collect()
        if block:
            hits, shared = _search_block(block, vectors, query_field, id_field, k)
            hits.write.parquet(f"{folder}/hits/block={number}")
            shared.destroy()
            near = near.unionByName(spark.read.schema(near.schema).parquet(f"{folder}/hits/block={number}"))
    order = [F.desc("similarity"), F.asc(corpus_id)]
    hits = rank_within(near, query_id, order, k)
    if payload:
        hits = hits.join(corpus.select(corpus_id, *payload), corpus_id)
    return hits


def rank_within(df: DataFrame, group: str, order: Sequence, k: int) -> DataFrame:
    """The first ``k`` rows of every group, numbered from 1 in ``position``."""
    window = W.partitionBy(group).orderBy(*order)
    return df.withColumn("position", F.row_number().over(window)).filter(F.col("position") <= k)


def sync_index(
    index: DataFrame,
    old_chunks: DataFrame,
    new_chunks: DataFrame,
    embed: Callable[[DataFrame], DataFrame],
    key: str = "chunk_id",
    feed: DataFrame | None = None,
) -> DataFrame:
    """The index after a new version of the chunks: only new and changed chunks are embedded.

    ``feed`` gives the changes where they are known, as from ``version_changes``; else the two versions are
    compared whole.
    """
    # Written once, as its two uses would compare the versions twice.
    spark, folder = index.sparkSession, work_dir(index.sparkSession, "feed")
    feed = change_feed(old_chunks, new_chunks, [key]) if feed is None else feed
    # Of rows that go, nothing but the key is read.
    comes = F.col("_change_type").isin("insert", "update_postimage")
    feed = feed.withColumns({name: F.when(comes, F.col(name)) for name in feed.columns if name not in (key, "_change_type")})
    feed.write.parquet(folder)
    feed = spark.read.schema(feed.schema).parquet(folder)
    gone = feed.filter(F.col("_change_type").isin("delete", "update_preimage")).select(key)
    fresh = feed.filter(comes)
    kept = index.join(gone, key, "left_anti")
    return kept.unionByName(embed(fresh.select(*new_chunks.columns)).select(*index.columns))
