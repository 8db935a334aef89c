"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector is centred, scaled to length 1, rotated at random, and stored as the signs of its components
with two scalars: its length, and the share of it that the signs keep. Signs and scalars estimate the
inner product with a query without bias, and bound the error; only vectors whose bound reaches the
best found so far are reranked with the vectors themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.tables import stored
from skyledger.llm.textscan import thrifty
from skyledger.llm.vectors import matrix, usable_rows

# Standard deviations of the estimate that a vector must miss by to be passed over.
CONFIDENCE = 3.0
# Vectors and queries whose estimates are made at a time, and pairs that are measured at a time.
CHUNK = 1024
QUERIES = 512
PAIRS = 4096
# Where more than one pair in so many is open, a matrix product tells first which ones are far.
FEW = 64


def rotation(length: int, seed: int) -> np.ndarray:
    """A random rotation of the space, padded to whole bytes of signs."""
    size = -(-length // 8) * 8
    turned, triangle = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))
    return (turned * np.sign(np.diag(triangle)))[:, :length]


def build_index(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", seed: int = 7) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The stored codes (id, vector, signs, norm, share) of all usable rows, the centre, the rotation."""
    sound, length = usable_rows(rows, id, vector)
    sound = sound.dropDuplicates(["id", "vector"])
    means = [F.avg(F.col("vector")[place].cast("double")).alias(f"m{place}") for place in range(length)]
    centre = np.array([value or 0.0 for value in (sound.agg(*means).first() if length else ())], dtype=float)
    turn = rotation(length, seed) if length else np.zeros((0, 0))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away = matrix(batch.column("vector"), length) - centre
            norm = np.sqrt((away**2).sum(axis=1))
            turned = away @ turn.T
            signs = np.packbits(turned > 0, axis=1)
            share = np.abs(turned).sum(axis=1) / np.sqrt(len(turn)) / np.where(norm > 0, norm, 1)
            packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(signs.shape[1]), len(signs), [None, pa.py_buffer(np.ascontiguousarray(signs))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"), packed.cast(pa.binary()), pa.array(norm), pa.array(np.where(norm > 0, share, 1.0))],
                names=["id", "vector", "signs", "norm", "share"],
            )

    kind = dict(sound.dtypes)["vector"]
    schema = f"id long, vector {kind}, signs binary, norm double, share double"
    return stored(sound.mapInArrow(thrifty(encode), schema) if length else sound.selectExpr("id", "vector", "binary('') signs", "0d norm", "1d share"), "codes"), centre, turn


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance of rows in pairs, components added in order."""
    total = np.zeros(len(a))
    for place in range(a.shape[1]):
        total += (a[:, place] - b[:, place]) ** 2
    return np.sqrt(total)


def within(queries: np.ndarray, vectors: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """False for pairs of query and row that are farther apart than the query's ``reach`` for certain."""
    # The product is off by far less than the share of the sizes taken off here. What overflows stays in.
    from_query = (queries**2).sum(axis=1) * (1 - 1e-9) - reach**2 * (1 + 1e-9)
    from_row = (vectors**2).sum(axis=1) * (1 - 1e-9)
    return ~(queries @ vectors.T < (from_query / 2)[:, None] + from_row / 2)


def search_batch(sent, centre: np.ndarray, turn: np.ndarray, k: int):
    """The k nearest rows of a task for each query of a block: (query_id, vec_id, score)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = sent.value
        length, size = queries.shape[1], len(turn)
        away = queries - centre
        query_norm = np.sqrt((away**2).sum(axis=1))
        turned = np.column_stack((away @ turn.T / np.sqrt(size), query_norm)).astype(np.float32)
        best_score = np.full((len(queries), k), np.inf)
        best_id = np.zeros((len(queries), k), dtype=np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, CHUNK):
                part = batch.slice(first, CHUNK)
                ids = part.column("id").to_numpy()
                vectors = matrix(part.column("vector"), length)
                norm, share = part.column("norm").to_numpy(), part.column("share").to_numpy()
                packed = np.frombuffer(b"".join(part.column("signs").to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
                signs = np.unpackbits(packed, axis=1).astype(np.float32) * 2 - 1
                error = norm * np.sqrt(np.maximum(1 - share**2, 0)) / share * CONFIDENCE / np.sqrt(max(size - 1, 1))
                scaled = np.column_stack((signs * (norm / share)[:, None].astype(np.float32), error.astype(np.float32))).T
                for start in range(0, len(queries), QUERIES):
                    some = slice(start, start + QUERIES)
                    # Views: what is put among the best of these queries is put among the best of all.
                    score, found = best_score[some], best_id[some]
                    # Estimated squared distance less what it may be off by, for these queries and rows.
                    least = query_norm[some, None] ** 2 + norm**2
                    least -= 2 * (turned[some] @ scaled)
                    if len(ids) > k:
                        # The likeliest ones first: they set a bound that spares most of the others.
                        likely = np.argpartition(least, k, axis=1)[:, :k]
                    else:
                        likely = np.tile(np.arange(len(ids)), (len(least), 1))
                    open_pairs = np.zeros(least.shape, dtype=bool)
                    np.put_along_axis(open_pairs, likely, True, axis=1)
                    rerank(open_pairs, query_ids[some], queries[some], ids, vectors, score, found)
                    rest = (least <= score[:, -1:] ** 2 * (1 + 1e-9)) & ~open_pairs
                    rerank(rest, query_ids[some], queries[some], ids, vectors, score, found)
        row, place = np.nonzero(np.isfinite(best_score))
        yield pa.RecordBatch.from_arrays(
            [pa.array(query_ids[row]), pa.array(best_id[row, place]), pa.array(best_score[row, place])],
            names=["query_id", "vec_id", "score"],
        )

    return scan


def rerank(pairs: np.ndarray, query_ids, queries, ids, vectors, best_score, best_id) -> None:
    """Puts the marked pairs of query and row in their place among the best so far."""
    k = best_score.shape[1]
    if np.count_nonzero(pairs) * FEW > pairs.size:
        pairs = pairs & within(queries, vectors, best_score[:, -1])
    query, row = np.divmod(np.flatnonzero(pairs), pairs.shape[1])
    other = query_ids[query] != ids[row]
    query, row = query[other], row[other]
    if not len(query):
        return
    pieces = [slice(first, first + PAIRS) for first in range(0, len(query), PAIRS)]
    score = np.concatenate([distances(queries[query[piece]], vectors[row[piece]]) for piece in pieces])
    touched = np.unique(query)
    old = np.isfinite(best_score[touched])
    at, place = np.nonzero(old)
    query = np.concatenate((query, touched[at]))
    score = np.concatenate((score, best_score[touched[at], place]))
    found = np.concatenate((ids[row], best_id[touched[at], place]))
    order = np.lexsort((found, score, query))
    query, score, found = query[order], score[order], found[order]
    heads = np.concatenate(([0], np.flatnonzero(query[1:] != query[:-1]) + 1))
    rank = np.arange(len(query)) - np.repeat(heads, np.diff(np.append(heads, len(query))))
    keep = rank < k
    best_score[query[keep], rank[keep]] = score[keep]
    best_id[query[keep], rank[keep]] = found[keep]


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10, id: str = "vec_id", vector: str = "embedding", block: int = 4096) -> DataFrame:
    """The ``k`` nearest rows of each query by Euclidean distance: (query_id, rank, id, score).

    ``queries`` has the columns of ``rows``; a row of the query's own id is no answer. Ties go to the
    smaller id. A query with fewer candidates gets them all. Vectors that are null, empty, zero, of
    an unusual length, or that hold null or non-finite components take no part. Repeated rows count once.
    Different vectors of one id are answers of their own; as queries they share one ranking.
    Blocks of about ``block`` queries visit all codes, one pass after another; each task returns at
    most ``k`` rows per query.
    """
    spark = rows.sparkSession
    index, centre, turn = build_index(rows, id, vector)
    # Tasks as the cores need them, as each returns rows of every query.
    index = index.coalesce(4 * spark.sparkContext.defaultParallelism)
    length = len(centre)
    asked, asked_length = usable_rows(queries, id, vector)
    asked = stored(asked.where(F.size("vector") == length).dropDuplicates(["id", "vector"]), "queries")
    passes = -(-asked.count() // block)
    found = spark.createDataFrame([], "query_id long, vec_id long, score double")
    for number in range(passes):
        chosen = asked.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == number).toArrow()
        if not chosen.num_rows:
            continue
        sent = spark.sparkContext.broadcast((chosen.column("id").to_numpy(), matrix(chosen.column("vector").combine_chunks(), length)))
        hits = stored(index.mapInArrow(thrifty(search_batch(sent, centre, turn, k)), found.schema), "hits")
        sent.destroy()
        found = found.unionByName(hits)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias(id), "score")
