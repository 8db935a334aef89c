"""Exact nearest rows in a corpus that is kept in clusters, most of which a query need not see.

Unit vectors are dealt to the nearest of a bounded set of pivots, and keep their distance from it. By
the triangle inequality a row is no nearer to a query than the difference of their distances from the
pivot. So clusters that lie too far away are not read, and of the others only a ring is multiplied.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import work_dir
from .retrieval import QUERY_BLOCK, SIMILARITY_DIGITS, comparable, keep_best, matrix, rank_within, unit_rows

# Rows of the corpus that serve as pivots, at most; they and their rings are held by the driver.
PIVOTS = 256
# Half a unit of the last digit on both sides, and what double precision may lose.
SLACK = 2 * 10.0**-SIMILARITY_DIGITS
# The cluster of zero vectors, which have no direction.
NOWHERE = -1
CLUSTER = "_cluster"


def build_clusters(corpus: DataFrame, folder: str, corpus_id: str = "chunk_id", pivots: int = PIVOTS) -> None:
    """Write the comparable rows of ``corpus`` (id and ``embedding``) in clusters below ``folder``.

    Pivots are the ``pivots`` rows of least hash: any choice gives the same answers, a poor one reads
    more. Every row is written to its cluster; a large cluster has several files.
    """
    spark = corpus.sparkSession
    rows = comparable(corpus.select(F.col(corpus_id).alias("id"), "embedding"))
    some = rows.orderBy(F.xxhash64("embedding"), "id").select("embedding").limit(pivots).collect()
    chosen = unit_rows(np.array([row[0] for row in some], dtype=np.float64)) if some else np.zeros((0, 0))
    chosen = np.unique(chosen[np.any(chosen != 0, axis=1)], axis=0) if some else chosen
    shared = spark.sparkContext.broadcast(chosen)
    # The identifier keeps its type.
    kind = rows.schema["id"]
    schema = T.StructType([kind, T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("distance", T.DoubleType()), T.StructField(CLUSTER, T.IntegerType())])
    id_type = to_arrow_type(kind.dataType)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = unit_rows(matrix(batch.column("embedding"), len(batch.column("embedding")[0])))
            zero = ~np.any(vectors != 0, axis=1)
            if len(held):
                close = vectors @ held.T
                cluster = close.argmax(axis=1)
                # From the difference: near the pivot, 2 - 2 cos would lose half the digits.
                distance = np.linalg.norm(vectors - held[cluster], axis=1)
            else:
                cluster, distance = np.zeros(len(vectors), dtype=np.int64), np.zeros(len(vectors))
            cluster = np.where(zero, NOWHERE, cluster)
            lists = pa.ListArray.from_arrays(np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1], vectors.ravel())
            yield pa.record_batch([batch.column("id").cast(id_type), lists, pa.array(distance), pa.array(cluster.astype(np.int32))], names=schema.names)

    placed = rows.mapInArrow(assign, schema)
    # A file without rows keeps the schema, also of an empty corpus.
    spark.createDataFrame([], schema).write.parquet(f"{folder}/schema")
    placed.write.partitionBy(CLUSTER).parquet(f"{folder}/rows")
    held = spark.read.schema(schema).parquet(f"{folder}/rows")
    rings = held.groupBy(CLUSTER).agg(F.count("*").alias("rows"), F.min("distance").alias("low"), F.max("distance").alias("high"))
    rings.coalesce(1).write.parquet(f"{folder}/rings")
    spark.createDataFrame([(number, row.tolist()) for number, row in enumerate(chosen)], f"{CLUSTER} int, pivot array<double>").coalesce(1).write.parquet(f"{folder}/pivots")
    shared.destroy()


class ClusteredCorpus:
    """A corpus written by ``build_clusters``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.rows = spark.read.schema(spark.read.parquet(f"{folder}/schema").schema).parquet(f"{folder}/rows")
        rings = {row[CLUSTER]: row for row in spark.read.parquet(f"{folder}/rings").collect()}
        self.zeros = NOWHERE in rings
        self.clusters = sorted(cluster for cluster in rings if cluster != NOWHERE)
        pivots = {row[CLUSTER]: row.pivot for row in spark.read.parquet(f"{folder}/pivots").collect()}
        self.pivots = np.array([pivots[cluster] for cluster in self.clusters], dtype=np.float64)
        self.low, self.high, self.count = (np.array([rings[cluster][name] for cluster in self.clusters]) for name in ("low", "high", "rows"))

    def _pass(self, queries: np.ndarray, near: np.ndarray, wanted: np.ndarray, limits: np.ndarray, zeros: bool, k: int, scored) -> DataFrame:
        """The best rows of the clusters that each query wants, at most ``limits`` away from it.

        Clusters that no query wants are not read.
        """
        spark = self.rows.sparkSession
        asked = {cluster: np.flatnonzero(wanted[:, place]) for place, cluster in enumerate(self.clusters)}
        asked = {cluster: which for cluster, which in asked.items() if len(which)}
        if zeros:
            asked[NOWHERE] = np.arange(len(queries))
        place_of = {cluster: place for place, cluster in enumerate(self.clusters)}
        shared = spark.sparkContext.broadcast((queries, near, asked, place_of, limits))
        id_field = self.rows.schema["id"]
        output = T.StructType([T.StructField("query", T.IntegerType()), id_field, T.StructField("similarity", T.DoubleType())])
        id_type = to_arrow_type(id_field.dataType)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            queries, near, asked, place_of, limits = shared.value
            best: list[np.ndarray] = []
            for batch in batches:
                clusters = batch.column(CLUSTER).to_numpy(zero_copy_only=False)
                ids = batch.column("id").to_numpy(zero_copy_only=False)
                distances = batch.column("distance").to_numpy(zero_copy_only=False)
                vectors = matrix(batch.column("embedding"), queries.shape[1]) if batch.num_rows else None
                for cluster in np.unique(clusters):
                    which, mine = asked[cluster], clusters == cluster
                    if cluster == NOWHERE:
                        sight = np.ones((len(which), mine.sum()), dtype=bool)
                    else:
                        sight = np.abs(near[which, place_of[cluster]][:, None] - distances[mine]) <= limits[which, None]
                    rows = np.flatnonzero(sight.any(axis=0))
                    some = np.flatnonzero(sight.any(axis=1))
                    if not len(rows):
                        continue
                    places = np.flatnonzero(mine)[rows]
                    scored.add(int(len(some) * len(rows)))
                    scores = np.round(queries[which[some]] @ vectors[places].T, SIMILARITY_DIGITS)
                    cut = min(k, len(rows))
                    floors = np.partition(scores, len(rows) - cut, axis=1)[:, len(rows) - cut]
                    query, row = np.nonzero(scores >= floors[:, None])
                    found = [which[some][query], scores[query, row], ids[places[row]]]
                    best = keep_best([np.concatenate(pair) for pair in zip(best, found)] if best else found, k)
            if best:
                query, score, ids = best
                yield pa.record_batch([pa.array(query.astype(np.int32)), pa.array(ids, type=id_type), pa.array(score)], names=output.names)

        return self.rows.filter(F.col(CLUSTER).isin([int(cluster) for cluster in asked])).mapInArrow(search, output)

    def topk(self, queries: DataFrame, k: int = 5, query_id: str = "query_id", corpus_id: str = "chunk_id") -> tuple[DataFrame, int]:
        """As ``topk_similar``: the ``k`` rows of largest cosine, exact; and how many cosines were taken.

        Queries are taken in blocks of about ``QUERY_BLOCK``. A first pass reads the clusters around each
        query that hold ``k`` rows between them, which bounds how far its answers can be; a second one the
        further clusters whose rings reach into that bound.
        """
        spark = self.rows.sparkSession
        folder = work_dir(spark, "clustered")
        field = queries.schema[query_id]
        comparable(queries.select(query_id, "embedding")).write.parquet(f"{folder}/queries")
        asked = spark.read.schema(queries.select(query_id, "embedding").schema).parquet(f"{folder}/queries")
        scored = spark.sparkContext.accumulator(0)
        output = T.StructType([field, T.StructField(corpus_id, self.rows.schema["id"].dataType), T.StructField("similarity", T.DoubleType())])
        found = spark.createDataFrame([], output)
        blocks = -(-asked.count() // QUERY_BLOCK)
        for number in range(blocks):
            block = asked.filter(F.pmod(F.xxhash64(query_id, "embedding"), F.lit(blocks)) == number).collect()
            if block:
                hits = self._search(block, k, scored, f"{folder}/hits/block={number}")
                names = spark.createDataFrame([(place, row[0]) for place, row in enumerate(block)], T.StructType([T.StructField("query", T.IntegerType()), field]))
                found = found.unionByName(hits.join(names, "query").select(query_id, F.col("id").alias(corpus_id), "similarity"))
        return rank_within(found, query_id, [F.desc("similarity"), F.asc(corpus_id)], k), scored.value

    def _search(self, block: Sequence, k: int, scored, folder: str) -> DataFrame:
        spark = self.rows.sparkSession
        queries = unit_rows(np.array([row[1] for row in block], dtype=np.float64))
        zero = ~np.any(queries != 0, axis=1)
        near = np.array([np.linalg.norm(self.pivots - query, axis=1) if len(self.clusters) else np.zeros(0) for query in queries])
        # The least number of nearest clusters that hold k rows.
        order = np.argsort(near, axis=1, kind="stable")
        counts = self.count[order] if len(self.clusters) else near
        first = np.zeros(near.shape, dtype=bool)
        np.put_along_axis(first, order, np.cumsum(counts, axis=1) - counts < k, axis=1)
        everything = np.full(len(block), np.inf)
        around = self._pass(queries, near, first, everything, self.zeros, k, scored)
        around.write.parquet(f"{folder}/first")
        hits = spark.read.schema(around.schema).parquet(f"{folder}/first")
        # The k-th similarity so far bounds the distance of what may still come before it.
        ranked = rank_within(hits, "query", [F.desc("similarity"), F.asc("id")], k).filter(F.col("position") == k)
        limits = everything.copy()
        for row in ranked.select("query", "similarity").collect():
            limits[row.query] = np.sqrt(max(0.0, 2 - 2 * (row.similarity - SLACK))) + 1e-9
        limits[zero] = np.inf
        gap = np.maximum(near - self.high, self.low - near) if len(self.clusters) else near
        second = (gap <= limits[:, None]) & ~first
        if second.any():
            rest = self._pass(queries, near, second, limits, False, k, scored)
            rest.write.parquet(f"{folder}/second")
            hits = hits.unionByName(spark.read.schema(around.schema).parquet(f"{folder}/second"))
        return hits
