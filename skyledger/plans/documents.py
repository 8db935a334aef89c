"""Document job: parsed documents to chunks, and chunks to answers."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.chunking import chunk_by_section, flatten_elements
from ..operators.retrieval import embed_chunks, fit_embedder, sync_index, topk_similar
from ..schemas import MAX_CHUNK_WORDS
from ..sources.tables import publish_table


def document_chunks(parsed: DataFrame, max_words: int = MAX_CHUNK_WORDS) -> DataFrame:
    """(path, parsed) to section-aware chunks."""
    return chunk_by_section(flatten_elements(parsed), max_words)


def search_chunks(questions: DataFrame, index: DataFrame, embedder: PipelineModel, k: int = 5) -> DataFrame:
    """The ``k`` chunks nearest to each question (query_id, text), with document and section."""
    asked = embed_chunks(questions.withColumn("chunk_text", F.col("text")), embedder)
    return topk_similar(asked, index, k, payload=["source_document", "section"])


def run_document_job(
    spark: SparkSession,
    parsed: DataFrame,
    root: str,
    previous: dict[str, str] | None = None,
    max_words: int = MAX_CHUNK_WORDS,
) -> dict[str, str]:
    """Publish ``document_elements``, ``rag_document_chunks_published`` and their index.

    With the paths of a ``previous`` run only new and changed chunks are embedded, by the model of
    that run, which is kept next to the index. Returns the paths of this run.
    """
    paths = {}

    def publish(name: str, df: DataFrame) -> DataFrame:
        paths[name] = publish_table(df, name, root)
        return spark.read.parquet(paths[name])

    elements = publish("document_elements", flatten_elements(parsed))
    chunks = publish("rag_document_chunks_published", chunk_by_section(elements, max_words))
    if previous:
        paths["embedder"] = previous["embedder"]
        embedder = PipelineModel.load(paths["embedder"])
        index = sync_index(
            spark.read.parquet(previous["rag_document_chunks_index"]),
            spark.read.parquet(previous["rag_document_chunks_published"]),
            chunks,
            lambda changed: embed_chunks(changed, embedder),
        )
    else:
        embedder = fit_embedder(chunks)
        paths["embedder"] = f"{paths['rag_document_chunks_published']}-embedder"
        embedder.write().save(paths["embedder"])
        index = embed_chunks(chunks, embedder)
    publish("rag_document_chunks_index", index)
    return paths
