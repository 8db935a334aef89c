"""Token counts behind a digest cache: every distinct text is encoded once, ever."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.textscan import slices, small_batches, thrifty
from skyledger.llm.tokens import encoder, version_of
from skyledger.operators.joins import own_shuffle
from skyledger.session import work_dir

CACHE_SCHEMA = "digest string, version string, n_tokens long"
# Text encoded at a time; words are looked up once per distinct word of it.
SLICE_BYTES = 4 << 20


def count_tokens(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", cache: str | None = None) -> DataFrame:
    """Token counts of whole texts: (id, n_bytes, n_tokens), one row per row of ``docs``.

    ``tokenizer`` is the path of a tokenizers file; counts are those of the library without added
    special tokens. ``cache`` names a folder of counts by digest of the text and version of the
    tokenizer; texts that it lacks are encoded once per distinct text and appended. Without one, a
    new cache is begun in the shared folder. The normal form under the digest is the text itself,
    null being empty, as any other folding would change counts. Ids may be null or repeat.
    """
    spark = docs.sparkSession
    version = version_of(tokenizer)
    cache = cache or work_dir(spark, "token-counts")
    normal = F.coalesce(F.col(text), F.lit(""))
    keyed = small_batches(docs).select(F.col(id), normal.alias("text"), F.sha2(normal, 256).alias("digest"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                counts = encoder(tokenizer).counts(part.column("text"))
                versions = pa.array(np.full(part.num_rows, version))
                yield pa.RecordBatch.from_arrays(
                    [part.column("digest"), versions, pa.array(counts)], names=["digest", "version", "n_tokens"]
                )

    distinct = keyed.select("digest", "text").dropDuplicates(["digest"])
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("version") == version)
        distinct = distinct.join(stored, "digest", "left_anti")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    distinct.mapInArrow(thrifty(encode), CACHE_SCHEMA).write.mode("append").parquet(cache)
    counts = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("version") == version)
    # Jobs that fill one cache at a time may append a digest twice; both rows hold the same count.
    counts = counts.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return keyed.withColumn("n_bytes", F.octet_length("text").cast("long")).join(own_shuffle(counts, ["digest"]), "digest").select(id, "n_bytes", "n_tokens")
