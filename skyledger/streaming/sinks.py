"""Writing the micro-batches of a stream exactly once where the writer is a function.

Spark's own file sink keeps a manifest of its batches, but takes only what a streaming plan can say. A
function that is called with each micro-batch is called again after a failure, with the same number.
Here every batch gets a folder of its own, named by query and number, that appears whole or not at all;
these folders are the manifest.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.files import file_system, make_folder

BATCH = "batch"


def commit_folder(rows: DataFrame, folder: str, name: str) -> bool:
    """Writes rows as ``folder``/``name`` in one step; False if it is there already, or without rows.

    Rows are written aside, where readers do not look, and moved when they are complete. The move has
    to be atomic, as in HDFS or a local file system. An existing folder is neither read nor changed, and
    no other one is looked at.
    """
    spark = rows.sparkSession
    files, make = file_system(spark, folder)
    target = make(f"{folder}/{name}")
    if files.exists(target):
        return False
    aside = f"{folder}/_aside/{name}-{uuid.uuid4().hex}"
    written = Observation()
    rows.observe(written, F.count(F.lit(1)).alias("rows")).write.parquet(aside)
    if not written.get["rows"] or not files.rename(make(aside), target):
        files.delete(make(aside), True)
        return False
    return True


def batch_sink(folder: str, rows_of: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch`` that commits ``rows_of`` each micro-batch below ``folder`` once.

    A batch that was written before a failure is not computed again after it. The number of a batch
    counts within its query, so a query with a new checkpoint writes beside the old one.
    """

    def write(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        commit_folder(rows_of(batch), folder.rstrip("/"), f"{BATCH}={query}-{number}")

    return write


def committed(spark: SparkSession, folder: str, schema) -> DataFrame:
    """All committed rows of a ``batch_sink``."""
    make_folder(spark, folder)
    fields = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return spark.read.schema(f"{fields}, {BATCH} string").parquet(folder).drop(BATCH)
