"""Table writes: append, publish by version, and the changes between two versions."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import conform

# Bounds a micro-batch, so that a stream started on a large backlog reads it piece by piece.
FILES_PER_BATCH = 1000


def append_table(
    df: DataFrame, table: str, schema: T.StructType, partition_by: Sequence[str] = (), path: str | None = None
) -> None:
    """Append rows of a declared schema to a table, which lies in the warehouse or at ``path``."""
    writer = conform(df, schema).write.mode("append")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def read_landing_stream(spark: SparkSession, table: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Unbounded read of a table that other jobs append to."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).table(table)


def read_folder_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    files_per_batch: int = FILES_PER_BATCH,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Unbounded read of a folder of parquet files, which may be partitioned by ``partition_by``.

    A stream binds the columns of its batches by position, and a batch has the partition columns
    last, so the schema must have them last as well.
    """
    fields = sorted(schema.fields, key=lambda field: field.name in partition_by)
    reader = spark.readStream.schema(T.StructType(fields)).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def publish_table(df: DataFrame, view: str, root: str, temporary: bool = False) -> str:
    """Write a full copy as a new version below ``root``, then point ``view`` at it.

    Readers see the old version until the write has finished, and old versions stay readable for
    ``change_feed``. Returns the path of the version.
    """
    version = f"{root.rstrip('/')}/{view}/v{time.time_ns()}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(version)
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    df.sparkSession.sql(f"CREATE OR REPLACE {kind} {view} AS SELECT * FROM parquet.`{version}`")
    return version


def change_feed(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Row-level changes between two versions of a table whose ``key`` is unique.

    ``_change_type`` is insert, delete, update_preimage or update_postimage; an unchanged row
    gives nothing.
    """
    key = list(key)
    payload = [name for name in new.columns if name not in key]
    old_side = old.select(*key, F.struct(*payload).alias("_old"))
    new_side = new.select(*key, F.struct(*payload).alias("_new"))

    def image(kind: str, side: str):
        return F.struct(F.lit(kind).alias("kind"), F.col(side).alias("row"))

    changes = (
        F.when(F.col("_old").isNull(), F.array(image("insert", "_new")))
        .when(F.col("_new").isNull(), F.array(image("delete", "_old")))
        .otherwise(F.array(image("update_preimage", "_old"), image("update_postimage", "_new")))
    )
    return (
        old_side.join(new_side, key, "full_outer")
        .filter(~F.col("_old").eqNullSafe(F.col("_new")))
        .select(*key, F.explode(changes).alias("_change"))
        .select(*key, *[F.col(f"_change.row.{name}").alias(name) for name in payload],
                F.col("_change.kind").alias("_change_type"))
    )
