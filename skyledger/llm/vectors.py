"""Vectors in tables: which ones can be compared, and their way into numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """True for a vector that is not null or empty, holds finite numbers only and is not zero."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def usable_rows(rows: DataFrame, id: str, vector: str) -> tuple[DataFrame, int]:
    """(id, vector) of comparable vectors of non-null id, and their common length.

    Vectors of another length than the most frequent one take no part.
    """
    sound = rows.where(usable(vector) & F.col(id).isNotNull()).select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"))
    size = sound.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    length = size["size"] if size else 0
    return sound.where(F.size("vector") == length), length


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """The vectors of a column as rows in double precision."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)
