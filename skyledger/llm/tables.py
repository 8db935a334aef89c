"""Tables written on the way, in the shared folder, so that later steps and lost tasks read them again."""

from __future__ import annotations

from pyspark.sql import DataFrame

from skyledger.session import work_dir


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Writes ``df`` below ``spark.checkpoint.dir`` and reads it back: the lineage ends there."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
