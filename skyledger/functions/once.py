"""Costly expressions, evaluated once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and projections read instead of computing them again.

    The optimizer moves a filter below the projection it refers to, and splits a parsed record into
    one parse per field; both repeat the parsing. A generator of one row stops it.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(row)))
