"""Filters whose arguments may be absent."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CHANGE_TYPE, SERVED_TOOL_PREFIX


def matching(df: DataFrame, **wanted: Any) -> DataFrame:
    """Equality filters; an argument of None drops its filter, an empty text is compared."""
    for name, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def matching_given(df: DataFrame, **wanted: Any) -> DataFrame:
    """Equality filters; an argument that is None or empty drops its filter."""
    return matching(df, **{name: None if value == "" else value for name, value in wanted.items()})


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which no given column is NULL, as one filter per column that scans understand."""
    for name in columns:
        df = df.filter(F.col(name).isNotNull())
    return df


def of_change(df: DataFrame, *change_types: str) -> DataFrame:
    """History rows of the given change types."""
    return df.filter(F.col(CHANGE_TYPE).isin(*change_types))


def tool_source(action_type: Column) -> Column:
    """'mcp' for calls served by a tool server, 'custom' for the rest (NULL included)."""
    return F.when(action_type.startswith(SERVED_TOOL_PREFIX), "mcp").otherwise("custom")


def time_bucket(unit: str, at: Column) -> Column:
    """Start of the hour or day, as a timestamp without zone."""
    return F.date_trunc(unit, at).cast("timestamp_ntz")
