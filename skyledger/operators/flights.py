"""Historical flights: cleaning, deduplication and delay statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.predicates import present
from ..schemas import MIN_SAMPLE, ON_TIME_MINUTES, FlightColumns


def to_double(name: str, strict: bool = False) -> Column:
    """Text to double: bad text becomes NULL, or fails the job when ``strict``."""
    return F.col(name).cast("double") if strict else F.col(name).try_cast("double")


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key.

    ``row_number() = 1`` lets Spark keep one row per key in every map task before the shuffle,
    so a key that holds a large share of the rows sends one row per task.
    """
    window = W.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def dedup_flights(
    df: DataFrame,
    columns: FlightColumns = FlightColumns(),
    key: Sequence[str] | None = None,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """One row per day, carrier, origin and destination.

    The kept row is the one with the smallest arrival delay, then the smallest cancel flag, then
    the smallest remaining columns, so the result does not depend on how the input is split. The
    default key carries no flight number and so merges several flights of one day; pass a longer
    ``key`` to keep them apart.
    """
    key = list(key or columns.dedup_key)
    leading = [columns.arr_delay, columns.cancelled]
    order = list(order or leading + [name for name in df.columns if name not in leading])
    ranking = [F.col(name).asc_nulls_last() for name in order if name not in key]
    return keep_first(df, key, ranking)


def clean_flights(
    df: DataFrame,
    columns: FlightColumns = FlightColumns(),
    key: Sequence[str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Rows with carrier, origin and destination, deduplicated, delay and cancel flag as doubles.

    A missing cancel flag counts as not cancelled. Select only the columns needed downstream
    before calling this: deduplication orders by every column it is given.
    """
    typed = present(df, columns.carrier, columns.origin, columns.dest).withColumns(
        {
            columns.arr_delay: to_double(columns.arr_delay, strict),
            columns.cancelled: to_double(columns.cancelled, strict),
        }
    )
    return dedup_flights(typed, columns, key).withColumn(
        columns.cancelled, F.coalesce(columns.cancelled, F.lit(0.0))
    )


def delay_stats(
    cleaned: DataFrame,
    columns: FlightColumns = FlightColumns(),
    on_time_minutes: float = ON_TIME_MINUTES,
    min_sample: int = MIN_SAMPLE,
) -> DataFrame:
    """Average delay and on-time share of the flights flown, by route and carrier.

    A flight without a delay counts in ``sample_size`` but not in the averages.
    """
    delay = F.col(columns.arr_delay)
    on_time = (delay <= on_time_minutes).cast("int")
    return (
        cleaned.filter(F.col(columns.cancelled) == 0.0)
        .groupBy(
            F.concat_ws("-", columns.origin, columns.dest).alias("route"),
            F.col(columns.carrier).alias("carrier"),
        )
        .agg(
            F.round(F.avg(delay), 1).alias("avg_delay_minutes"),
            F.round(F.avg(on_time) * 100, 1).alias("on_time_pct"),
            F.count(F.lit(1)).cast("int").alias("sample_size"),
        )
        .filter(F.col("sample_size") >= min_sample)
    )


def file_coverage(df: DataFrame) -> DataFrame:
    """Rows per source file."""
    return df.groupBy("source_file").agg(F.count(F.lit(1)).alias("row_count"))


def coverage_check(coverage: DataFrame, expected: int = 12) -> DataFrame:
    """One row: number of files and rows, and whether the number of files is the expected one.

    Rows whose file is not known count as rows only.
    """
    return coverage.agg(
        F.count("source_file").alias("file_count"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count")
    ).withColumn("complete", F.col("file_count") == expected)
