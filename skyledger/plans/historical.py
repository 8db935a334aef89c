"""Historical job: CSV files to route and carrier delay statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.lookups import create_lookup_functions
from ..operators.flights import clean_flights, delay_stats
from ..schemas import FlightColumns
from ..sources.csv_flights import scan_flight_csvs
from ..sources.tables import publish_table


def historical_delay_stats(bronze: DataFrame, columns: FlightColumns = FlightColumns(), strict: bool = False) -> DataFrame:
    """Raw flights to delay statistics; only the columns needed reach the shuffles."""
    return delay_stats(clean_flights(bronze.select(*columns.all), columns, strict=strict), columns)


def run_historical_job(
    spark: SparkSession, csv_folder: str, root: str, columns: FlightColumns = FlightColumns(), strict: bool = False
) -> dict[str, str]:
    """Publish ``bts_flights_bronze``, ``bts_flights_cleaned`` and ``flights_historical_enriched``.

    Each step reads the written table of the step before. Returns the path of every version.
    """
    paths = {}

    def publish(name: str, df: DataFrame) -> DataFrame:
        paths[name] = publish_table(df, name, root)
        return spark.read.parquet(paths[name])

    bronze = publish("bts_flights_bronze", scan_flight_csvs(spark, csv_folder))
    cleaned = publish("bts_flights_cleaned", clean_flights(bronze, columns, strict=strict))
    publish("flights_historical_enriched", delay_stats(cleaned, columns))
    create_lookup_functions(spark, delay_stats="flights_historical_enriched")
    return paths
