"""Parameterised lookups as SQL table functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..schemas import DELAY_STATS, FLIGHT_STATUS


def _names(ddl: str) -> str:
    return ", ".join(field.split()[0] for field in ddl.split(", "))


def create_lookup_functions(
    spark: SparkSession,
    delay_stats: str | None = None,
    flight_status: str | None = None,
    temporary: bool = True,
) -> None:
    """Create the table functions over the named relations.

    ``get_historical_delay_stats(route, carrier)`` ignores an argument that is NULL.
    ``get_flight_status(flight, 'YYYY-MM-DD')`` returns every snapshot of the flight, and
    ``get_latest_flight_status`` only the newest one. The bodies are inlined into the calling
    query, so the filters reach the scan of the relation.
    """
    create = "CREATE OR REPLACE TEMPORARY FUNCTION" if temporary else "CREATE OR REPLACE FUNCTION"
    if delay_stats:
        optional = [("route", "route_filter"), ("carrier", "carrier_filter")]
        predicate = " AND ".join(f"({arg} IS NULL OR {column} = {arg})" for column, arg in optional)
        arguments = ", ".join(f"{arg} STRING" for _, arg in optional)
        spark.sql(
            f"{create} get_historical_delay_stats({arguments}) RETURNS TABLE ({DELAY_STATS}) "
            f"RETURN SELECT {_names(DELAY_STATS)} FROM {delay_stats} WHERE {predicate}"
        )
    if flight_status:
        snapshots = (
            f"SELECT {_names(FLIGHT_STATUS)} FROM {flight_status} "
            "WHERE flight_number = flight_number_input AND flight_date = CAST(flight_date_input AS DATE)"
        )
        bodies = {
            "get_flight_status": snapshots,
            "get_latest_flight_status": f"{snapshots} ORDER BY last_updated DESC, status LIMIT 1",
        }
        for name, body in bodies.items():
            spark.sql(
                f"{create} {name}(flight_number_input STRING, flight_date_input STRING) "
                f"RETURNS TABLE ({FLIGHT_STATUS}) RETURN {body}"
            )
