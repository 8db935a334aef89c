"""Declared schemas, and the values that are fixed by the data formats."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Aircraft record of the polled feed. alt_baro is a number or the text 'ground'.
AIRCRAFT = (
    "hex string, flight string, alt_baro string, gs double, track double, "
    "lat double, lon double, squawk string, seen double, seen_pos double"
)

# Landing tables.
FLIGHT_LANDING = T.StructType(
    [
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("flight_number", T.StringType(), False),
        T.StructField("flight_date", T.DateType(), False),
        T.StructField("found", T.BooleanType(), False),
        T.StructField("raw_json", T.StringType(), True),
        T.StructField("poll_error", T.StringType(), True),
    ]
)
AREA_LANDING = T.StructType(
    [
        T.StructField("ingested_at", T.TimestampType(), True),
        T.StructField("query_lat", T.DoubleType(), True),
        T.StructField("query_lon", T.DoubleType(), True),
        T.StructField("query_radius_nm", T.IntegerType(), True),
        T.StructField("raw_json", T.StringType(), True),
    ]
)

# Output tables.
DELAY_STATS = "route string, carrier string, avg_delay_minutes double, on_time_pct double, sample_size int"
FLIGHT_STATUS = (
    "flight_number string, flight_date date, status string, delay_minutes int, gate string, last_updated timestamp"
)

# Element types of a parsed document, and those that open a section.
CONTENT_TYPES = ("text", "title", "section_header", "caption", "table")
HEADING_TYPES = ("title", "section_header")
FIRST_SECTION = "Untitled"
MAX_CHUNK_WORDS = 1200

# Delay statistics.
ON_TIME_MINUTES = 15
MIN_SAMPLE = 10

# State tables.
ALERT_TYPES = ("delay_threshold", "gate_change", "status_change", "cancellation")
WATCH_STATUSES = ("active", "completed", "cancelled")
ALERT_STATUSES = ("active", "triggered", "cancelled")
RESULT_STATUSES = ("success", "error")
APP_TOOLS = (
    "add_flight_watch",
    "remove_flight_watch",
    "create_trip",
    "set_alert",
    "cancel_alert",
    "list_my_watched_flights",
    "get_trip_summary",
    "list_my_alerts",
)
SERVED_TOOL_PREFIX = "mcp::"

# Change-history columns.
CHANGE_TYPE = "_pg_change_type"
CHANGE_TIME = "_timestamp"


@dataclass(frozen=True)
class FlightColumns:
    """Names of the historical flight columns; other mirrors of the data use other names."""

    flight_date: str = "FlightDate"
    carrier: str = "Reporting_Airline"
    origin: str = "Origin"
    dest: str = "Dest"
    arr_delay: str = "ArrDelay"
    cancelled: str = "Cancelled"

    @property
    def all(self) -> list[str]:
        return [self.flight_date, self.carrier, self.origin, self.dest, self.arr_delay, self.cancelled]

    @property
    def dedup_key(self) -> list[str]:
        return [self.flight_date, self.carrier, self.origin, self.dest]


def _checked(field: T.StructField) -> Column:
    value = F.col(field.name).cast(field.dataType)
    if field.nullable:
        return value.alias(field.name)
    message = F.lit(f"{field.name} must not be NULL")
    return F.coalesce(value, F.raise_error(message).cast(field.dataType)).alias(field.name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select, cast and order the columns of ``schema``; a NULL in a required column fails the job."""
    return df.select(*[_checked(field) for field in schema.fields])
