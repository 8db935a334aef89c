"""Live flight status: snapshots, latest rows and status transitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.once import with_once
from ..schemas import AIRCRAFT
from .flights import keep_first

FLIGHT_KEY = ["flight_number", "flight_date"]


def parse_aircraft(raw_json: Column) -> Column:
    """Aircraft record of a landing row; malformed text gives a record of NULLs."""
    return F.from_json(raw_json, AIRCRAFT)


def classify_status(alt_baro: Column) -> Column:
    """'on_ground' for the altitude text 'ground', else 'in_air' (an unknown altitude included)."""
    return F.when(alt_baro == "ground", "on_ground").otherwise("in_air")


def live_flight_status(landing: DataFrame) -> DataFrame:
    """One status snapshot per landing row with an aircraft; works on batch and stream alike.

    The feed has neither delay nor gate, so both columns are typed NULLs.
    """
    aircraft = F.col("_aircraft")
    return (
        with_once(landing.filter(F.col("found")), _aircraft=parse_aircraft(F.col("raw_json")))
        .select(
            *FLIGHT_KEY,
            classify_status(aircraft["alt_baro"]).alias("status"),
            F.lit(None).cast("int").alias("delay_minutes"),
            F.lit(None).cast("string").alias("gate"),
            aircraft["lat"].alias("lat"),
            aircraft["lon"].alias("lon"),
            F.col("ingested_at").alias("last_updated"),
        )
    )


def _latest(status: DataFrame) -> DataFrame:
    return keep_first(status, FLIGHT_KEY, [F.desc("last_updated"), F.asc("status")])


def latest_status(status: DataFrame) -> DataFrame:
    """The newest snapshot per flight."""
    return _latest(status)


def _airborne(status: DataFrame) -> DataFrame:
    return status.filter((F.col("status") == "in_air") & F.col("lat").isNotNull() & F.col("lon").isNotNull())


def latest_positions(status: DataFrame, mode: str = "last_airborne") -> DataFrame:
    """Newest known position per flight.

    ``last_airborne`` takes the newest airborne row with a position, so a flight that has landed
    still shows. ``current`` takes the newest row first and drops flights not airborne now.
    """
    if mode == "last_airborne":
        rows = _latest(_airborne(status))
    elif mode == "current":
        rows = _airborne(_latest(status))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return rows.select("flight_number", "lat", "lon", "last_updated")


def event_type(previous: Column, new: Column) -> Column:
    """Name of a change of status."""
    return (
        F.when((previous == "on_ground") & (new == "in_air"), "departure")
        .when((previous == "in_air") & (new == "on_ground"), "landing")
        .otherwise("status_change")
    )


def time_slice(at: Column, seconds: float) -> Column:
    """Number of the fixed-length slice of time that holds ``at``."""
    return F.floor(F.unix_micros(at.cast("timestamp")) / F.lit(int(seconds * 1_000_000)))


def status_transitions(status: DataFrame, slice_seconds: float = 60, ttl_seconds: float | None = None) -> DataFrame:
    """Every change of status of a flight, in time order; equal times are ordered by status.

    With ``ttl_seconds`` a flight is forgotten when two readings lie further apart: the second one
    begins anew and gives no change.

    One flight may hold a large share of all rows, so a flight is not sorted as a whole. Rows are
    compared within short slices of time, each a group of its own, and every slice leaves one row
    with its first and last status. Only these rows are then compared along the flight.
    """
    at_slice = W.partitionBy(*FLIGHT_KEY, "_slice").orderBy("last_updated", "status")
    so_far = at_slice.rowsBetween(W.unboundedPreceding, W.currentRow)
    read = status.select(
        *FLIGHT_KEY, "status", "last_updated", time_slice(F.col("last_updated"), slice_seconds).alias("_slice")
    ).withColumns(
        {
            "_previous": F.lag("status").over(at_slice),
            "_previous_at": F.lag("last_updated").over(at_slice),
            "_last": F.lead(F.lit(True)).over(at_slice).isNull(),
            "_first_status": F.first("status").over(so_far),
            "_first_at": F.first("last_updated").over(so_far),
        }
    )

    def changed(rows: DataFrame) -> DataFrame:
        rows = rows.filter(F.col("_previous") != F.col("_new"))
        if ttl_seconds is None:
            return rows
        apart = F.unix_micros(F.col("_at").cast("timestamp")) - F.unix_micros(F.col("_previous_at").cast("timestamp"))
        return rows.filter(apart <= int(ttl_seconds * 1_000_000))

    inside = read.select(
        *FLIGHT_KEY, "_previous", "_previous_at", F.col("status").alias("_new"), F.col("last_updated").alias("_at")
    )
    along = W.partitionBy(*FLIGHT_KEY).orderBy("_slice")
    between = (
        read.filter("_last")
        .select(
            *FLIGHT_KEY,
            F.lag("status").over(along).alias("_previous"),
            F.lag("last_updated").over(along).alias("_previous_at"),
            F.col("_first_status").alias("_new"),
            F.col("_first_at").alias("_at"),
        )
    )
    return changed(inside).unionByName(changed(between)).select(
        *FLIGHT_KEY,
        event_type(F.col("_previous"), F.col("_new")).alias("event_type"),
        F.col("_at").alias("event_timestamp"),
        F.col("_previous").alias("previous_status"),
        F.col("_new").alias("new_status"),
    )


def flight_status_of(
    status: DataFrame, flight_number: str, flight_date: str, latest_only: bool = False
) -> DataFrame:
    """Snapshots of one flight on one day (``YYYY-MM-DD``), or only the newest."""
    rows = status.filter(
        (F.col("flight_number") == flight_number) & (F.col("flight_date") == F.lit(flight_date).cast("date"))
    )
    return _latest(rows) if latest_only else rows
