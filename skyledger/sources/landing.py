"""Polled aircraft responses and their landing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.once import with_once
from ..schemas import AREA_LANDING, FLIGHT_LANDING, conform


def _aircraft_list(body: Column) -> Column:
    return F.try_variant_get(body, "$.ac", "array<variant>")


def land_flight_polls(responses: DataFrame) -> DataFrame:
    """Landing rows from one response per polled flight.

    Input: ``ingested_at, flight_number, flight_date, body, request_error``. A flight is found when
    the list ``ac`` of its body is not empty; its first element is kept as text. A list that is
    missing, null or empty means not found, which is no error. A failed request, a body that is no
    JSON, and a body of another shape leave a ``poll_error``.
    """
    parsed = with_once(responses, _json=F.try_parse_json("body"))
    parsed = with_once(parsed, _list=_aircraft_list(F.col("_json")))
    found = F.col("request_error").isNull() & (F.coalesce(F.size("_list"), F.lit(0)) > 0)
    # Texts of JSON values that count as an empty answer.
    empty = ("null", "false", "0", '""', "[]", "{}")
    listless = F.to_json("_json").isin(*empty) | (
        F.schema_of_variant("_json").startswith("OBJECT")
        & F.coalesce(F.to_json(F.try_variant_get("_json", "$.ac", "variant")).isin(*empty), F.lit(True))
    )
    error = (
        F.when(F.col("request_error").isNotNull(), F.col("request_error"))
        .when(F.col("_json").isNull(), F.lit("body is not valid JSON"))
        .when(F.col("_list").isNull() & ~listless, F.lit("body holds no aircraft list"))
    )
    first = F.to_json(F.element_at("_list", 1))
    landed = with_once(parsed, found=found, raw_json=F.when(found, first), poll_error=error)
    return conform(landed, FLIGHT_LANDING)


def land_area_polls(responses: DataFrame) -> DataFrame:
    """One landing row per aircraft of an area response; a response without aircraft has none.

    Input: ``ingested_at, query_lat, query_lon, query_radius_nm, body``.
    """
    rows = responses.withColumn("_aircraft", F.explode(_aircraft_list(F.try_parse_json("body"))))
    return conform(rows.withColumn("raw_json", F.to_json("_aircraft")), AREA_LANDING)


def synthetic_landing(flights: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """One landing row on the ground per (flight_number, flight_date), for driving landing events."""
    # A parked aircraft.
    aircraft = F.struct(
        F.lit("a9cee9").alias("hex"),
        F.col("flight_number").alias("flight"),
        F.lit("ground").alias("alt_baro"),
        F.lit(0.0).alias("gs"),
        F.lit(0.0).alias("track"),
        F.lit(33.6407).alias("lat"),
        F.lit(-84.4277).alias("lon"),
        F.lit("1200").alias("squawk"),
        F.lit(0.5).alias("seen"),
        F.lit(0.5).alias("seen_pos"),
    )
    rows = flights.withColumns(
        {
            "ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
            "found": F.lit(True),
            "raw_json": F.to_json(aircraft),
            "poll_error": F.lit(None).cast("string"),
        }
    )
    return conform(rows, FLIGHT_LANDING)


def recent_landing(landing: DataFrame, n: int = 10) -> DataFrame:
    """The newest ``n`` landing rows."""
    return landing.orderBy(F.desc("ingested_at"), "flight_number", "flight_date").limit(n)


def landing_total(landing: DataFrame) -> DataFrame:
    """Number of landing rows so far."""
    return landing.agg(F.count(F.lit(1)).alias("total_rows"))


def poll_summary(landing: DataFrame) -> DataFrame:
    """Flights polled and found in each cycle."""
    return landing.groupBy("ingested_at").agg(
        F.count(F.lit(1)).alias("polled"), F.count_if("found").alias("found_count")
    )


# Name under which a stream reports its polls.
POLLS = "polls"


def observe_polls(landing: DataFrame) -> DataFrame:
    """A landing stream that counts the flights polled and found while its rows pass.

    The counts of each micro-batch come with the progress of whatever query runs the stream; nothing is
    read twice and nothing is shuffled.
    """
    return landing.observe(
        POLLS,
        F.min(F.unix_micros("ingested_at")).alias("first_micros"),
        F.count(F.lit(1)).alias("polled"),
        F.count(F.when(F.col("found"), 1)).alias("found_count"),
    )


def observed_polls(query: StreamingQuery) -> list[tuple]:
    """(batch, first_micros, polled, found_count) of the micro-batches with rows of a query.

    Spark keeps the progress of the last ``spark.sql.streaming.numRecentProgressUpdates`` of them.
    """
    rows = {}
    for progress in query.recentProgress:
        polls = progress.observedMetrics.get(POLLS)
        if polls is not None and polls.polled:
            rows[progress.batchId] = (progress.batchId, polls.first_micros, polls.polled, polls.found_count)
    return [rows[batch] for batch in sorted(rows)]
