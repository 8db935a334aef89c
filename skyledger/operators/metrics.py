"""Activity metrics over change history and current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import matching, of_change, present, time_bucket, tool_source
from ..schemas import CHANGE_TIME, RESULT_STATUSES
from .joins import join_unique

# The change types that count as a triggered alert, in the two published metrics.
NOTEBOOK_ALERT_CHANGES = ("update",)
DASHBOARD_ALERT_CHANGES = ("insert", "update_postimage")


def _rows(name: str):
    return F.count(F.lit(1)).alias(name)


def tool_outcomes(action_log: DataFrame) -> DataFrame:
    """Tool calls by action and result."""
    return of_change(action_log, "insert").groupBy("action_type", "result_status").agg(_rows("event_count"))


def outcome_pivot(action_log: DataFrame, statuses: Sequence[str] = RESULT_STATUSES) -> DataFrame:
    """Tool calls by action, one column per result; no calls count as 0.

    Results that are not among ``statuses``, or missing, count in the column ``other``.
    """
    known = F.coalesce(F.col("result_status").isin(*statuses), F.lit(False))
    return (
        of_change(action_log, "insert")
        .groupBy("action_type")
        .agg(
            *[F.count_if(F.col("result_status") == status).alias(status) for status in statuses],
            F.count_if(~known).alias("other"),
        )
    )


def calls_per_hour(action_log: DataFrame) -> DataFrame:
    """Tool calls by hour."""
    hour = time_bucket("hour", F.col("created_at")).alias("hour")
    return of_change(action_log, "insert").groupBy(hour).agg(_rows("tool_calls"))


def tool_source_split(action_log: DataFrame) -> DataFrame:
    """Tool calls by who serves the tool."""
    source = tool_source(F.col("action_type")).alias("tool_source")
    return of_change(action_log, "insert").groupBy(source).agg(_rows("event_count"))


def alerts_per_hour(alerts: DataFrame, change_types: Sequence[str] = NOTEBOOK_ALERT_CHANGES) -> DataFrame:
    """History rows with a triggered alert, by hour; an alert that fires again counts again.

    ``NOTEBOOK_ALERT_CHANGES`` and ``DASHBOARD_ALERT_CHANGES`` give different counts on one history.
    """
    hour = time_bucket("hour", F.col(CHANGE_TIME)).alias("hour")
    triggered = of_change(alerts, *change_types).filter(F.col("status") == "triggered")
    return triggered.groupBy(hour).agg(_rows("alerts_triggered"))


def most_watched_routes(watches: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` routes added most often, with known ends; equal counts are ordered by route."""
    route = ["origin_airport", "destination_airport"]
    return (
        present(of_change(watches, "insert"), *route)
        .groupBy(*route)
        .agg(_rows("watch_count"))
        .orderBy(F.desc("watch_count"), *route)
        .limit(n)
    )


def active_users_per_day(action_log: DataFrame) -> DataFrame:
    """Distinct users by day."""
    day = time_bucket("day", F.col("created_at")).alias("day")
    return of_change(action_log, "insert").groupBy(day).agg(F.countDistinct("user_id").alias("active_users"))


def recent_activity(action_log: DataFrame, n: int = 10) -> DataFrame:
    """The newest ``n`` tool calls."""
    return (
        of_change(action_log, "insert")
        .orderBy(F.desc("created_at"), F.desc("action_id"))
        .limit(n)
        .select("created_at", "action_type", "result_status")
    )


def active_flights(watches: DataFrame) -> DataFrame:
    """Flights with at least one active watch, each once."""
    return watches.filter(F.col("status") == "active").select("flight_number", "flight_date").distinct()


def alert_totals(alerts: DataFrame) -> DataFrame:
    """One row: alerts triggered and alerts active."""
    return alerts.agg(
        F.count_if(F.col("status") == "triggered").alias("triggered"),
        F.count_if(F.col("status") == "active").alias("active"),
    )


def trip_sizes(trips: DataFrame, trip_flights: DataFrame) -> DataFrame:
    """Number of flights per trip; a trip may have none."""
    sizes = trip_flights.groupBy("trip_id").agg(_rows("flight_count"))
    return trips.join(sizes, "trip_id", "left").withColumn(
        "flight_count", F.coalesce("flight_count", F.lit(0).cast("long"))
    )


def user_action_log(action_log: DataFrame, user_id) -> DataFrame:
    """Actions of one user in time order."""
    return matching(action_log, user_id=user_id).orderBy("created_at", "action_id")


def actions_per_user(action_log: DataFrame) -> DataFrame:
    """Number of actions by user and action."""
    return action_log.groupBy("user_id", "action_type").agg(_rows("action_count"))


def with_list_count(rows: DataFrame, owner: str = "user_id") -> DataFrame:
    """Each row with the number of rows of its owner.

    This is the flat form of a list with its length: the rows of one owner stay spread over tasks,
    as only the counts (one row per owner) are grouped.
    """
    sizes = rows.groupBy(owner).agg(_rows("list_count"))
    return join_unique(rows, sizes, [owner])
