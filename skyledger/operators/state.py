"""State tables kept as change history.

A command table goes in; an outcome table comes out, with one row per command and the text of its
``error`` (NULL when it took effect). ``changes`` turns the outcomes into history rows, which
``apply_changes`` folds into the current state. Keys of new rows derive from the command, so a
retried task writes the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.once import with_once
from ..functions.predicates import matching, matching_given, present
from ..functions.text import natural_id
from ..schemas import ALERT_TYPES, APP_TOOLS, CHANGE_TIME, CHANGE_TYPE, SERVED_TOOL_PREFIX
from ..sources.files import make_folder
from ..sources.versions import BUCKET, bucket_of
from .flights import keep_first
from .joins import join_unique, look_up, own_shuffle

WATCH_COLUMNS = [
    "watch_id", "user_id", "flight_number", "flight_date", "origin_airport", "destination_airport",
    "status", "created_at", "updated_at",
]
TRIP_COLUMNS = ["trip_id", "user_id", "trip_name", "created_at"]
ALERT_COLUMNS = [
    "alert_id", "watch_id", "alert_type", "threshold_minutes", "status", "next_fire_at", "triggered_at", "created_at",
]
LOG_COLUMNS = ["action_id", "user_id", "action_type", "action_payload", "result_status", "created_at"]


# --- history and state -----------------------------------------------------------------------


def _change_rank() -> Column:
    """Order of changes captured at one time: insert, then updates, then delete."""
    kind = F.col(CHANGE_TYPE)
    return F.when(kind == "insert", 0).when(kind == "delete", 2).otherwise(1)


def current_state(history: DataFrame, key: Sequence[str], tie_break: Sequence[str] = ()) -> DataFrame:
    """The newest row per key, without deleted keys and without the history columns.

    Of changes captured at one time the delete comes last, then updates, then the insert; columns of
    ``tie_break`` (largest first) settle the rest.
    """
    return live_rows(compact_history(history, key, tie_break))


def live_rows(compacted: DataFrame) -> DataFrame:
    """State held by a compacted history."""
    return compacted.filter(F.col(CHANGE_TYPE) != "delete").drop(CHANGE_TYPE, CHANGE_TIME)


def apply_changes(
    history: DataFrame, changes: DataFrame, key: Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """State after ``changes`` are appended to a history.

    ``history`` may be cut down to its newest row per key (see ``compact_history``) without a
    difference in the result.
    """
    return current_state(history.unionByName(changes), key, tie_break)


def compact_history(history: DataFrame, key: Sequence[str], tie_break: Sequence[str] = ()) -> DataFrame:
    """The newest history row per key, deletes included: all that later folds need."""
    captured = history.filter(F.col(CHANGE_TYPE) != "update_preimage")
    order = [F.desc(CHANGE_TIME), F.desc(_change_rank()), *[F.desc(name) for name in tie_break]]
    return keep_first(captured, key, order)


def fold_changes(
    compacted: DataFrame, changes: DataFrame, key: Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """The compacted history after a batch of changes; publish it and fold the next batch into it.

    Only keys that the batch changes are folded. The other rows pass through, without a shuffle when
    the changed keys are measured to be few enough to broadcast.
    """
    key = list(key)
    changed = own_shuffle(changes.select(*key).distinct().withColumn("_changed", F.lit(True)), key)
    marked = compacted.join(changed, key, "left").select(*compacted.columns, F.coalesce("_changed", F.lit(False)).alias("_changed"))
    # Rows of untouched keys have no rival, so the fold of the marked history leaves them as they are.
    incoming = changes.select(*compacted.columns, F.lit(True).alias("_changed"))
    every = marked.unionByName(incoming)
    untouched = every.filter("NOT _changed").drop("_changed")
    return untouched.unionByName(compact_history(every.filter("_changed").drop("_changed"), key, tie_break))


def fold_into_buckets(
    folder: str, changes: DataFrame, key: Sequence[str], tie_break: Sequence[str] = (), buckets: int = 256
) -> list[int]:
    """Fold a batch of changes into a compacted history kept below ``folder`` in hash buckets of the key.

    Only buckets that hold a changed key are read and written; the files of the others stay as they
    are. Returns the numbers of the buckets written. A batch folded again, as after a failure that left
    some buckets written and others not, gives the same rows. One writer at a time; ``buckets`` must
    stay the same, and enough that one bucket fits a task.
    """
    spark = changes.sparkSession
    key = list(key)
    columns = changes.columns
    # At most as many numbers as there are buckets.
    touched = sorted(row[0] for row in changes.select(bucket_of(key, buckets)).distinct().collect())
    held = bucketed_history(spark, folder, changes.schema, touched)
    # A key that changes often in the batch is cut to one row before it travels to its bucket.
    incoming = compact_history(changes, key, tie_break).select(*columns, bucket_of(key, buckets))
    every = held.unionByName(incoming).repartition(BUCKET)
    folded = compact_history(every, [BUCKET, *key], tie_break).select(*columns, BUCKET)
    folded.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(folder)
    return touched


def bucketed_history(spark: SparkSession, folder: str, schema: T.StructType, only: Sequence[int] | None = None) -> DataFrame:
    """The compacted history kept by ``fold_into_buckets``, or some of its buckets, with their number."""
    fields = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    held = spark.read.schema(fields).parquet(make_folder(spark, folder))
    return held if only is None else held.filter(F.col(BUCKET).isin(list(only)))


def changes(outcomes: DataFrame, columns: Sequence[str], change_type: str, at: str = "issued_at") -> DataFrame:
    """History rows of the commands that took effect."""
    return outcomes.filter(F.col("error").isNull()).select(
        *columns, F.lit(change_type).alias(CHANGE_TYPE), F.col(at).alias(CHANGE_TIME)
    )


def rejections(outcomes: DataFrame) -> DataFrame:
    """Commands that did not take effect, with the reason."""
    return outcomes.filter(F.col("error").isNotNull()).select("command_id", "error")


def _refusal(*checks: tuple[Column, str | Column]) -> Column:
    """Text of the first check that holds."""
    error = F.lit(None).cast("string")
    for failed, message in reversed(checks):
        error = F.when(failed, F.lit(message) if isinstance(message, str) else message).otherwise(error)
    return error.alias("error")


def _unknown(kind: str, key: str) -> tuple[Column, Column]:
    message = F.concat(F.lit(f"unknown {kind} "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    return ~F.col("_known"), message


# --- users -----------------------------------------------------------------------------------


def get_or_create_users(emails: DataFrame, users: DataFrame, at: Column) -> DataFrame:
    """The user of every e-mail address: the existing row, or one new row however often it occurs.

    Output: user_id (text), email, created_at, created.
    """
    wanted = present(emails.select("email"), "email").distinct()
    found = users.select(
        F.col("user_id").cast("string").alias("known_id"), "email", F.col("created_at").alias("known_since")
    )
    return look_up(wanted, found, "email", ["known_id", "known_since"]).select(
        F.coalesce("known_id", natural_id("user", F.col("email"))).alias("user_id"),
        "email",
        F.coalesce("known_since", at).alias("created_at"),
        (~F.col("_known")).alias("created"),
    )


# --- watches ---------------------------------------------------------------------------------


def add_watches(commands: DataFrame, users: DataFrame) -> DataFrame:
    """Start watches. Commands: command_id, user_id, flight_number, flight_date, origin_airport,
    destination_airport, issued_at. The same flight may be watched any number of times."""
    return look_up(commands, users, "user_id").select(
        "command_id",
        "issued_at",
        natural_id("watch", F.col("command_id")).alias("watch_id"),
        "user_id",
        "flight_number",
        "flight_date",
        "origin_airport",
        "destination_airport",
        F.lit("active").alias("status"),
        F.col("issued_at").alias("created_at"),
        F.col("issued_at").alias("updated_at"),
        _refusal(
            _unknown("user", "user_id"),
            (F.col("flight_number").isNull(), "flight_number is missing"),
            (F.col("flight_date").isNull(), "flight_date is missing"),
        ),
    )


def remove_watches(commands: DataFrame, watches: DataFrame) -> DataFrame:
    """Cancel watches, keeping their rows. Commands: command_id, watch_id, issued_at."""
    asked = commands.select("command_id", "watch_id", "issued_at")
    return look_up(asked, watches, "watch_id", [name for name in WATCH_COLUMNS if name != "watch_id"]).select(
        "command_id",
        "issued_at",
        *[name for name in WATCH_COLUMNS if name not in ("status", "updated_at")],
        F.lit("cancelled").alias("status"),
        F.col("issued_at").alias("updated_at"),
        _refusal(_unknown("watch", "watch_id")),
    )


def list_watched_flights(watches: DataFrame, user_id=None, status: str | None = "active") -> DataFrame:
    """Watches by flight date, of one user or of all, of one status or of any."""
    return matching(watches, user_id=user_id, status=status).orderBy("flight_date", "watch_id")


# --- trips -----------------------------------------------------------------------------------


def create_trips(commands: DataFrame, users: DataFrame, watches: DataFrame) -> DataFrame:
    """Create trips, each with all of its watches or not at all.

    Commands: command_id, user_id, trip_name, watch_ids, issued_at. A watch that is listed twice or
    unknown refuses the whole trip. Each listed watch is looked up once however many trips list it.
    """
    listed = commands.select("command_id", F.explode("watch_ids").alias("watch_id"))
    unknown = look_up(present(listed.select("watch_id"), "watch_id").distinct(), watches, "watch_id").filter(~F.col("_known"))
    broken = (
        join_unique(listed, unknown.select("watch_id"), ["watch_id"], "left_semi")
        .select("command_id")
        .distinct()
        .withColumn("_unknown_watch", F.lit(True))
    )
    has_null = F.exists("watch_ids", lambda watch: watch.isNull())
    repeated = F.size(F.array_distinct("watch_ids")) < F.size("watch_ids")
    return (
        look_up(commands, users, "user_id")
        .join(broken, "command_id", "left")
        .select(
            "command_id",
            "issued_at",
            natural_id("trip", F.col("command_id")).alias("trip_id"),
            "user_id",
            "trip_name",
            F.col("issued_at").alias("created_at"),
            "watch_ids",
            F.size("watch_ids").alias("flight_count"),
            _refusal(
                _unknown("user", "user_id"),
                (F.col("trip_name").isNull(), "trip_name is missing"),
                (F.col("watch_ids").isNull(), "watch_ids is missing"),
                (F.coalesce("_unknown_watch", has_null, F.lit(False)), "unknown watch in trip"),
                (repeated, "watch listed twice in trip"),
            ),
        )
    )


def trip_links(outcomes: DataFrame) -> DataFrame:
    """(trip_id, watch_id) of the trips created."""
    created = outcomes.filter(F.col("error").isNull())
    return created.select("trip_id", F.explode("watch_ids").alias("watch_id"))


def trip_flights_of(trips: DataFrame, links: DataFrame, watches: DataFrame, trip_id=None) -> DataFrame:
    """Flights of one trip, or of every trip, by flight date.

    An unknown ``trip_id`` is an error, as is asking for it: this looks the trip up.
    """
    wanted, chosen = matching(trips, trip_id=trip_id), matching(links, trip_id=trip_id)
    if trip_id is not None and wanted.isEmpty():
        raise ValueError(f"unknown trip {trip_id}")
    flights = watches.select("watch_id", "flight_number", "flight_date", "status")
    named = chosen.join(wanted.select("trip_id", "trip_name"), "trip_id")
    return (
        named.join(flights, "watch_id")
        .select("trip_id", "trip_name", "watch_id", "flight_number", "flight_date", "status")
        .orderBy("trip_id", "flight_date", "watch_id")
    )


# --- alerts ----------------------------------------------------------------------------------


def set_alerts(commands: DataFrame, watches: DataFrame) -> DataFrame:
    """Create alerts. Commands: command_id, watch_id, alert_type, threshold_minutes, issued_at."""
    kind = F.col("alert_type")
    wrong_kind = ~F.coalesce(kind.isin(*ALERT_TYPES), F.lit(False))
    return look_up(commands, watches, "watch_id").select(
        "command_id",
        "issued_at",
        natural_id("alert", F.col("command_id")).alias("alert_id"),
        "watch_id",
        "alert_type",
        "threshold_minutes",
        F.lit("active").alias("status"),
        F.lit(None).cast("timestamp").alias("next_fire_at"),
        F.lit(None).cast("timestamp").alias("triggered_at"),
        F.col("issued_at").alias("created_at"),
        _refusal(
            (wrong_kind, F.concat(F.lit("unknown alert type "), F.coalesce(kind, F.lit("NULL")))),
            _unknown("watch", "watch_id"),
        ),
    )


def cancel_alerts(commands: DataFrame, alerts: DataFrame) -> DataFrame:
    """Cancel alerts. Commands: command_id, alert_id, issued_at."""
    asked = commands.select("command_id", "alert_id", "issued_at")
    return look_up(asked, alerts, "alert_id", [name for name in ALERT_COLUMNS if name != "alert_id"]).select(
        "command_id",
        "issued_at",
        *[name for name in ALERT_COLUMNS if name != "status"],
        F.lit("cancelled").alias("status"),
        _refusal(_unknown("alert", "alert_id")),
    )


def list_alerts(
    alerts: DataFrame, watches: DataFrame, users: DataFrame, user_id=None, status: str | None = None
) -> DataFrame:
    """Alerts with their flight and e-mail address, newest first; empty arguments filter nothing."""
    flights = matching_given(watches, user_id=user_id).select("watch_id", "user_id", "flight_number", "flight_date")
    chosen = matching_given(alerts, status=status).join(flights, "watch_id")
    return (
        chosen.join(users.select("user_id", "email"), "user_id")
        .select(
            "alert_id", "alert_type", "threshold_minutes", "status", "triggered_at", "created_at",
            "flight_number", "flight_date", "email",
        )
        .orderBy(F.desc("created_at"), "alert_id")
    )


def match_alerts(events: DataFrame, watches: DataFrame, alerts: DataFrame) -> DataFrame:
    """Alerts fired by landings, as ``update`` history rows.

    A landing fires every active status-change alert of the active watches of its flight and day,
    once, at the earliest landing. Landings are cut down to the earliest per flight first, so each
    alert meets one row.
    """
    landings = (
        events.filter(F.col("event_type") == "landing")
        .groupBy("flight_number", "flight_date")
        .agg(F.min("event_timestamp").alias("_at"))
    )
    watched = watches.filter(F.col("status") == "active").select("watch_id", "flight_number", "flight_date")
    waiting = alerts.filter((F.col("status") == "active") & (F.col("alert_type") == "status_change"))
    landed = join_unique(watched, landings, ["flight_number", "flight_date"]).select("watch_id", "_at")
    fired = join_unique(waiting, landed, ["watch_id"])
    return fired.withColumns({"status": F.lit("triggered"), "triggered_at": F.col("_at")}).select(
        *ALERT_COLUMNS, F.lit("update").alias(CHANGE_TYPE), F.col("_at").alias(CHANGE_TIME)
    )


# --- action log ------------------------------------------------------------------------------


def log_actions(calls: DataFrame) -> DataFrame:
    """One log row per tool call.

    Calls: call_id, user_id, tool_name, is_mcp, arguments (JSON object as text), error (text raised
    by the call, or NULL), reported_error (a served tool answered with an error), called_at. The
    text of a raised error is merged into the payload. Arguments that are broken, no object, or name
    something twice are kept as text under ``raw_arguments``. Served tools are logged with a prefix; a call
    to an app tool that does not exist is refused before it is logged and leaves no row.
    """
    served = F.coalesce("is_mcp", F.lit(False))
    object_kind = "map<string,variant>"
    # A map cannot hold a name twice, and only objects become one.
    is_object = F.json_object_keys("arguments").isNotNull() & F.try_parse_json("arguments").isNotNull()
    kept = F.when(F.col("arguments").isNull(), F.lit("{}")).otherwise(
        F.to_json(F.create_map(F.lit("raw_arguments"), F.col("arguments")))
    )
    calls = with_once(calls, _arguments=F.from_json(F.when(is_object, F.col("arguments")).otherwise(kept), object_kind))
    others = F.map_filter("_arguments", lambda name, _: name != "error")
    merged = F.map_concat(others, F.create_map(F.lit("error"), F.col("error").cast("variant")))
    failed = F.col("error").isNotNull() | (served & F.coalesce("reported_error", F.lit(False)))
    return calls.filter(served | F.col("tool_name").isin(*APP_TOOLS)).select(
        natural_id("action", F.col("call_id")).alias("action_id"),
        "user_id",
        F.when(
            served, F.concat(F.lit(SERVED_TOOL_PREFIX), F.coalesce("tool_name", F.lit("unknown")))
        ).otherwise(F.col("tool_name")).alias("action_type"),
        F.when(F.col("error").isNotNull(), F.to_json(merged)).otherwise(F.to_json("_arguments")).alias("action_payload"),
        F.when(failed, "error").otherwise("success").alias("result_status"),
        F.col("called_at").alias("created_at"),
    )
