from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from skyledger.operators import audit, metrics, state

AT = datetime.datetime(2026, 10, 1, 12)
DAY = AT.date()
WATCHES = ("watch_id int, user_id int, flight_number string, flight_date date, origin_airport string, "
           "destination_airport string, status string, created_at timestamp, updated_at timestamp")
ALERTS = ("alert_id int, watch_id int, alert_type string, threshold_minutes int, status string, "
          "next_fire_at timestamp, triggered_at timestamp, created_at timestamp")


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame([(1, "a@x.org", AT), (2, "b@x.org", AT)], "user_id int, email string, created_at timestamp")


@pytest.fixture(scope="module")
def watches(spark):
    rows = [(i, 1 + i % 2, f"F{i}", DAY, "ATL", "ORD", "active", AT, AT) for i in range(1, 5)]
    return spark.createDataFrame(rows, WATCHES)


def errors(outcomes):
    return {row.command_id: row.error for row in state.rejections(outcomes).collect()}


def test_current_state(spark):
    rows = [
        (1, "a", "insert", 0), (1, "b", "update", 1), (2, "a", "insert", 0), (2, "a", "delete", 5), (2, "late", "update", 3),
        (3, "a", "insert", 7), (3, "b", "update", 7), (4, "a", "insert", 1), (4, "a", "delete", 1), (5, "x", "delete", 1),
        (5, "back", "insert", 2), (6, "old", "update_preimage", 9), (6, "new", "update_postimage", 8),
    ]
    history = spark.createDataFrame(rows, "id int, value string, _pg_change_type string, at int").withColumn(
        "_timestamp", F.timestamp_seconds("at")).drop("at")
    wanted = {1: "b", 3: "b", 5: "back", 6: "new"}
    folded = state.current_state(history, ["id"])
    assert folded.columns == ["id", "value"]
    assert dict(folded.collect()) == wanted
    early, late = history.filter("second(_timestamp) < 5"), history.filter("second(_timestamp) >= 5")
    compacted = state.compact_history(early, ["id"])
    assert dict(state.apply_changes(compacted, late, ["id"]).collect()) == wanted
    folded = state.fold_changes(compacted, late, ["id"])
    assert folded.count() == 6
    assert dict(state.live_rows(folded).collect()) == wanted


def test_users_are_created_once(spark, users):
    emails = spark.createDataFrame([(e,) for e in ["a@x.org", "new@x.org", "new@x.org", None, "A@x.org"]], "email string")
    made = {row.email: row for row in state.get_or_create_users(emails, users, F.lit(AT)).collect()}
    assert set(made) == {"a@x.org", "new@x.org", "A@x.org"}
    assert (made["a@x.org"].user_id, made["a@x.org"].created) == ("1", False)
    assert made["new@x.org"].created and made["new@x.org"].user_id != made["A@x.org"].user_id


def test_add_and_remove_watches(spark, users, watches):
    rows = [("c1", 1, "UAL123", DAY), ("c2", 1, "UAL123", DAY), ("c3", 9, "UAL123", DAY), ("c4", 1, None, DAY),
            ("c5", 1, "X", None), ("c6", None, "X", DAY)]
    commands = spark.createDataFrame(rows, "command_id string, user_id int, flight_number string, flight_date date").withColumns(
        {"origin_airport": F.lit("ATL"), "destination_airport": F.lit(None).cast("string"), "issued_at": F.lit(AT)})
    outcomes = state.add_watches(commands, users)
    assert errors(outcomes) == {"c3": "unknown user 9", "c4": "flight_number is missing", "c5": "flight_date is missing", "c6": "unknown user NULL"}
    added = state.changes(outcomes, state.WATCH_COLUMNS, "insert").collect()
    assert len({row.watch_id for row in added}) == 2
    assert {(r.status, r._pg_change_type, r._timestamp, r.created_at) for r in added} == {("active", "insert", AT, AT)}

    later = AT + datetime.timedelta(hours=1)
    removals = spark.createDataFrame([("r1", 1, later), ("r2", 77, later), ("r3", None, later), ("r4", 1, later)],
                                     "command_id string, watch_id int, issued_at timestamp")
    outcomes = state.remove_watches(removals, watches)
    assert errors(outcomes) == {"r2": "unknown watch 77", "r3": "unknown watch NULL"}
    history = watches.withColumns({"_pg_change_type": F.lit("insert"), "_timestamp": F.lit(AT)})
    folded = state.apply_changes(history, state.changes(outcomes, state.WATCH_COLUMNS, "update"), ["watch_id"])
    rows = {row.watch_id: row for row in folded.collect()}
    assert (rows[1].status, rows[1].updated_at, rows[1].flight_number) == ("cancelled", later, "F1")
    assert rows[2].status == "active" and len(rows) == 4
    assert [r.watch_id for r in state.list_watched_flights(folded, user_id=2).collect()] == [3]
    assert [r.watch_id for r in state.list_watched_flights(folded, user_id=2, status=None).collect()] == [1, 3]


def test_trips_are_all_or_nothing(spark, users, watches):
    rows = [("t1", 1, "work", [1, 2]), ("t2", 1, "twice", [3, 3]), ("t3", 2, "lost", [1, 99]), ("t4", 2, "empty", []),
            ("t5", 8, "nobody", [1]), ("t6", 1, None, [1]), ("t7", 1, "null", [1, None])]
    commands = spark.createDataFrame(rows, "command_id string, user_id int, trip_name string, watch_ids array<int>").withColumn("issued_at", F.lit(AT))
    outcomes = state.create_trips(commands, users, watches)
    assert errors(outcomes) == {
        "t2": "watch listed twice in trip", "t3": "unknown watch in trip", "t5": "unknown user 8", "t6": "trip_name is missing",
        "t7": "unknown watch in trip",
    }
    trips = state.changes(outcomes, state.TRIP_COLUMNS, "insert").select(*state.TRIP_COLUMNS)
    links = state.trip_links(outcomes)
    assert {r.trip_name: r.flight_count for r in metrics.trip_sizes(trips, links).collect()} == {"work": 2, "empty": 0}
    work = trips.filter("trip_name = 'work'").first().trip_id
    assert [r.flight_number for r in state.trip_flights_of(trips, links, watches, work).collect()] == ["F1", "F2"]
    assert state.trip_flights_of(trips, links, watches, trips.filter("trip_name = 'empty'").first().trip_id).count() == 0
    with pytest.raises(ValueError, match="unknown trip"):
        state.trip_flights_of(trips, links, watches, "nope")


def test_alert_commands_and_lists(spark, users, watches):
    rows = [("a1", 1, "delay_threshold", 30), ("a2", 1, "delay_threshold", None), ("a3", 1, "weather", None),
            ("a4", 55, "gate_change", None), ("a5", 2, None, None)]
    commands = spark.createDataFrame(rows, "command_id string, watch_id int, alert_type string, threshold_minutes int").withColumn("issued_at", F.lit(AT))
    outcomes = state.set_alerts(commands, watches)
    assert errors(outcomes) == {"a3": "unknown alert type weather", "a4": "unknown watch 55", "a5": "unknown alert type NULL"}
    alerts = state.changes(outcomes, state.ALERT_COLUMNS, "insert").drop("_pg_change_type", "_timestamp")
    known = alerts.filter("threshold_minutes = 30").first().alert_id
    cancels = spark.createDataFrame([("x1", known), ("x2", "nope")], "command_id string, alert_id string").withColumn("issued_at", F.lit(AT))
    assert errors(state.cancel_alerts(cancels, alerts)) == {"x2": "unknown alert nope"}
    assert state.cancel_alerts(cancels, alerts).filter("error IS NULL").first().status == "cancelled"

    rows = [(i, 1 + i % 3, "status_change", None, ["active", "triggered"][i % 2], None, None, AT + datetime.timedelta(hours=i)) for i in range(8)]
    alerts = spark.createDataFrame(rows, ALERTS)
    listed = state.list_alerts(alerts, watches, users)
    assert listed.columns == ["alert_id", "alert_type", "threshold_minutes", "status", "triggered_at", "created_at",
                              "flight_number", "flight_date", "email"]
    assert [r.alert_id for r in listed.collect()] == list(range(7, -1, -1))
    assert {r.alert_id for r in state.list_alerts(alerts, watches, users, status="triggered").collect()} == {1, 3, 5, 7}
    assert {r.email for r in state.list_alerts(alerts, watches, users, user_id=2, status="").collect()} == {"b@x.org"}
    assert metrics.alert_totals(alerts).first() == (4, 4)


def test_action_log(spark):
    rows = [
        (1, 1, "set_alert", False, '{"watch_id":"w","threshold_minutes":30}', None, None),
        (2, 1, "create_trip", False, '{"watch_ids":["a","b"],"error":"mine"}', 'bad "trip"', None),
        (3, 1, "fly_plane", False, "{}", "Unknown tool", None),
        (4, 2, "get_flight_status", True, '{"n":null}', None, True),
        (5, 2, "lookup", True, None, "down", None),
        (6, 2, None, True, "{}", None, False),
        (7, 2, None, False, "{}", None, None),
    ]
    calls = spark.createDataFrame(
        rows, "call_id int, user_id int, tool_name string, is_mcp boolean, arguments string, error string, reported_error boolean"
    ).withColumn("called_at", F.lit(AT))
    logged = {(r.action_type, r.result_status): json.loads(r.action_payload) for r in state.log_actions(calls).collect()}
    assert logged == {
        ("set_alert", "success"): {"watch_id": "w", "threshold_minutes": 30},
        ("create_trip", "error"): {"watch_ids": ["a", "b"], "error": 'bad "trip"'},
        ("mcp::get_flight_status", "error"): {"n": None},
        ("mcp::lookup", "error"): {"error": "down"},
        ("mcp::unknown", "success"): {},
    }


def test_audit_counts_every_rule(spark, users, watches):
    bad = watches.unionByName(watches.filter("watch_id = 1")).unionByName(
        spark.createDataFrame([(None, 9, None, DAY, None, None, "lost", AT, AT)], WATCHES))
    links = spark.createDataFrame([("t", 1), ("t", 1), ("u", 50)], "trip_id string, watch_id int")
    trips = spark.createDataFrame([("t", 1, "n", AT)], "trip_id string, user_id int, trip_name string, created_at timestamp")
    result = audit.constraint_audit({"users": users, "watched_flights": bad, "trip_plans": trips, "trip_flights": links})
    broken = {(r.table_name, r.rule): r.violations for r in result.filter("violations > 0").collect()}
    assert broken == {
        ("watched_flights", "required watch_id"): 1, ("watched_flights", "required flight_number"): 1,
        ("watched_flights", "allowed status"): 1, ("watched_flights", "unique watch_id"): 1,
        ("watched_flights", "references user_id"): 1, ("trip_flights", "unique trip_id, watch_id"): 1,
        ("trip_flights", "references trip_id"): 1, ("trip_flights", "references watch_id"): 1,
    }
    assert result.count() == 26
