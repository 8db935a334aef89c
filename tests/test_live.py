from __future__ import annotations

import datetime
import random

import pytest

from skyledger.operators.live import flight_status_of, latest_positions, live_flight_status, status_transitions
from skyledger.schemas import FLIGHT_LANDING

AT = datetime.datetime(2026, 10, 1)
DAY = AT.date()
STATUS = "flight_number string, flight_date date, status string, lat double, lon double, last_updated timestamp"


def at(seconds):
    return AT + datetime.timedelta(seconds=seconds)


def brute_transitions(rows):
    """Changes of status, flight by flight, in time order, equal times by status."""
    flights = {}
    for number, date, status, *_, when in rows:
        flights.setdefault((number, date), []).append((when, status))
    found = []
    for key, readings in flights.items():
        readings.sort()
        for (_, old), (when, new) in zip(readings, readings[1:]):
            if old != new:
                kind = "departure" if new == "in_air" else "landing"
                found.append((*key, kind, when, old, new))
    return sorted(found, key=repr)


def test_status_projection(spark):
    rows = [
        (AT, "a", DAY, True, '{"alt_baro":"ground","lat":1.0,"lon":2.0}', None),
        (AT, "b", DAY, True, '{"alt_baro":1200}', None),
        (AT, "c", DAY, True, '{"alt_baro":null}', None),
        (AT, "d", DAY, True, "{bad", None),
        (AT, "e", DAY, False, '{"alt_baro":"ground"}', None),
    ]
    status = live_flight_status(spark.createDataFrame(rows, FLIGHT_LANDING))
    assert status.dtypes[:5] == [
        ("flight_number", "string"), ("flight_date", "date"), ("status", "string"), ("delay_minutes", "int"), ("gate", "string"),
    ]
    assert {r.flight_number: r.status for r in status.collect()} == {"a": "on_ground", "b": "in_air", "c": "in_air", "d": "in_air"}


@pytest.mark.parametrize("slice_seconds", [1, 60, 100_000])
def test_transitions_match_brute_force(spark, slice_seconds):
    draw = random.Random(slice_seconds)
    rows = []
    for number in ("a", "b", None):
        for _ in range(400):
            rows.append((number, DAY, draw.choice(["on_ground", "in_air"]), None, None, at(draw.randrange(1500))))
    rows.append(("single", DAY, "in_air", None, None, at(0)))
    found = status_transitions(spark.createDataFrame(rows, STATUS).repartition(7), slice_seconds)
    assert sorted((tuple(row) for row in found.collect()), key=repr) == brute_transitions(rows)


def test_other_change_is_a_status_change(spark):
    rows = [("a", DAY, "boarding", None, None, at(0)), ("a", DAY, "delayed", None, None, at(500))]
    assert status_transitions(spark.createDataFrame(rows, STATUS)).first().event_type == "status_change"


def test_positions_and_snapshots(spark):
    rows = [
        ("a", DAY, "in_air", 1.0, 1.0, at(0)),
        ("a", DAY, "in_air", 2.0, 2.0, at(10)),
        ("a", DAY, "on_ground", 3.0, 3.0, at(20)),
        ("b", DAY, "in_air", 4.0, 4.0, at(0)),
        ("b", DAY, "in_air", None, 5.0, at(10)),
        ("c", DAY, "in_air", 6.0, 6.0, at(5)),
    ]
    status = spark.createDataFrame(rows, STATUS)
    assert {(r.flight_number, r.lat) for r in latest_positions(status).collect()} == {("a", 2.0), ("b", 4.0), ("c", 6.0)}
    assert {(r.flight_number, r.lat) for r in latest_positions(status, "current").collect()} == {("c", 6.0)}
    with pytest.raises(ValueError):
        latest_positions(status, "newest")
    assert flight_status_of(status, "a", "2026-10-01").count() == 3
    assert flight_status_of(status, "a", "2026-10-01", latest_only=True).first().status == "on_ground"
    assert flight_status_of(status, "a", "2026-10-02").count() == 0
