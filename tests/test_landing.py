from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from skyledger.operators.live import live_flight_status, parse_aircraft
from skyledger.schemas import FLIGHT_LANDING
from skyledger.sources.landing import (
    land_area_polls, land_flight_polls, landing_total, poll_summary, recent_landing, synthetic_landing,
)

AT = datetime.datetime(2026, 10, 1, 12)
RESPONSE = "ingested_at timestamp, flight_number string, flight_date date, body string, request_error string"

# body, request error -> found, first aircraft, poll error
POLLS = {
    "found": ('{"ac":[{"hex":"a","alt_baro":35000},{"hex":"b"}]}', None, True, {"hex": "a", "alt_baro": 35000}, None),
    "none": ('{"ac":[]}', None, False, None, None),
    "null list": ('{"ac":null}', None, False, None, None),
    "no list": ("{}", None, False, None, None),
    "null body": ("null", None, False, None, None),
    "empty array": ("[]", None, False, None, None),
    "zero": ("0", None, False, None, None),
    "falsy list": ('{"ac":""}', None, False, None, None),
    "null aircraft": ('{"ac":[null]}', None, True, None, None),
    "bad json": ('{"ac":', None, False, None, "body is not valid JSON"),
    "no body": (None, None, False, None, "body is not valid JSON"),
    "array": ('["x"]', None, False, None, "body holds no aircraft list"),
    "number": ("7", None, False, None, "body holds no aircraft list"),
    "list is text": ('{"ac":"x"}', None, False, None, "body holds no aircraft list"),
    "failed": ('{"ac":[{"hex":"a"}]}', "timeout", False, None, "timeout"),
}


def test_land_flight_polls(spark):
    rows = [(AT, name, AT.date(), body, error) for name, (body, error, *_) in POLLS.items()]
    landed = land_flight_polls(spark.createDataFrame(rows, RESPONSE))
    assert landed.columns == FLIGHT_LANDING.names
    for row in landed.collect():
        _, _, found, aircraft, error = POLLS[row.flight_number]
        assert (row.found, row.poll_error) == (found, error), row.flight_number
        if row.flight_number == "null aircraft":
            assert row.raw_json == "null"
        else:
            assert (json.loads(row.raw_json) if row.raw_json else None) == aircraft, row.flight_number


def test_landing_refuses_a_missing_key(spark):
    rows = [(AT, None, AT.date(), "{}", None)]
    with pytest.raises(Exception, match="flight_number must not be NULL"):
        land_flight_polls(spark.createDataFrame(rows, RESPONSE)).collect()


def test_land_area_polls(spark):
    bodies = ['{"ac":[{"hex":"a"},{"hex":"b"}]}', '{"ac":[]}', '{"ac":null}', "{}", "bad", None]
    df = spark.createDataFrame(
        [(AT, 33.6, -84.4, 50, body) for body in bodies],
        "ingested_at timestamp, query_lat double, query_lon double, query_radius_nm int, body string",
    )
    rows = land_area_polls(df).collect()
    assert sorted(json.loads(row.raw_json)["hex"] for row in rows) == ["a", "b"]
    assert {(row.query_lat, row.query_radius_nm) for row in rows} == {(33.6, 50)}


def test_synthetic_landing_is_on_the_ground(spark):
    keys = spark.createDataFrame([("UAL123", AT.date())], "flight_number string, flight_date date")
    row = live_flight_status(synthetic_landing(keys, F.lit(AT))).first()
    assert (row.flight_number, row.status, row.lat, row.lon, row.last_updated) == ("UAL123", "on_ground", 33.6407, -84.4277, AT)


def test_reports(spark):
    rows = [(AT + datetime.timedelta(minutes=i // 2), f"F{i}", AT.date(), i % 3 == 0, None, None) for i in range(12)]
    landing = spark.createDataFrame(rows, FLIGHT_LANDING)
    assert [row.flight_number for row in recent_landing(landing, 3).collect()] == ["F10", "F11", "F8"]
    assert landing_total(landing).first().total_rows == 12
    summary = {row.ingested_at.minute: (row.polled, row.found_count) for row in poll_summary(landing).collect()}
    assert summary == {0: (2, 1), 1: (2, 1), 2: (2, 0), 3: (2, 1), 4: (2, 1), 5: (2, 0)}


def test_aircraft_record(spark):
    texts = ['{"alt_baro":35000,"lat":1.5}', '{"alt_baro":"ground"}', "{bad", None, '{"alt_baro":null}']
    df = spark.createDataFrame([(text,) for text in texts], "raw_json string")
    rows = df.select(parse_aircraft(F.col("raw_json")).alias("a")).collect()
    assert [(row.a.alt_baro, row.a.lat) if row.a else None for row in rows] == [
        ("35000", 1.5), ("ground", None), (None, None), None, (None, None),
    ]
