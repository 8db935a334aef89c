from __future__ import annotations

import datetime
import random
import time

import pytest
from pyspark.sql import functions as F

from skyledger.operators.live import status_transitions
from skyledger.operators.state import ALERT_COLUMNS, WATCH_COLUMNS
from skyledger.session import work_dir
from skyledger.sources.landing import observe_polls, observed_polls
from skyledger.sources.tables import append_table, read_folder_stream, read_landing_stream
from skyledger.schemas import FLIGHT_LANDING
from skyledger.streaming.alerts import fired_schema, first_matches, match_writer
from skyledger.streaming.run import drain, run_available
from skyledger.streaming.sinks import BATCH, batch_sink, commit_folder, committed
from skyledger.streaming.status_events import flight_status_events, thin_readings

from .test_live import DAY, STATUS, at, brute_transitions


def stream_events(spark, batches, pause=0.0, **options):
    """Events of a stream that reads each list of rows as one micro-batch."""
    folder = work_dir(spark, "stream")
    names = [name.split()[0] for name in STATUS.split(", ")]
    schema = spark.createDataFrame([], STATUS).schema
    spark.createDataFrame([], STATUS).write.parquet(f"{folder}/empty")

    def land(rows):
        spark.createDataFrame(rows, STATUS).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    land(batches[0])
    events = flight_status_events(read_folder_stream(spark, f"{folder}/in", schema, files_per_batch=1), buckets=8, **options)
    query = (
        events.writeStream.option("checkpointLocation", f"{folder}/check").trigger(processingTime="0 seconds")
        .format("parquet").start(f"{folder}/out")
    )
    done = 0
    try:
        for number, rows in enumerate(batches):
            if number:
                time.sleep(pause)
                land(rows)
            done += len(rows)
            wait_for(query, done)
    finally:
        query.stop()
    assert len(names) == 6
    return sorted((tuple(row) for row in spark.read.parquet(f"{folder}/out").collect()), key=repr)


def wait_for(query, rows):
    deadline = time.monotonic() + 120
    seen = {}
    while time.monotonic() < deadline:
        assert query.exception() is None, query.exception()
        for progress in query.recentProgress:
            seen[progress.batchId] = progress.numInputRows
        if sum(seen.values()) >= rows:
            return
        time.sleep(0.1)
    raise TimeoutError


def reading(number, status, seconds):
    return (number, DAY, status, None, None, at(seconds))


def test_state_crosses_batches(spark):
    draw = random.Random(5)
    batches = []
    for part in range(3):
        batches.append([
            reading(number, draw.choice(["on_ground", "in_air"]), part * 1000 + draw.randrange(1000))
            for number in ("a", "b", None) for _ in range(60)
        ])
    assert stream_events(spark, batches) == brute_transitions([row for rows in batches for row in rows])


def test_late_reading_counts_as_newest(spark):
    batches = [[reading("a", "in_air", 100)], [reading("a", "on_ground", 50)]]
    assert stream_events(spark, batches) == [("a", DAY, "landing", at(50), "in_air", "on_ground")]


def test_state_expires_by_processing_time(spark):
    batches = [[reading("a", "in_air", 0)], [reading("a", "on_ground", 10)], [reading("a", "in_air", 20)]]
    assert len(stream_events(spark, batches)) == 2
    assert stream_events(spark, batches, pause=6, ttl_ms=1000) == []


def test_watermark_drops_late_readings_and_expires_by_event_time(spark):
    batches = [
        [reading("a", "in_air", 10_000)],
        [reading("a", "in_air", 10_010)],
        [reading("a", "on_ground", 50), reading("b", "in_air", 10_020)],  # the reading of a is late
        [reading("a", "on_ground", 10_030)],
        [reading("c", "in_air", 90_000)],
        [reading("c", "in_air", 90_001)],
        [reading("b", "on_ground", 90_002)],  # b was forgotten
    ]
    events = stream_events(spark, batches, watermark="1 minute", ttl_ms=3_600_000)
    assert events == [("a", DAY, "landing", at(10_030), "in_air", "on_ground")]


def test_thinning_keeps_every_change(spark):
    draw = random.Random(3)
    rows = [reading("hot", draw.choice(["on_ground"] * 9 + ["in_air"]), draw.randrange(4000)) for _ in range(3000)]
    thin = thin_readings(spark.createDataFrame(rows, STATUS))
    kept = [(r.flight_number, r.flight_date, r.status, None, None, r.last_updated) for r in thin.collect()]
    assert len(kept) < len(rows)
    assert brute_transitions(kept) == brute_transitions(rows)


def test_stream_of_an_appended_table(spark):
    landed = [(at(0), "a", DAY, True, '{"alt_baro":"ground"}', None), (at(9), "b", DAY, False, None, "timeout")]
    for row in landed:
        append_table(spark.createDataFrame([row], FLIGHT_LANDING), "flight_landing", FLIGHT_LANDING, ["flight_date"])
    assert spark.table("flight_landing").count() == 2
    query = (
        read_landing_stream(spark, "flight_landing").writeStream.trigger(availableNow=True)
        .option("checkpointLocation", work_dir(spark, "check")).format("memory").queryName("landed").start()
    )
    query.awaitTermination()
    assert spark.table("landed").count() == 2
    with pytest.raises(Exception, match="found must not be NULL"):
        bad = spark.createDataFrame([(at(0), "a", DAY)], "ingested_at timestamp, flight_number string, flight_date date")
        bad = bad.withColumns({"found": F.lit(None).cast("boolean"), "raw_json": F.lit(""), "poll_error": F.lit("")})
        append_table(bad, "flight_landing", FLIGHT_LANDING, ["flight_date"])


def test_landings_fire_alerts_once(spark):
    folder = work_dir(spark, "alerts")
    watches = spark.createDataFrame(
        [(1, 9, "a", DAY, None, None, "active", at(0), at(0)), (2, 9, "a", DAY, None, None, "cancelled", at(0), at(0))],
        "watch_id int, user_id int, flight_number string, flight_date date, origin_airport string, "
        "destination_airport string, status string, created_at timestamp, updated_at timestamp",
    ).select(*WATCH_COLUMNS)
    alerts = spark.createDataFrame(
        [(10, 1, "status_change", None, "active", None, None, at(0), "insert", at(0)),
         (11, 1, "gate_change", None, "active", None, None, at(0), "insert", at(0)),
         (12, 2, "status_change", None, "active", None, None, at(0), "insert", at(0)),
         (13, 1, "status_change", None, "cancelled", None, None, at(0), "update", at(1))],
        "alert_id int, watch_id int, alert_type string, threshold_minutes int, status string, next_fire_at timestamp, "
        "triggered_at timestamp, created_at timestamp, _pg_change_type string, _timestamp timestamp",
    ).drop("_pg_change_type", "_timestamp")
    event_ddl = ("flight_number string, flight_date date, event_type string, event_timestamp timestamp, "
                 "previous_status string, new_status string")
    schema = spark.createDataFrame([], event_ddl).schema
    for seconds in (200, 100, 300):
        rows = [("a", DAY, "landing", at(seconds), "in_air", "on_ground"), ("a", DAY, "departure", at(seconds + 5), "on_ground", "in_air")]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = read_folder_stream(spark, f"{folder}/in", schema, files_per_batch=1)
    out = fired_schema(watches, alerts, stream)
    for start in range(2):  # a new checkpoint of the matching stream neither erases nor fires again
        run_available(match_writer(stream, lambda: watches, lambda: alerts, f"{folder}/matched"), f"{folder}/check{start}")
        fired = first_matches(spark, f"{folder}/matched", out, files_per_batch=1)
        run_available(fired.writeStream.format("parquet").option("path", f"{folder}/fired"), f"{folder}/check-fired")
    fired = spark.read.parquet(f"{folder}/fired").select(*ALERT_COLUMNS, "_pg_change_type", "_timestamp").collect()
    assert [(r.alert_id, r.status, r.triggered_at, r._pg_change_type) for r in fired] == [(10, "triggered", at(200), "update")]
    assert committed(spark, f"{folder}/matched", out).count() == 6


def test_a_folder_is_committed_once_and_whole(spark):
    folder = work_dir(spark, "commits")
    assert commit_folder(spark.range(5), folder, f"{BATCH}=a-0")
    assert not commit_folder(spark.range(9), folder, f"{BATCH}=a-0")
    assert not commit_folder(spark.range(0), folder, f"{BATCH}=a-1")
    with pytest.raises(Exception, match="half"):
        broken = spark.range(100, numPartitions=4).select(F.when(F.col("id") < 60, F.col("id")).otherwise(F.raise_error(F.lit("half")).cast("long")).alias("id"))
        commit_folder(broken, folder, f"{BATCH}=a-2")
    assert commit_folder(spark.range(5, 7), folder, f"{BATCH}=a-2")
    assert sorted(row.id for row in committed(spark, folder, "id long").collect()) == list(range(7))
    assert committed(spark, work_dir(spark, "nothing"), "id long").count() == 0


def test_a_batch_run_again_is_not_written_again(spark):
    folder = work_dir(spark, "again")
    for number in range(4):
        spark.range(number * 10, number * 10 + 10).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = read_folder_stream(spark, f"{folder}/in", spark.range(0).schema, files_per_batch=1)
    ran = []
    sink = batch_sink(f"{folder}/out", lambda batch: (ran.append(1), batch)[1])

    def failing(batch, number):
        sink(batch, number)
        if number == 2:
            raise RuntimeError("after the write")

    with pytest.raises(Exception, match="after the write"):
        run_available(stream.writeStream.foreachBatch(failing), f"{folder}/check")
    assert committed(spark, f"{folder}/out", "id long").count() == 30
    run_available(stream.writeStream.foreachBatch(sink), f"{folder}/check")
    assert sorted(row.id for row in committed(spark, f"{folder}/out", "id long").collect()) == list(range(40))
    assert len(committed(spark, f"{folder}/out", "id long").inputFiles()) == 4


def brute_followed(batches, delay, ttl):
    """Events of readings in micro-batches: late ones dropped, long gaps forgotten."""
    last, events, newest = {}, [], None
    for rows in batches:
        watermark = None if newest is None else newest - delay
        for number, date, status, _, _, moment in sorted(rows, key=lambda row: (row[5], row[2])):
            seconds = (moment - at(0)).total_seconds()
            if watermark is not None and seconds <= watermark:
                continue
            before = last.get(number)
            if before and before[0] != status and seconds - before[1] <= ttl:
                kind = "departure" if status == "in_air" else "landing"
                events.append((number, date, kind, moment, before[0], status))
            last[number] = (status, seconds)
        newest = max([newest or 0, *[(row[5] - at(0)).total_seconds() for row in rows]])
    return sorted(events, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_late_readings_and_gaps_against_brute_force(spark, seed):
    draw = random.Random(seed)
    folder = work_dir(spark, "late")
    schema = spark.createDataFrame([], STATUS).schema
    batches = []
    for part in range(4):
        moments = [draw.randrange(max(0, part * 1000 - 900), part * 1000 + 1000) for _ in range(250)]
        batches.append([reading(draw.choice("abcdefghij"), draw.choice(["on_ground", "in_air"]), moment) for moment in moments])
    for rows in batches:
        spark.createDataFrame(rows, STATUS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = read_folder_stream(spark, f"{folder}/in", schema, files_per_batch=1)
        events = flight_status_events(stream, ttl_ms=60_000, watermark="300 seconds", buckets=4)
        run_available(events.writeStream.format("parquet").option("path", f"{folder}/out"), f"{folder}/check")
    found = sorted((tuple(row) for row in spark.read.parquet(f"{folder}/out").collect()), key=repr)
    assert found == brute_followed(batches, 300, 60)
    assert found != brute_followed(batches, 10**9, 60) and found != brute_followed(batches, 300, 10**9)


def test_batch_expiry_is_the_stream_without_late_readings(spark):
    draw = random.Random(4)
    rows = [reading(draw.choice("ab"), draw.choice(["on_ground", "in_air"]), draw.randrange(9000)) for _ in range(400)]
    for ttl in (5, 40, 4000):
        found = status_transitions(spark.createDataFrame(rows, STATUS), slice_seconds=30, ttl_seconds=ttl)
        assert sorted((tuple(row) for row in found.collect()), key=repr) == brute_followed([rows], 10**9, ttl)


def test_polls_are_counted_while_they_pass(spark):
    folder = work_dir(spark, "polls")
    for number, found in enumerate([[True, False, True], [False], [True]]):
        rows = [(at(number * 10), "a", DAY, one, None, None) for one in found]
        spark.createDataFrame(rows, FLIGHT_LANDING).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = observe_polls(read_folder_stream(spark, f"{folder}/in", FLIGHT_LANDING, files_per_batch=1))
    query = run_available(stream.writeStream.format("parquet").option("path", f"{folder}/out"), f"{folder}/check")
    micros = [int(at(second).replace(tzinfo=datetime.timezone.utc).timestamp() * 1_000_000) for second in (0, 10, 20)]
    assert observed_polls(query) == [(0, micros[0], 3, 2), (1, micros[1], 1, 0), (2, micros[2], 1, 1)]
