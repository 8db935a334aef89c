"""Departures and landings from a stream of status snapshots."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.live import FLIGHT_KEY, event_type, time_slice

# Fixed value: a flight without readings for four hours is forgotten.
STATE_TTL_MS = 4 * 60 * 60 * 1000

_READING = "flight_number string, flight_date date, status string, last_updated timestamp"
_CHANGE = "flight_number string, date string, at timestamp, previous string, new string"


def _drop_repeats(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Keep the first and last reading of each slice, and those that differ from the one before."""
    parts = list(batches)
    if not parts:
        return
    group = [*FLIGHT_KEY, "_slice"]
    rows = pd.concat(parts, ignore_index=True)
    rows = rows.sort_values([*group, "last_updated", "status"], kind="stable")
    slices = rows.groupby(group, dropna=False, sort=False)["status"]
    before, after = slices.shift(1), slices.shift(-1)
    yield rows[(before != rows["status"]) | after.isna()].drop(columns="_slice")


def thin_readings(status: DataFrame, slice_seconds: float = 60) -> DataFrame:
    """Readings of a micro-batch without those that cannot start an event.

    Readings are spread by flight and slice of time, so a flight with a large share of the stream
    is thinned by many tasks before its changes meet in the one task that holds its state.
    """
    sliced = status.select(
        *FLIGHT_KEY, "status", "last_updated", time_slice(F.col("last_updated"), slice_seconds).alias("_slice")
    )
    return sliced.repartition(*FLIGHT_KEY, "_slice").mapInPandas(_drop_repeats, _READING)


# Last status of each flight of a bucket, and when it was seen: microseconds of event time where there is a
# watermark, else milliseconds of processing time.
_STATE = "flights array<struct<number: string, date: string, status: string, seen: bigint>>"


def _follow(ttl_ms: int, event_time: bool):
    """Follows the flights of one bucket; the state is the last status of each of them."""
    ttl = ttl_ms * 1000 if event_time else ttl_ms

    def follow(_, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now_ms = state.getCurrentWatermarkMs() if event_time else state.getCurrentProcessingTimeMs()
        now = now_ms * 1000 if event_time else now_ms
        last = {(number, date): (status, seen) for number, date, status, seen in (state.get[0] if state.exists else ())}
        readings: list[tuple] = []
        for batch in batches:
            at = batch["last_updated"].to_numpy("datetime64[us]").astype("int64").tolist()
            readings += zip(at, batch["status"].tolist(), batch["flight_number"].tolist(), batch["date"].tolist())
        readings.sort(key=lambda reading: reading[:2])
        changes = []
        for at, status, number, date in readings:
            moment = at if event_time else now
            previous, seen = last.get((number, date), (None, moment))
            if previous is not None and status != previous and moment - seen <= ttl:
                changes.append((number, date, at, previous, status))
            last[number, date] = (status, moment)
        # Every later reading that is not late is more than the time to live away from these.
        kept = [(*flight, *entry) for flight, entry in last.items() if entry[1] + ttl >= now]
        if kept:
            state.update((kept,))
            if event_time:
                newest_ms = max(entry[3] for entry in kept) // 1000
                state.setTimeoutTimestamp(max(newest_ms + ttl_ms, now_ms) + 1)
            else:
                state.setTimeoutDuration(ttl_ms)
        elif state.exists:
            state.remove()
        if changes:
            found = pd.DataFrame(changes, columns=["flight_number", "date", "at", "previous", "new"])
            yield found.assign(at=pd.to_datetime(found["at"], unit="us"))

    return follow


def flight_status_events(
    status: DataFrame,
    ttl_ms: int = STATE_TTL_MS,
    watermark: str | None = None,
    slice_seconds: float = 60,
    buckets: int = 1024,
) -> DataFrame:
    """Every change of a flight's status against its last known one, across micro-batches.

    The first reading of a flight gives no event. Readings of one micro-batch are put in time order,
    equal times by status, and compared after those of earlier ones: a late reading counts as the newest.

    By default a flight without readings for ``ttl_ms`` of processing time is forgotten. With
    ``watermark`` a reading up to that delay behind the newest of earlier micro-batches is dropped, and a
    flight is forgotten when two of its readings lie more than ``ttl_ms`` apart, however they fall into
    micro-batches. Readings are then not thinned ahead, as a late one could stand for one in time.

    Flights are followed in ``buckets`` groups, as calling Python once per flight costs more than the
    work itself. The number bounds the tasks that can run at a time and must stay the same for the
    life of a checkpoint.

    Without a watermark run it with a processing-time trigger: a pending timeout keeps an
    ``availableNow`` run alive. A micro-batch bounds what one task holds, so bound it at the source (files or bytes per trigger).
    """
    if watermark:
        readings = status.select(*FLIGHT_KEY, "status", "last_updated").withWatermark("last_updated", watermark)
        timeout = GroupStateTimeout.EventTimeTimeout
    else:
        readings = thin_readings(status, slice_seconds)
        timeout = GroupStateTimeout.ProcessingTimeTimeout
    bucket = F.pmod(F.xxhash64(*FLIGHT_KEY), F.lit(buckets)).cast("int")
    keyed = readings.select(
        bucket.alias("bucket"), "flight_number", F.col("flight_date").cast("string").alias("date"),
        "status", "last_updated",
    )
    changes = keyed.groupBy("bucket").applyInPandasWithState(
        _follow(ttl_ms, watermark is not None), _CHANGE, _STATE, "append", timeout
    )
    return changes.select(
        "flight_number",
        F.col("date").cast("date").alias("flight_date"),
        event_type(F.col("previous"), F.col("new")).alias("event_type"),
        F.col("at").alias("event_timestamp"),
        F.col("previous").alias("previous_status"),
        F.col("new").alias("new_status"),
    )
