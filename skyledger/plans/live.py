"""Live job: polled responses to status snapshots and status events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.live import live_flight_status
from ..sources.landing import land_flight_polls
from ..sources.tables import read_folder_stream, read_landing_stream
from ..streaming.alerts import fired_schema, first_matches, match_writer
from ..streaming.status_events import STATE_TTL_MS, flight_status_events


def status_of_responses(responses: DataFrame) -> DataFrame:
    """Status snapshots straight from responses; batch or stream."""
    return live_flight_status(land_flight_polls(responses))


def start_live_job(
    spark: SparkSession,
    landing_table: str,
    root: str,
    every: str = "10 seconds",
    ttl_ms: int = STATE_TTL_MS,
    watermark: str | None = None,
    load_watches: Callable[[], DataFrame] | None = None,
    load_alerts: Callable[[], DataFrame] | None = None,
) -> list[StreamingQuery]:
    """Start the streams: landing rows to ``live_flight_status``, and these to ``flight_status_events``.

    Both are parquet folders below ``root``, written exactly once; checkpoints lie next to them. Given
    the current watches and alerts, two more streams match landings with them and write every fired alert
    once to ``fired_alerts``.
    """
    root = root.rstrip("/")

    def start(df: DataFrame, name: str) -> StreamingQuery:
        writer = df.writeStream.queryName(name).option("checkpointLocation", f"{root}/_checkpoints/{name}")
        return writer.partitionBy("flight_date").trigger(processingTime=every).format("parquet").start(f"{root}/{name}")

    status = live_flight_status(read_landing_stream(spark, landing_table))
    folder = f"{root}/live_flight_status"
    spark.createDataFrame([], status.schema).write.mode("append").parquet(folder)
    snapshots = read_folder_stream(spark, folder, status.schema, partition_by=["flight_date"])
    events = flight_status_events(snapshots, ttl_ms, watermark)
    queries = [start(status, "live_flight_status"), start(events, "flight_status_events")]
    if load_watches and load_alerts:
        folder = f"{root}/flight_status_events"
        spark.createDataFrame([], events.schema).write.mode("append").partitionBy("flight_date").parquet(folder)
        landings = read_folder_stream(spark, folder, events.schema, partition_by=["flight_date"])
        matched = f"{root}/matched_alerts"
        writer = match_writer(landings, load_watches, load_alerts, matched).queryName("matched_alerts")
        writer = writer.option("checkpointLocation", f"{root}/_checkpoints/matched_alerts")
        queries.append(writer.trigger(processingTime=every).start())
        fired = first_matches(spark, matched, fired_schema(load_watches(), load_alerts(), events))
        writer = fired.writeStream.queryName("fired_alerts").option("checkpointLocation", f"{root}/_checkpoints/fired_alerts")
        queries.append(writer.trigger(processingTime=every).format("parquet").start(f"{root}/fired_alerts"))
    return queries
