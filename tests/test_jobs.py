"""The three jobs from end to end."""

from __future__ import annotations

import datetime
import json
import time

from skyledger.operators.flights import coverage_check, file_coverage
from skyledger.plans.documents import run_document_job, search_chunks
from skyledger.plans.historical import run_historical_job
from skyledger.plans.live import start_live_job
from skyledger.schemas import FLIGHT_LANDING
from skyledger.session import work_dir
from skyledger.sources.documents import parse_json_documents, scan_documents
from skyledger.sources.tables import append_table, change_feed


def test_historical_job(spark, tmp_path):
    for month in range(1, 13):
        lines = ["FlightDate,Reporting_Airline,Origin,Dest,ArrDelay,Cancelled,"]
        lines += [f"2025-{month:02}-{day:02},AA,JFK,LAX,{day},0.00," for day in range(1, 11)]
        (tmp_path / f"{month:02}.csv").write_text("\n".join(lines + lines[1:]) + "\n")
    run_historical_job(spark, str(tmp_path), work_dir(spark, "historical"))
    coverage = file_coverage(spark.table("bts_flights_bronze"))
    assert coverage_check(coverage).first() == (12, 240, True)
    assert spark.table("bts_flights_cleaned").count() == 120
    assert spark.sql("SELECT * FROM get_historical_delay_stats('JFK-LAX', 'AA')").collect() == [("JFK-LAX", "AA", 5.5, 100.0, 120)]


def test_document_job_syncs_the_index(spark, tmp_path):
    def write(name, *contents):
        elements = [{"id": i, "type": "title" if i == 0 else "text", "content": c} for i, c in enumerate(contents)]
        (tmp_path / name).write_text(json.dumps({"document": {"elements": elements}}))

    write("refunds.json", "Refunds", "a refund is paid for a cancelled flight")
    write("bags.json", "Bags", "lost baggage is traced")
    root = work_dir(spark, "documents")
    parsed = lambda: parse_json_documents(scan_documents(spark, str(tmp_path)))
    first = run_document_job(spark, parsed(), root)
    write("bags.json", "Bags", "lost baggage is paid")
    write("pets.json", "Pets", "small animals travel in the cabin")
    second = run_document_job(spark, parsed(), root, previous=first)
    feed = change_feed(*[spark.read.parquet(p["rag_document_chunks_published"]) for p in (first, second)], ["chunk_id"])
    assert sorted(r._change_type for r in feed.collect()) == ["insert", "update_postimage", "update_preimage"]
    from pyspark.ml import PipelineModel

    questions = spark.createDataFrame([(1, "what about lost baggage")], "query_id int, text string")
    hit = search_chunks(questions, spark.table("rag_document_chunks_index"), PipelineModel.load(second["embedder"]), k=1).first()
    assert hit.section == "Bags" and hit.source_document.endswith("/bags.json")
    assert spark.table("rag_document_chunks_index").count() == 3


def test_live_job(spark):
    at = datetime.datetime(2026, 10, 1, 12)
    land = lambda seconds, alt: append_table(
        spark.createDataFrame(
            [(at + datetime.timedelta(seconds=seconds), "UAL123", at.date(), True, json.dumps({"alt_baro": alt}), None)], FLIGHT_LANDING
        ),
        "job_landing", FLIGHT_LANDING, ["flight_date"],
    )
    root = work_dir(spark, "live")
    land(0, 30000)
    queries = start_live_job(spark, "job_landing", root, every="0 seconds")
    read = lambda name: spark.read.parquet(f"{root}/{name}").collect()

    def until(check):
        deadline = time.monotonic() + 90
        while not check():
            assert time.monotonic() < deadline and not any(q.exception() for q in queries)
            time.sleep(0.3)

    try:
        until(lambda: sum(p.numInputRows for p in queries[1].recentProgress) >= 1)
        land(60, "ground")
        until(lambda: sum(p.numInputRows for p in queries[1].recentProgress) >= 2)
    finally:
        for query in queries:
            query.stop()
    assert len(read("live_flight_status")) == 2
    assert [(e.event_type, e.event_timestamp) for e in read("flight_status_events")] == [("landing", at + datetime.timedelta(seconds=60))]
