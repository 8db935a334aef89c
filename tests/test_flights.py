from __future__ import annotations

import datetime

import pytest

from skyledger.functions.lookups import create_lookup_functions
from skyledger.operators.flights import clean_flights, coverage_check, dedup_flights, delay_stats, file_coverage
from skyledger.plans.historical import historical_delay_stats
from skyledger.schemas import FlightColumns
from skyledger.sources import csv_flights
from skyledger.sources.csv_flights import list_csv_files, scan_flight_csvs

SCHEMA = "FlightDate string, Reporting_Airline string, Origin string, Dest string, ArrDelay string, Cancelled string"


def flights(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.fixture()
def csv_folder(tmp_path):
    (tmp_path / "jan.csv").write_text(
        "FlightDate,Reporting_Airline,Origin,Dest,ArrDelay,Cancelled,\n"
        "2025-01-01,AA,JFK,LAX,12.0,0.0,\n2025-01-02,AA,JFK,LAX,late,,\n"
    )
    (tmp_path / "FEB.CSV").write_text(
        "Cancelled,Dest,Origin,Reporting_Airline,FlightDate,Gate,ArrDelay\n1.0,SFO,ORD,UA,2025-02-01,B7,3\n"
    )
    (tmp_path / "notes.txt").write_text("not flights\n")
    return str(tmp_path)


def test_scan_binds_by_name_across_headers(spark, csv_folder):
    df = scan_flight_csvs(spark, csv_folder)
    assert set(df.columns) == {*FlightColumns().all, "Gate", "source_file"}
    assert all(kind == "string" for _, kind in df.dtypes)
    rows = {row.FlightDate: row for row in df.collect()}
    assert rows["2025-02-01"].Origin == "ORD" and rows["2025-02-01"].Gate == "B7"
    assert rows["2025-01-01"].Gate is None and rows["2025-01-01"].source_file == "jan.csv"


def test_scan_with_one_header_refuses_another(spark, csv_folder):
    with pytest.raises(Exception, match="(?i)header|column"):
        scan_flight_csvs(spark, csv_folder, one_header=True).collect()


def test_scan_of_an_empty_folder_fails(spark, tmp_path):
    (tmp_path / "notes.txt").write_text("nothing")
    with pytest.raises(FileNotFoundError):
        scan_flight_csvs(spark, str(tmp_path))


def test_file_listing_and_coverage(spark, csv_folder):
    files = {row.source_file: row.length for row in list_csv_files(spark, csv_folder).collect()}
    assert set(files) == {"jan.csv", "FEB.CSV"} and all(files.values())
    coverage = file_coverage(scan_flight_csvs(spark, csv_folder))
    assert {row.source_file: row.row_count for row in coverage.collect()} == {"jan.csv": 2, "FEB.CSV": 1}
    assert coverage_check(coverage, 2).first().complete
    assert not coverage_check(coverage).first().complete


def test_cleaning_casts_leniently_or_strictly(spark, csv_folder):
    bronze = scan_flight_csvs(spark, csv_folder).select(*FlightColumns().all)
    rows = {row.FlightDate: row for row in clean_flights(bronze).collect()}
    assert rows["2025-01-02"].ArrDelay is None and rows["2025-01-02"].Cancelled == 0.0
    assert rows["2025-02-01"].Cancelled == 1.0
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean_flights(bronze, strict=True).collect()


def test_rows_without_carrier_or_ends_are_dropped(spark):
    df = flights(spark, ("d", None, "A", "B", "1", "0"), ("d", "X", None, "B", "1", "0"), ("d", "X", "A", None, "1", "0"))
    assert clean_flights(df).count() == 0


def test_dedup_does_not_depend_on_partitioning(spark):
    rows = [("d", "AA", "J", "L", str(delay), flag) for delay in (30, 5, 7) for flag in ("1.0", "0.0")]
    rows += [(None, "AA", "J", "L", None, None), (None, "AA", "J", "L", "9", None)]
    for parts in (1, 5):
        kept = {r.FlightDate: (r.ArrDelay, r.Cancelled) for r in clean_flights(flights(spark, *rows).repartition(parts)).collect()}
        assert kept == {"d": (5.0, 0.0), None: (9.0, 0.0)}
    longer = dedup_flights(flights(spark, *rows), key=[*FlightColumns().dedup_key, "ArrDelay"])
    assert longer.count() == 5


def test_selecting_columns_first_does_not_change_the_kept_delay(spark):
    rows = [("d", "AA", "J", "L", "5", "0", gate) for gate in ("z", "a")] + [("d", "AA", "J", "L", "6", "0", "b")]
    df = spark.createDataFrame(rows, SCHEMA + ", gate string")
    assert clean_flights(df).select("ArrDelay", "gate").collect() == [(5.0, "a")]
    assert clean_flights(df.select(*FlightColumns().all)).first().ArrDelay == 5.0


def test_delay_stats(spark):
    rows = [(f"2025-01-{i:02}", "AA", "JFK", "LAX", str(d), "0") for i, d in enumerate([15, 16, 14, 0, 0, 0, 0, 0, 0], 1)]
    rows += [("2025-01-10", "AA", "JFK", "LAX", None, "0"), ("2025-01-11", "AA", "JFK", "LAX", "999", "1")]
    rows += [(f"2025-02-{i:02}", "UA", "ORD", "SFO", "1", None) for i in range(1, 10)]
    stats = historical_delay_stats(flights(spark, *rows))
    assert stats.dtypes == [
        ("route", "string"), ("carrier", "string"), ("avg_delay_minutes", "double"), ("on_time_pct", "double"), ("sample_size", "int"),
    ]
    assert stats.collect() == [("JFK-LAX", "AA", 5.0, 88.9, 10)]


def test_other_column_names(spark):
    names = FlightColumns("day", "airline", "src", "dst", "delay", "gone")
    rows = [(f"{i}", "AA", "A", "B", "20", "0.0") for i in range(10)]
    df = spark.createDataFrame(rows, "day string, airline string, src string, dst string, delay string, gone string")
    assert delay_stats(clean_flights(df, names), names).collect() == [("A-B", "AA", 20.0, 0.0, 10)]


def test_permanent_and_temporary_lookup_functions(spark, tmp_path):
    rows = [("ATL-ORD", "UA", 14.2, 78.5, 3120), ("ATL-ORD", "DL", 9.8, 84.1, 4560), ("JFK-LAX", "AA", 21.6, 69.3, 2890)]
    schema = "route string, carrier string, avg_delay_minutes double, on_time_pct double, sample_size int"
    spark.createDataFrame(rows, schema).write.mode("overwrite").saveAsTable("stats_table")
    at = datetime.datetime(2026, 10, 1, 12)
    status = [("UAL123", at.date(), "on_time", 0, "B12", at), ("UAL123", at.date(), "landed", 0, "B12", at.replace(hour=15))]
    spark.createDataFrame(
        status, "flight_number string, flight_date date, status string, delay_minutes int, gate string, last_updated timestamp"
    ).write.mode("overwrite").saveAsTable("status_table")
    for temporary in (False, True):
        create_lookup_functions(spark, "stats_table", "status_table", temporary)
        count = lambda call: spark.sql(f"SELECT * FROM {call}").count()
        assert count("get_historical_delay_stats('ATL-ORD', NULL)") == 2
        assert count("get_historical_delay_stats(NULL, 'DL')") == 1
        assert count("get_historical_delay_stats(NULL, NULL)") == 3
        assert count("get_historical_delay_stats('ATL-ORD', 'AA')") == 0
        assert count("get_flight_status('UAL123', '2026-10-01')") == 2
        latest = spark.sql("SELECT status FROM get_latest_flight_status('UAL123', '2026-10-01')").collect()
        assert latest == [("landed",)]
        plan = spark.sql("EXPLAIN SELECT * FROM get_historical_delay_stats('ATL-ORD', NULL)").first()[0]
        assert "EqualTo(route,ATL-ORD)" in plan
        if not temporary:
            spark.sql("DROP FUNCTION get_historical_delay_stats")
            spark.sql("DROP FUNCTION get_flight_status")
            spark.sql("DROP FUNCTION get_latest_flight_status")


def test_scan_reads_past_a_blank_first_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("\n  \ny,x\n3,4\n")
    (tmp_path / "empty.csv").write_text("")
    rows = scan_flight_csvs(spark, str(tmp_path)).select("x", "y").collect()
    assert sorted(map(tuple, rows)) == [("1", "2"), ("4", "3")]
    (tmp_path / "c.csv").write_text("\n \n")
    with pytest.raises(ValueError, match="no header"):
        scan_flight_csvs(spark, str(tmp_path))


def bytes_read(spark):
    """Bytes that Spark's readers have read so far, by its own metrics."""
    context = spark.sparkContext
    nothing = context._gateway.new_array(context._jvm.double, 0)
    stages = context._jsc.sc().statusStore().stageList(None, False, False, nothing, context._jvm.java.util.ArrayList())
    return sum(stages.apply(at).inputBytes() for at in range(stages.size()))


def test_bodies_are_read_once(spark, tmp_path):
    for number in range(3):
        header = "a,b\n" if number else "\n b,a,\n"
        (tmp_path / f"{number} +.csv").write_text(header + "1,2\n" * 200_000)
    before = bytes_read(spark)
    rows = scan_flight_csvs(spark, str(tmp_path))
    ahead = bytes_read(spark) - before
    assert rows.groupBy("source_file").count().count() == 3
    size = sum(path.stat().st_size for path in tmp_path.iterdir())
    assert ahead < size / 10 and bytes_read(spark) - before < 1.2 * size


def test_headers_are_found_in_small_pieces_and_by_scanning(spark, tmp_path, monkeypatch):
    texts = ["a,b\r\n1,2", "\n \t\n" + "long," * 50 + "é\n1", "only", "x,y\n", "﻿q,r\n1,2\n"]
    for number, text in enumerate(texts):
        (tmp_path / f"f{number} é.csv").write_bytes(text.encode())
    wanted = ["a,b", "long," * 50 + "é", "only", "x,y", "q,r"]
    for size in (1, 7, 16 << 10):
        monkeypatch.setattr(csv_flights, "HEAD_BYTES", size)
        found = csv_flights._headers(spark, str(tmp_path))
        assert sorted(found) == sorted(wanted)
    files = list_csv_files(spark, str(tmp_path)).select("path")
    scanned = {row.path: row.header.lstrip("﻿") for row in csv_flights._scanned_headers(spark, str(tmp_path), files).collect()}
    assert scanned == {path: header for header, paths in found.items() for path in paths}
