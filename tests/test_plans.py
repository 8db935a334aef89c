"""Properties of the physical plans that keep frequent keys and large tables apart."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyledger.operators.flights import dedup_flights
from skyledger.operators.joins import join_unique
from skyledger.operators.live import live_flight_status, status_transitions
from skyledger.operators.state import current_state
from skyledger.plans.registry import QUERIES
from skyledger.schemas import FLIGHT_LANDING

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df, executed=False) -> str:
    plan = df._jdf.queryExecution().executedPlan()
    if executed:
        plan.execute().count()
    return plan.toString()


@pytest.fixture()
def settings(spark):
    changed = {}

    def change(**values):
        for key, value in values.items():
            name = "spark.sql." + key.replace("__", ".")
            changed.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield change
    for name, value in changed.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("name", [name for name in QUERIES if not name.endswith("_stream")])
def test_no_cross_join_and_no_single_partition_of_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    window_over_everything = [line for line in plan.splitlines() if "Window [" in line and "], [], [" in line]
    assert not window_over_everything


def test_a_frequent_key_is_split_by_the_join(spark, settings):
    settings(
        shuffle__partitions="32",
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        adaptive__advisoryPartitionSizeInBytes="50KB",
    )
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
    rows = spark.range(0, 300_000, 1, 16).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    sizes = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = join_unique(rows, sizes, ["k"])
    assert "skew=true" in plan_of(joined, executed=True)
    assert joined.count() == 300_000


@pytest.mark.parametrize("fold", [
    lambda spark: dedup_flights(spark.createDataFrame([], "FlightDate string, Reporting_Airline string, Origin string, Dest string, ArrDelay double, Cancelled double")),
    lambda spark: current_state(spark.createDataFrame([], "id int, v string, _pg_change_type string, _timestamp timestamp"), ["id"]),
])
def test_first_row_per_key_is_cut_before_the_shuffle(spark, fold):
    lines = [line for line in plan_of(fold(spark)).splitlines() if "WindowGroupLimit" in line or "Exchange" in line]
    assert "Final" in lines[0] and "Exchange" in lines[1] and "Partial" in lines[2]


def test_transitions_shuffle_by_slice(spark):
    schema = "flight_number string, flight_date date, status string, last_updated timestamp"
    plan = plan_of(status_transitions(spark.createDataFrame([], schema)))
    assert "_slice" in plan and plan.count("Exchange hashpartitioning(flight_number") <= 3


def test_a_record_is_parsed_once(spark, tmp_path):
    spark.createDataFrame([], FLIGHT_LANDING).write.parquet(str(tmp_path / "landing"))
    status = live_flight_status(spark.read.parquet(str(tmp_path / "landing")))
    plan = plan_of(status.filter("status = 'in_air' AND lat IS NOT NULL"))
    assert plan.count("from_json") + plan.count("JsonToStructsEvaluator") == 1
    assert "PushedFilters: [IsNotNull(found), EqualTo(found,true)]" in plan
    assert "ReadSchema: struct<ingested_at:timestamp,flight_number:string,flight_date:date,found:boolean,raw_json:string>" in plan


def test_statistics_read_only_their_columns(spark, tmp_path):
    from skyledger.plans.historical import historical_delay_stats

    wide = "FlightDate string, Reporting_Airline string, Origin string, Dest string, ArrDelay string, Cancelled string, Gate string, Tail string"
    spark.createDataFrame([], wide).write.parquet(str(tmp_path / "bronze"))
    plan = plan_of(historical_delay_stats(spark.read.parquet(str(tmp_path / "bronze"))))
    assert "Tail" not in plan and "IsNotNull(Origin)" in plan
