from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from skyledger.operators import metrics, transcripts
from skyledger.session import work_dir
from skyledger.sources.tables import change_feed, publish_table

AT = datetime.datetime(2026, 10, 1, 12, 30)


def test_publish_swaps_versions_and_feeds_changes(spark):
    root = work_dir(spark, "published")
    make = lambda rows: spark.createDataFrame(rows, "id int, a string, b double")
    first = publish_table(make([(1, "x", 1.0), (2, "y", None), (3, None, 3.0)]), "published", root)
    assert spark.table("published").count() == 3
    second = publish_table(make([(1, "x", 1.0), (2, "y", 2.0), (4, None, None)]), "published", root)
    assert {r.id for r in spark.table("published").collect()} == {1, 2, 4}
    again = publish_table(spark.table("published").filter("id = 4"), "published", root)
    assert len({first, second, again}) == 3 and spark.table("published").count() == 1
    feed = change_feed(spark.read.parquet(first), spark.read.parquet(second), ["id"])
    assert sorted(feed.collect(), key=repr) == sorted([
        (2, "y", None, "update_preimage"), (2, "y", 2.0, "update_postimage"), (3, None, 3.0, "delete"), (4, None, None, "insert"),
    ], key=repr)


def test_metric_edges(spark):
    rows = [(1, b"u1", None, "success", AT, "insert"), (2, b"u1", "mcp::x", "error", AT, "insert"),
            (3, b"u2", "add", "odd", AT, "insert"), (4, b"u3", "add", "success", AT, "update")]
    log = spark.createDataFrame(
        rows, "action_id int, user_id binary, action_type string, result_status string, created_at timestamp, _pg_change_type string")
    assert {r.tool_source: r.event_count for r in metrics.tool_source_split(log).collect()} == {"custom": 2, "mcp": 1}
    assert [r.active_users for r in metrics.active_users_per_day(log).collect()] == [2]
    assert {r.action_type: (r.success, r.error) for r in metrics.outcome_pivot(log).collect()} == {None: (1, 0), "mcp::x": (0, 1), "add": (0, 0)}
    assert metrics.calls_per_hour(log).first() == (AT.replace(minute=0), 3)
    assert [r.action_type for r in metrics.recent_activity(log, 2).collect()] == ["add", "mcp::x"]
    assert metrics.user_action_log(log.withColumn("user_id", F.lit(5)), 5).count() == 4


def test_alert_metrics_disagree_by_design(spark):
    rows = [("triggered", kind, AT) for kind in ("insert", "update", "update", "update_postimage", "delete")] + [("active", "update", AT)]
    alerts = spark.createDataFrame(rows, "status string, _pg_change_type string, _timestamp timestamp")
    assert metrics.alerts_per_hour(alerts).first().alerts_triggered == 2
    assert metrics.alerts_per_hour(alerts, metrics.DASHBOARD_ALERT_CHANGES).first().alerts_triggered == 2
    assert metrics.alerts_per_hour(alerts, ("insert", "update", "update_postimage")).first().alerts_triggered == 4


def test_routes_break_ties_by_name(spark):
    rows = [("B", "C", "insert")] * 2 + [("A", "C", "insert")] * 2 + [("Z", "Z", "insert")] * 3 + [(None, "C", "insert")] * 9 + [("A", "A", "update")] * 9
    watches = spark.createDataFrame(rows, "origin_airport string, destination_airport string, _pg_change_type string")
    assert metrics.most_watched_routes(watches, 2).collect() == [("Z", "Z", 3), ("A", "C", 2)]


def test_message_text(spark):
    block = "array<struct<type string, text string>>"
    rows = [("plain", None, "plain"), (None, [("text", "a"), ("tool_use", "x"), ("text", None), ("text", "b")], "ab"), (None, None, ""), (None, [], "")]
    df = spark.createDataFrame(rows, f"content string, blocks {block}, wanted string")
    assert df.filter(transcripts.message_text(F.col("content"), F.col("blocks")) != F.col("wanted")).count() == 0
    texts = [('"hi"', "hi"), ('[{"type":"text","text":"a","id":1},{"type":"tool_use","input":{}},{"type":"text"},{"type":"text","text":"b"}]', "ab"),
             ("{}", ""), ("7", ""), ("null", ""), (None, "")]
    df = spark.createDataFrame(texts, "content string, wanted string")
    text = transcripts.message_text_json(F.try_parse_json("content"))
    assert df.select(text.alias("t"), "wanted").filter("t IS NULL OR t <> wanted").count() == 0


def test_turns_and_replies(spark):
    rows = [(1, 0, "human", "q"), (1, 1, "ai", "first"), (1, 2, "tool", "noise"), (1, 3, "ai", ""), (2, 0, "user", "only"),
            (3, 0, "assistant", "a"), (3, 1, "assistant", "b"), (3, 2, "user", "c")]
    messages = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    assert sorted((r.conv_id, r.turn, r.role) for r in transcripts.visible_turns(messages).collect()) == [
        (1, 0, "user"), (1, 1, "assistant"), (2, 0, "user"), (3, 0, "assistant"), (3, 1, "assistant"), (3, 2, "user")]
    assert dict(transcripts.latest_reply(messages).collect()) == {1: "", 2: "", 3: "b"}


def test_clean_blocks(spark):
    rows = [([("text", None, "1"), ("tool_use", None, "2"), (None, "x", "3")],)]
    df = spark.createDataFrame(rows, "blocks array<struct<type string, text string, id string>>")
    cleaned = df.select(F.to_json(transcripts.clean_blocks(F.col("blocks"), ["type", "text", "id"]))).first()[0]
    assert cleaned == '[{"type":"text","text":""},{"type":"tool_use","id":"2"},{"text":"x","id":"3"}]'
