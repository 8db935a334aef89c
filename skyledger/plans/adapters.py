"""Domain tables derived from the generic test tables, as SQL that runs in any engine.

Each statement names its inputs in braces, as test tables or as other adapters.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

ADAPTERS = {
    "flights": """
        SELECT CAST(o_orderdate AS DATE) AS FlightDate, concat(l_returnflag, l_linestatus) AS Reporting_Airline,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE sn.n_name END AS Origin, cn.n_name AS Dest,
               CASE WHEN l_discount > 0.095 THEN NULL ELSE l_quantity - 10 END AS ArrDelay,
               CASE WHEN l_tax > 0.075 THEN 1.0E0 WHEN l_tax > 0.065 THEN NULL ELSE 0.0E0 END AS Cancelled
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
        JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} sn ON s_nationkey = sn.n_nationkey
        JOIN {customer} ON o_custkey = c_custkey JOIN {nation} cn ON c_nationkey = cn.n_nationkey""",
    # Rare large values stand for the ways a poll can fail.
    "flight_responses": """
        SELECT ts AS ingested_at, concat('FL', CAST(user_id AS VARCHAR(20))) AS flight_number,
               CAST(ts AS DATE) AS flight_date,
               CASE WHEN value > 250 AND value <= 300 THEN 'timeout' END AS request_error,
               CASE WHEN value > 300 THEN '{"ac":'
                    WHEN value > 250 THEN NULL
                    WHEN value > 200 THEN '{"ac":null}'
                    WHEN value > 180 THEN '[]'
                    WHEN value > 160 THEN '["x"]'
                    WHEN event_type = 'signup' THEN '{"ac":[]}'
                    ELSE concat('{"ac":[{"flight":"FL', CAST(user_id AS VARCHAR(20)), '","alt_baro":',
                                CASE WHEN event_type IN ('view', 'click') THEN '"ground"'
                                     ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR(20)) END,
                                ',"lat":', CASE WHEN value > 100 THEN 'null'
                                                ELSE CAST(CAST(floor(value) AS BIGINT) % 90 AS VARCHAR(20)) END,
                                ',"lon":', CAST(user_id % 180 AS VARCHAR(20)), '},{"alt_baro":"ground"}]}')
               END AS body
        FROM {events}""",
    "area_responses": """
        SELECT ts AS ingested_at, 33.5E0 AS query_lat, -84.25E0 AS query_lon,
               CAST(user_id % 50 AS INT) AS query_radius_nm,
               CASE WHEN event_type = 'error' THEN '{"ac":null}'
                    WHEN event_type = 'signup' THEN 'none'
                    WHEN event_type = 'view' THEN concat('{"ac":[{"alt_baro":', CAST(event_id AS VARCHAR(20)), '}]}')
                    ELSE concat('{"ac":[{"alt_baro":', CAST(event_id AS VARCHAR(20)), '},{"alt_baro":"ground"}]}')
               END AS body
        FROM {events}""",
    "action_log_history": """
        SELECT event_id AS action_id, user_id,
               CASE WHEN event_type IN ('view', 'click') THEN concat('mcp::', event_type) ELSE event_type END AS action_type,
               CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS result_status,
               ts AS created_at, ts AS _timestamp,
               CASE WHEN event_id % 10 = 9 THEN 'update' WHEN event_id % 10 = 8 THEN 'update_postimage'
                    ELSE 'insert' END AS _pg_change_type
        FROM {events}""",
    "watched_flights_history": """
        SELECT o_orderkey AS watch_id, o_custkey AS user_id, concat('FL', CAST(o_orderkey % 150 AS VARCHAR(20))) AS flight_number,
               CAST(o_orderdate AS DATE) AS flight_date,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE concat('AP', CAST(c_nationkey AS VARCHAR(20))) END AS origin_airport,
               concat('AP', CAST(o_orderkey % 25 AS VARCHAR(20))) AS destination_airport,
               CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'completed' ELSE 'cancelled' END AS status,
               o_orderdate AS created_at, o_orderdate AS updated_at,
               o_orderdate AS _timestamp, CASE WHEN o_orderkey % 10 = 9 THEN 'update' ELSE 'insert' END AS _pg_change_type
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "alerts_history": """
        SELECT l_orderkey AS alert_id, l_orderkey AS watch_id,
               CASE l_orderkey % 4 WHEN 0 THEN 'delay_threshold' WHEN 1 THEN 'gate_change' WHEN 2 THEN 'status_change'
                    ELSE 'cancellation' END AS alert_type,
               CAST(CASE WHEN l_orderkey % 4 = 0 THEN 30 END AS INT) AS threshold_minutes,
               CASE l_orderkey % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'triggered' ELSE 'cancelled' END AS status,
               CAST(NULL AS TIMESTAMP) AS next_fire_at, CAST(NULL AS TIMESTAMP) AS triggered_at,
               MIN(l_shipdate) AS created_at, MIN(l_shipdate) AS _timestamp,
               CASE l_orderkey % 5 WHEN 0 THEN 'insert' WHEN 1 THEN 'update_postimage' ELSE 'update' END AS _pg_change_type
        FROM {lineitem} GROUP BY l_orderkey""",
    "users": """
        SELECT c_custkey AS user_id, concat(lower(replace(c_name, '#', '_')), '@example.com') AS email,
               TIMESTAMP '2020-01-01 00:00:00' AS created_at
        FROM {customer}""",
    # Several changes per key: each event changes the profile of its user.
    "profile_history": """
        SELECT user_id, event_id, event_type, value, ts AS _timestamp,
               CASE WHEN event_type = 'signup' THEN 'insert' WHEN event_type = 'error' THEN 'delete'
                    ELSE 'update' END AS _pg_change_type
        FROM {events}""",
    "incoming_emails": """
        SELECT concat('customer_', lpad(CAST(o_custkey + CASE WHEN o_orderstatus = 'P' THEN 500000000 ELSE 0 END
                                             AS VARCHAR(20)), 9, '0'), '@example.com') AS email
        FROM {orders}""",
    "watch_commands": """
        SELECT o_orderkey AS command_id,
               CASE WHEN o_orderpriority = '1-URGENT' THEN -1 - o_custkey ELSE o_custkey END AS user_id,
               CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL
                    ELSE concat('FL', CAST(o_orderkey % 150 AS VARCHAR(20))) END AS flight_number,
               CAST(o_orderdate AS DATE) AS flight_date, CAST(NULL AS VARCHAR(10)) AS origin_airport,
               'AP1' AS destination_airport, o_orderdate AS issued_at
        FROM {orders}""",
    "removal_commands": """
        SELECT event_id AS command_id, event_id + user_id * 50 AS watch_id, ts AS issued_at FROM {events}""",
    "trip_commands": """
        SELECT o_orderkey AS command_id, o_custkey AS user_id, concat('trip ', CAST(o_orderkey AS VARCHAR(20))) AS trip_name,
               o_orderkey AS watch_1, o_custkey AS watch_2,
               CASE WHEN o_orderpriority = '5-LOW' THEN o_custkey ELSE CAST(floor(o_totalprice) AS BIGINT) END AS watch_3,
               o_orderdate AS issued_at
        FROM {orders}""",
    "trip_rows": """
        SELECT command_id AS trip_id, CASE WHEN watch_3 % 40 = 1 THEN NULL ELSE user_id END AS user_id, trip_name, issued_at AS created_at
        FROM {trip_commands}""",
    # Trips list watches that there are not, and some of them twice.
    "trip_links": """
        SELECT command_id AS trip_id, watch_1 AS watch_id FROM {trip_commands}
        UNION ALL SELECT command_id AS trip_id, watch_2 AS watch_id FROM {trip_commands}
        UNION ALL SELECT command_id + CASE WHEN watch_3 % 50 = 0 THEN 1000000000 ELSE 0 END AS trip_id, watch_3 AS watch_id
                  FROM {trip_commands}""",
    "alert_commands": """
        SELECT event_id AS command_id, event_id + user_id * 50 AS watch_id,
               CASE event_type WHEN 'view' THEN 'delay_threshold' WHEN 'click' THEN 'gate_change'
                    WHEN 'purchase' THEN 'status_change' WHEN 'signup' THEN 'weather' END AS alert_type,
               CAST(floor(value) AS INT) AS threshold_minutes, ts AS issued_at
        FROM {events}""",
    "alert_cancel_commands": """
        SELECT event_id AS command_id, event_id + user_id * 50 AS alert_id, ts AS issued_at FROM {events}""",
    "event_watches": """
        SELECT event_id AS watch_id, user_id, concat('FL', CAST(user_id AS VARCHAR(20))) AS flight_number,
               CAST(ts AS DATE) AS flight_date, CAST(NULL AS VARCHAR(10)) AS origin_airport,
               CAST(NULL AS VARCHAR(10)) AS destination_airport,
               CASE WHEN value < 60 THEN 'active' ELSE 'cancelled' END AS status, ts AS created_at, ts AS updated_at
        FROM {events}""",
    "event_alerts": """
        SELECT event_id + 1000000 AS alert_id, event_id AS watch_id,
               CASE WHEN event_type IN ('view', 'error') THEN 'status_change' ELSE 'gate_change' END AS alert_type,
               CAST(NULL AS INT) AS threshold_minutes,
               CASE WHEN value < 30 THEN 'active' ELSE 'triggered' END AS status,
               CAST(NULL AS TIMESTAMP) AS next_fire_at, CAST(NULL AS TIMESTAMP) AS triggered_at, ts AS created_at
        FROM {events}""",
    "tool_calls": """
        SELECT event_id AS call_id, user_id,
               CASE event_type WHEN 'view' THEN 'get_flight_status' WHEN 'click' THEN 'search_rights'
                    WHEN 'error' THEN 'set_alert' WHEN 'purchase' THEN 'create_trip' ELSE 'fly_plane' END AS tool_name,
               event_type IN ('view', 'click') AS is_mcp,
               concat('{"trip_name":"t', CAST(user_id AS VARCHAR(20)), '"}') AS arguments,
               CASE WHEN event_type = 'error' THEN concat('no "watch" ', CAST(event_id AS VARCHAR(20))) END AS error,
               event_type = 'click' AND value > 50 AS reported_error, ts AS called_at
        FROM {events}""",
    "watches_after": """
        SELECT watch_id, user_id, flight_number, flight_date,
               CASE WHEN status = 'active' AND origin_airport = 'AP7' THEN 'completed' ELSE status END AS status
        FROM {watched_flights_history} WHERE destination_airport <> 'AP3'
        UNION ALL
        SELECT o_orderkey + 1000000000 AS watch_id, o_custkey AS user_id, 'FL999' AS flight_number,
               CAST(o_orderdate AS DATE) AS flight_date, 'active' AS status
        FROM {orders} WHERE o_orderpriority = '1-URGENT'""",
    "address_texts": """
        SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN concat(lower(replace(c_name, '#', '_')), '@example.com')
                               WHEN 1 THEN c_name
                               WHEN 2 THEN concat(lower(replace(c_name, '#', '.')), '@example.aero', chr(10))
                               ELSE concat(lower(replace(c_name, '#', '+')), '@example.c') END AS email
        FROM {customer}""",
}

_INPUT = re.compile(r"\{(\w+)\}")


def inputs(sql: str) -> list[str]:
    """Names in braces, each once."""
    return list(dict.fromkeys(_INPUT.findall(sql)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, or a domain table derived from them."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = ADAPTERS[name]
    names = inputs(sql)
    suffix = zlib.crc32(sf_dir.encode())
    views = {used: f"_{used}_{suffix}" for used in names}
    for used, view in views.items():
        table(spark, sf_dir, used).createOrReplaceTempView(view)
    return spark.sql(_INPUT.sub(lambda found: views[found[1]], sql))


def oracle(sql: str) -> str:
    """SQL with names in braces to plain SQL over the test tables, adapters as common tables."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in inputs(text):
            if name in ADAPTERS and name not in ordered:
                visit(ADAPTERS[name])
                ordered.append(name)

    visit(sql)
    plain = _INPUT.sub(r"\1", sql).strip()
    if not ordered:
        return plain
    commons = ", ".join(f"{name} AS ({_INPUT.sub(r'\1', ADAPTERS[name]).strip()})" for name in ordered)
    if plain.startswith("WITH "):
        return f"WITH {commons}, {plain[5:]}"
    return f"WITH {commons} {plain}"
