"""Constraint checks over the state tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import present
from ..schemas import ALERT_STATUSES, ALERT_TYPES, RESULT_STATUSES, WATCH_STATUSES


@dataclass(frozen=True)
class TableRules:
    """Rules of one table: unique keys, required columns, allowed values, references."""

    unique: tuple[tuple[str, ...], ...] = ()
    required: tuple[str, ...] = ()
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    references: dict[str, str] = field(default_factory=dict)  # column -> table it refers to


# Constraints of the state tables.
RULES = {
    "users": TableRules((("user_id",), ("email",)), ("user_id", "email", "created_at")),
    "watched_flights": TableRules(
        (("watch_id",),),
        ("watch_id", "user_id", "flight_number", "flight_date", "status", "created_at", "updated_at"),
        {"status": WATCH_STATUSES},
        {"user_id": "users"},
    ),
    "trip_plans": TableRules(
        (("trip_id",),), ("trip_id", "user_id", "trip_name", "created_at"), {}, {"user_id": "users"}
    ),
    "trip_flights": TableRules(
        (("trip_id", "watch_id"),),
        ("trip_id", "watch_id"),
        {},
        {"trip_id": "trip_plans", "watch_id": "watched_flights"},
    ),
    "alerts": TableRules(
        (("alert_id",),),
        ("alert_id", "watch_id", "alert_type", "status", "created_at"),
        {"status": ALERT_STATUSES, "alert_type": ALERT_TYPES},
        {"watch_id": "watched_flights"},
    ),
    "agent_action_log": TableRules(
        (("action_id",),),
        ("action_id", "user_id", "action_type", "result_status", "created_at"),
        {"result_status": RESULT_STATUSES},
        {"user_id": "users"},
    ),
}


def _row_rules(name: str, table: DataFrame, rules: TableRules) -> DataFrame:
    """Missing and not-allowed values of a table, counted in one pass."""
    checks = {f"required {column}": F.col(column).isNull() for column in rules.required}
    checks |= {f"allowed {column}": ~F.col(column).isin(*values) for column, values in rules.allowed.items()}
    counted = table.agg(
        F.array(
            *[
                F.struct(F.lit(rule).alias("rule"), F.count_if(broken).alias("violations"))
                for rule, broken in checks.items()
            ]
        ).alias("_rules")
    )
    return counted.select(F.explode("_rules").alias("_rule")).select(
        F.lit(name).alias("table_name"), "_rule.rule", "_rule.violations"
    )


def _count(name: str, rule: str, broken: DataFrame, amount) -> DataFrame:
    return broken.agg(F.coalesce(amount, F.lit(0)).cast("long").alias("violations")).select(
        F.lit(name).alias("table_name"), F.lit(rule).alias("rule"), "violations"
    )


def _unique_rule(name: str, table: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Keys that occur more than once; keys with a missing part are not compared."""
    repeated = present(table, *key).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _count(name, f"unique {', '.join(key)}", repeated, F.count(F.lit(1)))


def _reference_rule(name: str, table: DataFrame, column: str, target_name: str, target: DataFrame) -> DataFrame:
    """Rows that refer to nothing. Counted per value before the join, so a frequent value is one row."""
    key = RULES[target_name].unique[0][0]
    used = present(table, column).groupBy(F.col(column).alias(key)).agg(F.count(F.lit(1)).alias("n"))
    orphans = used.join(target.select(key), key, "left_anti")
    return _count(name, f"references {column}", orphans, F.sum("n"))


def constraint_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per rule of the given tables: table_name, rule, violations."""
    results = []
    for name, table in tables.items():
        rules = RULES[name]
        results.append(_row_rules(name, table, rules))
        results += [_unique_rule(name, table, key) for key in rules.unique]
        results += [
            _reference_rule(name, table, column, target, tables[target])
            for column, target in rules.references.items()
            if target in tables
        ]
    return reduce(DataFrame.unionByName, results)
