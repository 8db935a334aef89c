"""Joins against a table with a unique key, for left sides in which one key may be very frequent.

Adaptive execution splits an oversized partition of the left side over many tasks, but only when
both sides of the join come straight from a shuffle made for it. A right side that was grouped or
ranked by the same key does not, as it is already in place. It gets a shuffle of its own here, which
is cheap next to a frequent key running in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import present


def own_shuffle(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Spread rows by a hash of the key, so that a join by the key has to shuffle them itself."""
    return df.repartition(F.xxhash64(*key))


def join_unique(left: DataFrame, right: DataFrame, key: Sequence[str], how: str = "inner") -> DataFrame:
    """Join with a right side that has one row per key."""
    return left.join(own_shuffle(right, key), list(key), how)


def look_up(left: DataFrame, table: DataFrame, key: str, columns: Sequence[str] = ()) -> DataFrame:
    """Columns of the row of ``table`` with the key of each left row; ``_known`` tells if there is one.

    Meant for a batch of requests against a large table: the table is first cut down to the keys
    asked for, by a join that can broadcast the keys when they are measured to be few.
    """
    asked = present(left.select(key), key).distinct()
    found = table.select(key, *columns).join(asked, key, "left_semi").withColumn("_known", F.lit(True))
    return join_unique(left, found, [key], "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
