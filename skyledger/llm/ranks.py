"""Row numbers within large groups, without bringing a group to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows that share one window partition, about, until a group has ``MOST_CELLS`` of them.
CELL_ROWS = 200
MOST_CELLS = 65536


def cells_for(rows):
    """The number of cells among which ``rows`` rows are dealt."""
    return F.greatest(F.lit(1), F.least(F.ceil(rows / CELL_ROWS), F.lit(MOST_CELLS)))


def dense_ranks(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """Numbers the rows of each ``group`` from 0 without gaps, in a fixed but hashed order.

    A group is dealt by a hash of the ``order`` columns to cells of about ``CELL_ROWS`` rows; a row's
    number is that in its cell plus the rows of the cells before it. Groups are few (shards, lengths),
    so their sizes are broadcast. ``rows`` is read three times and should be stored. Rows alike in
    group and order are numbered in any order. Groups must not be null.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("_rows"))
    dealt = rows.join(F.broadcast(sizes), group)
    dealt = dealt.withColumn("_cell", F.pmod(F.xxhash64(*order), cells_for(F.col("_rows")))).drop("_rows")
    cells = dealt.groupBy(group, "_cell").agg(F.count("*").alias("_count"))
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_before", F.coalesce(F.sum("_count").over(before), F.lit(0))).drop("_count")
    inside = Window.partitionBy(group, "_cell").orderBy(*order)
    numbered = dealt.withColumn("_inside", F.row_number().over(inside) - 1)
    joined = numbered.join(cells, [group, "_cell"])
    return joined.select(*rows.columns, (F.col("_before") + F.col("_inside")).alias(name))
