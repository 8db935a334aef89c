"""Sharding by vector bin packing: shards alike in bytes, tokens and rows, equal texts together.

The packed items are units, of which there is a bounded number: a group of equal texts that holds more
than a share of any total is a unit of its own, all smaller groups are dealt to units by a hash. The
largest unit is placed first, on the shard whose residual capacity has the highest dot product with
the unit's vector.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.ranks import dense_ranks
from skyledger.llm.tables import stored
from skyledger.llm.words import word_count

DIMENSIONS = ("size", "tokens", "rows")


def place_units(vectors: np.ndarray, shards: int) -> np.ndarray:
    """A shard for each row of ``vectors`` (units by dimensions), largest unit first."""
    totals = np.maximum(vectors.sum(axis=0), 1)
    demand = vectors / totals * shards  # 1.0 is the capacity of a shard in each dimension
    residual = np.ones((shards, vectors.shape[1]))
    placed = np.zeros(len(vectors), dtype=np.int64)
    for unit in np.argsort(-demand.max(axis=1), kind="stable"):
        gains = residual @ demand[unit]
        fits = (residual >= demand[unit]).all(axis=1)
        best = int(np.argmax(np.where(fits, gains, -np.inf) if fits.any() else gains))
        placed[unit] = best
        residual[best] -= demand[unit]
    return even_out(demand[:, 0], placed, shards)


def even_out(sizes: np.ndarray, placed: np.ndarray, shards: int) -> np.ndarray:
    """Swaps units of like size between the fullest and the emptiest shard while that evens the first dimension."""
    for _ in range(64 * shards):
        fill = np.bincount(placed, weights=sizes, minlength=shards)
        high, low = int(np.argmax(fill)), int(np.argmin(fill))
        gap = fill[high] - fill[low]
        ours, theirs = np.flatnonzero(placed == high), np.flatnonzero(placed == low)
        if gap < 1e-6 or not len(ours) or not len(theirs):
            break
        theirs = theirs[np.argsort(sizes[theirs], kind="stable")]
        wanted = sizes[ours] - gap / 2
        near = np.clip(np.searchsorted(sizes[theirs], wanted), 0, len(theirs) - 1)
        moves = np.abs(sizes[theirs[near]] - wanted)
        best = int(np.argmin(moves))
        if moves[best] >= gap / 2:
            break
        placed[ours[best]], placed[theirs[near[best]]] = low, high
    return placed


def shard_documents(docs: DataFrame, shards: int = 8, id: str = "doc_id", text: str = "text", units: int = 8192) -> DataFrame:
    """Puts every row of ``docs`` into a shard: (id, size, tokens, text_crc32, shard, slot).

    ``size`` is the UTF-8 bytes of the text plus 1, ``tokens`` its words; null counts as the empty text. Equal
    texts share a shard, unless they hold more than a shard may of some total: such a group is cut by
    a hash of the id into as many parts as it takes to fit well. ``slot`` numbers a shard's rows from
    0. Repeated rows are rows of their own. The same rows give the same shards. At most ``units`` small units and
    ``3 * units`` large groups, parts aside, are placed on the driver, whatever the number of rows.
    """
    known = F.coalesce(F.col(text), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id).cast("long").alias("id"),
            (F.octet_length(known) + F.lit(1)).cast("long").alias("size"),
            word_count(text).alias("tokens"),
            F.crc32(known).alias("text_crc32"),
            F.md5(known).alias("_group"),
        ),
        "shard-rows",
    )
    measures = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    totals = rows.agg(*measures).first().asDict()
    groups = rows.groupBy("_group").agg(*measures)
    share = F.greatest(*[F.col(name) / F.lit(float(totals[name] or 1)) for name in DIMENSIONS])
    large = groups.select("_group", share.alias("_share")).where(F.col("_share") > 1 / units)
    # Parts of a sixteenth of a shard each, once the group does not fit a shard.
    parts = F.when(F.col("_share") * shards > 1, F.ceil(F.col("_share") * shards * 16)).otherwise(1)
    large = F.broadcast(large.withColumn("_parts", parts).drop("_share"))  # at most 3 * units rows
    part = F.pmod(F.xxhash64("id"), F.col("_parts")).cast("string")
    small = F.pmod(F.xxhash64("_group"), F.lit(units)).cast("string")
    unit = F.when(F.col("_parts").isNull(), small).otherwise(F.concat_ws("/", "_group", part))
    rows = stored(rows.join(large, "_group", "left").withColumn("_unit", unit).drop("_group", "_parts"), "shard-units")
    sums = rows.groupBy("_unit").agg(*measures).orderBy("_unit").collect()
    placed = place_units(np.array([[row[name] for name in DIMENSIONS] for row in sums], dtype=float).reshape(-1, 3), shards)
    spark = docs.sparkSession
    places = spark.createDataFrame([(row["_unit"], int(shard)) for row, shard in zip(sums, placed)], "_unit string, shard int")
    located = stored(rows.join(F.broadcast(places), "_unit").drop("_unit"), "shard-places")
    return dense_ranks(located, "shard", ["id", "text_crc32", "size"], "slot").withColumnRenamed("id", id)
