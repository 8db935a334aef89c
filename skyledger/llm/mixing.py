"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Sources get whole blocks by highest quotients, then each source's blocks are apportioned in the same
way to its shards. A shard lays its documents end to end in seeded order and cuts the line into
blocks; it takes whole passes over them and, for the rest, neighbouring blocks from a seeded start.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.ranks import cells_for
from skyledger.llm.tables import stored
from skyledger.llm.words import word_count
from skyledger.operators.joins import own_shuffle


def sainte_lague(weights: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats by highest quotients weight / (2 * won + 1); nobody wins more than ``most``.

    Starts from rounded proportional shares, which differ from the result by few seats, and wins or
    gives back those one by one. Ties go to the earlier one.
    """
    weights, most = np.asarray(weights, dtype=float), np.asarray(most, dtype=np.int64)
    seats = int(min(seats, most[weights > 0].sum()))
    won = np.zeros(len(weights), dtype=np.int64)
    full = weights <= 0
    while seats and not full.all():
        divisor = weights[~full].sum() / max(seats - won[full].sum(), 0.5)
        won[~full] = np.floor(weights[~full] / divisor + 0.5)
        over = ~full & (won >= most)
        if not over.any():
            break
        won[over] = most[over]
        full |= over
    missing = seats - int(won.sum())
    if missing > 0:
        heap = [(-weights[i] / (2 * won[i] + 1), i) for i in np.flatnonzero((won < most) & (weights > 0))]
    else:
        heap = [(weights[i] / (2 * won[i] - 1), -i) for i in np.flatnonzero(won > 0)]
    heapq.heapify(heap)
    step = 1 if missing > 0 else -1
    for _ in range(abs(missing)):
        i = abs(heapq.heappop(heap)[1])
        won[i] += step
        if step > 0 and won[i] < most[i]:
            heapq.heappush(heap, (-weights[i] / (2 * won[i] + 1), i))
        elif step < 0 and won[i] > 0:
            heapq.heappush(heap, (weights[i] / (2 * won[i] - 1), -i))
    return won


def fill_targets(sizes: np.ndarray, weights: np.ndarray, share: float, most: float) -> np.ndarray:
    """``share`` of all sizes by weight; a target stops at ``most`` times its size, the excess is
    shared again by weight until none is above."""
    limits = most * sizes
    capped = sizes <= 0
    total = min(share * sizes.sum(), limits.sum())
    while not capped.all():
        level = (total - limits[capped].sum()) / weights[~capped].sum()
        over = ~capped & (weights * level > limits)
        if not over.any():
            return np.where(capped, limits, weights * level)
        capped |= over
    return limits


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: int = 17,
    block_tokens: int = 16,
    id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """What a mix takes of each row of ``docs``.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` times all
    words. Returns (id, source, size, source_size, target, passes, parts, taken): the row enters the
    mix ``passes`` times in whole, and with the words of each of ``parts`` (start, end) once more;
    ``taken`` counts all these words, at most ``most`` times the size. Null texts have no words.
    Columns named in ``carry`` come along.
    The same rows and seed give the same mix; rows alike in id and size may swap places. A source's
    words miss its target by a block here and there. An empty table gives an empty result. Only one
    row per source, and the shards of one source, come together in a task.
    """
    others = [F.col(name).alias(f"carry_{name}") for name in carry]
    # A key that tells null from every text, so that joins need no null-safe comparison.
    key = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))
    measured = docs.select(
        F.col(id).cast("long").alias("id"), F.col(source).alias("source"), key.alias("key"), word_count(text).alias("size"), *others
    )
    slim = stored(measured.drop(*(f"carry_{name}" for name in carry)), "mix-rows")
    rows = measured if carry else slim

    def plan(sources: pd.DataFrame) -> pd.DataFrame:
        sources = sources.sort_values("key", ignore_index=True)
        sources = pd.concat([sources[sources["key"] != ""], sources[sources["key"] == ""]], ignore_index=True)
        turn = np.resize(np.array(weights, dtype=float), len(sources))
        sizes = sources["source_size"].to_numpy(dtype=float)
        targets = fill_targets(sizes, turn, share, most)
        blocks = most * np.ceil(sizes / block_tokens).astype(np.int64)
        seats = sainte_lague(targets, round(targets.sum() / block_tokens), blocks)
        return sources.assign(target=targets, seats=seats)

    def deal(shards: pd.DataFrame) -> pd.DataFrame:
        shards = shards.sort_values("shard", ignore_index=True)
        sizes = shards["shard_size"].to_numpy()
        blocks = most * -(-sizes // block_tokens)
        return shards.assign(quota=sainte_lague(sizes, int(shards["seats"].iloc[0]), blocks)).drop(columns="seats")

    sources = slim.groupBy("key").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = stored(
        sources.groupBy().applyInPandas(plan, "key string, source_size long, n long, target double, seats long"), "mix-sources"
    )

    def dealt(some: DataFrame) -> DataFrame:
        shard = F.pmod(F.xxhash64(F.lit(seed), "id"), cells_for(F.col("n")))
        return some.join(own_shuffle(sources, ["key"]), "key").withColumn("shard", shard).drop("n")

    shards = dealt(slim).groupBy("key", "shard").agg(F.sum("size").alias("shard_size"), F.first("seats").alias("seats"))
    quotas = shards.groupBy("key").applyInPandas(deal, "key string, shard long, shard_size long, quota long")
    line = Window.partitionBy("key", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "id"), "id", "size")
    end = F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0))
    laid = dealt(rows).withColumn("_end", end).join(quotas, ["key", "shard"])
    blocks = F.greatest(F.ceil(F.col("shard_size") / block_tokens), F.lit(1))
    laid = (
        laid.withColumn("_blocks", blocks)
        .withColumn("passes", F.floor(F.col("quota") / F.col("_blocks")))
        .withColumn("_left", F.col("quota") % F.col("_blocks"))
        .withColumn("_first", F.pmod(F.xxhash64(F.lit(seed + 2), "key", "shard"), F.col("_blocks")))
        .withColumn("_start", F.col("_end") - F.col("size"))
    )

    def part(first, last):
        """Words of the row within blocks ``first`` to ``last`` of the line, counted from its start."""
        low = F.greatest(first * block_tokens - F.col("_start"), F.lit(0))
        high = F.least(last * block_tokens - F.col("_start"), F.col("size"))
        return F.struct(low.cast("long").alias("start"), high.cast("long").alias("end"))

    stop = F.col("_first") + F.col("_left")
    pieces = F.array(part(F.lit(0), stop - F.col("_blocks")), part(F.col("_first"), stop))
    parts = F.filter(pieces, lambda one: one["end"] > one["start"])
    extra = F.aggregate(parts, F.lit(0).cast("long"), lambda sum, one: sum + one["end"] - one["start"])
    return laid.select(
        F.col("id").alias(id),
        F.col("source").alias(source),
        "size",
        "source_size",
        "target",
        F.col("passes").cast("int").alias("passes"),
        parts.alias("parts"),
        (F.col("passes") * F.col("size") + extra).cast("long").alias("taken"),
        *(F.col(f"carry_{name}").alias(name) for name in carry),
    )
