"""Suffix-array dedup: a logarithmic family of sorted suffix tables finds long repeats of bytes.

Suffixes are sampled at anchors (see ``anchors``): a repeated string of ``width`` bytes holds the
same anchors wherever it stands, so nothing is missed. A suffix array is a table of the sampled
suffixes of some batches, sorted by the name of the bytes around the anchor, so that suffixes which
may share a long match are neighbours. A new batch gets its array, is scanned in merge order against
every level, and arrays of equal size are merged, so each suffix is merged a logarithmic number of
times. Suffixes that the scans match are then compared over whole strings (see ``repeats``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import repeats
from skyledger.llm.anchors import Anchors, find_anchors
from skyledger.llm.repeats import anchor_rows, cut_runs, repeated_windows, run_marks
from skyledger.llm.tables import stored
from skyledger.llm.textscan import byte_values, text_parts
from skyledger.session import work_dir

# Bytes on either side of an anchor that name it.
MARGIN = 50


class SuffixFamily:
    """Sorted arrays of sampled suffixes; level ``k`` stands for ``2**k`` batches.

    An array is a table (key, times), bucketed and sorted by key in the shared folder: scans and
    merges of two arrays move no data.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None) -> None:
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: dict[int, DataFrame] = {}
        self.matches: list[DataFrame] = []

    def array(self, suffixes: DataFrame) -> DataFrame:
        """Writes suffixes that lie in buckets already as a sorted array."""
        path = work_dir(self.spark, "suffixes")
        name = f"suffixes_{path[-32:]}"
        suffixes.write.bucketBy(self.buckets, "key").sortBy("key").option("path", path).saveAsTable(name)
        return self.spark.table(name)

    def add(self, anchors: DataFrame) -> None:
        """Takes a batch of anchor rows in: array, scan against the levels, merges."""
        counted = anchors.groupBy("key").agg(F.sum("copies").alias("times"))
        array = self.array(counted.repartition(self.buckets, "key"))
        met = [array.where("times > 1").select("key")]
        met += [array.join(level.hint("merge"), "key", "left_semi").select("key") for level in self.levels.values()]
        self.matches.append(stored(reduce(DataFrame.unionByName, met), "matches"))
        size = 0
        while size in self.levels:
            older = self.levels.pop(size).withColumnRenamed("times", "_times").hint("merge")
            times = F.coalesce("times", F.lit(0)) + F.coalesce("_times", F.lit(0))
            array = self.array(array.join(older, "key", "full").select("key", times.alias("times")))
            size += 1
        self.levels[size] = array

    def matched(self) -> DataFrame:
        """Names of suffixes (key) that occur more than once in all batches, once each."""
        return reduce(DataFrame.unionByName, self.matches).distinct()

    def frequent(self, most: int) -> DataFrame:
        """Names of all suffixes (key) that occur more than ``most`` times, and some rarer ones, once each."""
        share = most // len(self.levels)
        found = [level.where(F.col("times") > share).select("key") for level in self.levels.values()]
        return reduce(DataFrame.unionByName, found).distinct()


def read_bytes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return byte_values(0)[data], offsets


def remove_repeated_bytes(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 400, batches: int = 4) -> DataFrame:
    """Removes bytes covered by a string of ``width`` bytes that also starts anywhere else.

    Returns per row of ``docs``: the id, ``kept`` (binary: a cut may part a character), ``n_bytes``,
    ``n_removed``, and ``removed`` (maximal removed stretches as start and length). Strings are judged
    on the input and lie in one text. Texts are UTF-8; null counts as empty, shorter texts than
    ``width`` keep all. Rows of one id should be one text: repeated rows of an id repeat each other
    like texts of different ids; if an id has different texts, the repeats found in any of them are
    cut at the same places in all. A text with a null id keeps all its bytes and repeats nothing.
    Other columns of ``docs`` play no part. The texts enter the family in ``batches`` batches.
    """
    if width < 2 * MARGIN + 1:
        raise ValueError(f"strings need {2 * MARGIN + 1} bytes at least")
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))

    def find(values: np.ndarray, offsets: np.ndarray) -> Anchors:
        return find_anchors(values, offsets, width, MARGIN)

    anchors = stored(anchor_rows(texts.where("id IS NOT NULL"), read_bytes, find), "anchors")
    family = SuffixFamily(docs.sparkSession)
    for number in range(batches):
        family.add(anchors.where(F.pmod(F.xxhash64("id"), F.lit(batches)) == number))
    shared = stored(family.matched(), "shared")
    frequent = stored(family.frequent(repeats.MANY), "frequent")
    runs = repeated_windows(texts, anchors, shared, frequent, read_bytes, width, earlier=False)

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part, data, offsets in text_parts(batch):
                gone = run_marks(part.column("runs"), offsets, width)
                removed = np.concatenate(([0], np.cumsum(gone)))[offsets]
                before = np.zeros(len(data), dtype=bool)
                before[1:] = gone[:-1]
                before[offsets[:-1][offsets[:-1] < len(data)]] = False
                heads = np.flatnonzero(gone & ~before)
                after = np.zeros(len(data), dtype=bool)
                after[:-1] = gone[1:]
                after[offsets[1:][offsets[1:] > 0] - 1] = False
                tails = np.flatnonzero(gone & ~after)
                owners = np.searchsorted(heads, offsets)
                base = np.repeat(offsets[:-1], np.diff(owners))
                spans = pa.StructArray.from_arrays(
                    [pa.array((heads - base).astype(np.int64)), pa.array((tails - heads + 1).astype(np.int64))], names=["start", "length"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.Array.from_buffers(
                            pa.binary(),
                            part.num_rows,
                            [None, pa.py_buffer((offsets - removed).astype(np.int32)), pa.py_buffer(data[~gone])],
                        ),
                        pa.array(np.diff(offsets)),
                        pa.array(np.diff(removed)),
                        pa.ListArray.from_arrays(pa.array(owners.astype(np.int32)), spans),
                    ],
                    names=["id", "kept", "n_bytes", "n_removed", "removed"],
                )

    schema = "id long, kept binary, n_bytes long, n_removed long, removed array<struct<start:long,length:long>>"
    return cut_runs(texts, runs, cut, schema).withColumnRenamed("id", id)
