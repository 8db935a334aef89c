"""Vectorised helpers over Arrow text columns: words, rolling names, window minima.

All names are 64-bit polynomial hashes over a table of random values, finished by a mixer. They
are functions of content alone, so tasks name equal content equally without talking to each other.
Two bases give independent names where a decision needs 128 bits.
"""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

U64 = np.uint64
# Odd bases of the two families of names and their inverses modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
# Bytes of a batch of rows handed to Python, one row at least.
BATCH_BYTES = 8 << 20
# Space and the control characters 9 to 13 part words.
SPACES = (9, 10, 11, 12, 13, 32)


def process_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, for rebuildable values only.

    Functions travel to workers by value, so their module globals start afresh in each task; an
    entry in ``sys.modules`` lasts from task to task.
    """
    return sys.modules.setdefault(f"_skyledger_{name}", types.ModuleType(name)).__dict__


def forget_cache(name: str) -> None:
    """Lets go of a ``process_cache`` that an earlier step left in this worker."""
    if sys.modules.pop(f"_skyledger_{name}", None):
        give_back()


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values; equal values stay equal, different ones differ."""
    x = values ^ (values >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(size: int, family: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``size`` powers of the family's base and of its inverse, kept per process."""
    kept = process_cache("powers")
    if len(kept.get(family, ((),))[0]) < size:
        room = max(size, 1 << 20)
        base = BASES[family]
        both = []
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(room, factor, dtype=U64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        kept[family] = tuple(both)
    ahead, back = kept[family]
    return ahead[:size], back[:size]


class Names:
    """Names of any stretch of a sequence, from running sums: stretch [i, j) in constant time."""

    def __init__(self, values: np.ndarray, family: int):
        ahead, self.back = powers(len(values) + 1, family)
        self.sums = np.zeros(len(values) + 1, dtype=U64)
        np.cumsum(values * ahead[: len(values)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.back[starts])

    def windows(self, width: int) -> np.ndarray:
        """Names of all stretches of the given width, by start."""
        count = len(self.sums) - width
        if count <= 0:
            return np.zeros(0, dtype=U64)
        return mix((self.sums[width:] - self.sums[:count]) * self.back[:count])


def byte_values(family: int) -> np.ndarray:
    """One random 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=U64) * U64(BASES[1 - family]))


def thrifty(scan):
    """Wraps a function over batches: when it ends, the worker gives freed memory back to the system.

    Workers are reused, and what their allocators keep adds up next to the JVM's heap.
    """

    def run(batches):
        yield from scan(batches)
        give_back()

    return run


def give_back() -> None:
    """Gives memory that is free in this process back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def small_batches(df: DataFrame) -> DataFrame:
    """Bounds the bytes that the session hands to Python at a time, on both sides; the setting stays.

    Spark's own bound is 64 MB, a copy of which each task holds in the JVM and another in its worker.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows of at most ``most_bytes`` of text, one row at least."""
    if batch.num_rows == 0:
        return
    ends = text_column(batch.column(column))[1][1:]
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        yield batch.slice(first, last - first)
        first = last


def text_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, one after another, and the offsets of the texts; null is empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def packed_texts(texts: DataFrame) -> DataFrame:
    """``texts`` with (packed, n_bytes) for text: a compressed form for shuffles. Null is empty."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                data, offsets = text_column(part.column("text"))
                raw = data.tobytes()
                packed = [squeeze(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
                rest = [part.column(name) for name in others]
                columns = [*rest, pa.array(packed, pa.binary()), pa.array(np.diff(offsets))]
                yield pa.RecordBatch.from_arrays(columns, names=[*others, "packed", "n_bytes"])

    others = [name for name in texts.columns if name != "text"]
    schema = ", ".join(f"`{name}` {kind}" for name, kind in texts.select(*others).dtypes)
    return texts.mapInArrow(thrifty(pack), f"{schema}, packed binary, n_bytes long")


def unpacked(batch: pa.RecordBatch, most_bytes: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows of a batch with the bytes and offsets of their texts; a null text is empty."""
    expand = zstandard.ZstdDecompressor().decompress
    ends = np.cumsum(batch.column("n_bytes").to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        part = batch.slice(first, last - first)
        texts = [expand(one) if one is not None else b"" for one in part.column("packed").to_pylist()]
        offsets = np.concatenate(([0], np.cumsum([len(one) for one in texts])))
        yield part, np.frombuffer(b"".join(texts), dtype=np.uint8), offsets
        first = last


def text_parts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """What ``unpacked`` gives, for rows that hold their texts packed or as they are."""
    if "packed" in batch.schema.names:
        yield from unpacked(batch)
    else:
        for part in slices(batch, "text"):
            yield part, *text_column(part.column("text"))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the number of words before it (plus the total)."""
    space = np.zeros(256, dtype=bool)
    space[list(SPACES)] = True
    solid = np.empty(len(data) + 2, dtype=bool)
    solid[0] = solid[-1] = False
    np.logical_not(space[data], out=solid[1:-1])
    rises = solid[1:-1] & ~solid[:-2]
    falls = solid[1:-1] & ~solid[2:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    rises[inner] |= solid[inner + 1]
    falls[inner - 1] |= solid[inner]
    starts = np.flatnonzero(rises)
    return starts, np.flatnonzero(falls) + 1, np.searchsorted(starts, offsets)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case; every other byte as it is."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def word_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    return Names(byte_values(family)[data], family).of(starts, ends)


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every window of ``width`` neighbours, by start."""
    if len(values) < width:
        return values[:0]
    reach, least = 1, values
    while reach * 2 <= width:
        least = np.minimum(least[: len(least) - reach], least[reach:])
        reach *= 2
    rest = width - reach
    count = len(values) - width + 1
    return np.minimum(least[:count], least[rest : rest + count])


def flat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, start + length), one range after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)

