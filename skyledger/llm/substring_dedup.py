"""Substring dedup by recompression: repeated runs of words are found by the symbols they share.

Rounds of recompression rename a text into fewer symbols: runs of one symbol get a name, then pairs
of a left and a right symbol do, the sides being drawn by a hash of the symbol. A name is a hash of
what it stands for, so all tasks name alike and a round moves no data. Only short symbols take part
in a round; whether a symbol ends at a word therefore depends on ``MARGIN`` words either side, and
equal windows have the same symbols inside. The least ranked symbol end in a window is its anchor:
shared anchors reveal repeats, and names of whole windows verify them (see ``repeats``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import repeats
from skyledger.llm.anchors import Anchors, find_anchors
from skyledger.llm.repeats import anchor_rows, cut_runs, repeated_windows, run_marks
from skyledger.llm.tables import stored
from skyledger.llm.textscan import U64, flat_ranges, mix, text_parts, word_bounds, word_names

# Rounds as (longest symbol that takes part, longest run that gets a name; 0: no runs), in words.
ROUNDS = ((1, 2), (1, 0), (2, 0), (2, 0))
# A round sees its longest run and one symbol beyond, or one symbol either side.
MARGIN = sum(symbol + (run + symbol if run else 0) for symbol, run in ROUNDS)
# The rounds join at most two symbols of this length.
LONGEST = 2 * max(symbol for symbol, _ in ROUNDS)


def symbol_starts(names: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Marks the words at which a symbol starts after all rounds; symbols end with their text."""
    count = len(names)
    starts = np.arange(count)
    first_of_text = np.zeros(count + 1, dtype=bool)
    first_of_text[offsets] = True
    for number, (longest, longest_run) in enumerate(ROUNDS):
        if longest_run:
            starts, names = name_runs(starts, names, first_of_text, count, longest, longest_run)
        starts, names = name_pairs(starts, names, first_of_text, count, longest, number)
    marks = np.zeros(count, dtype=bool)
    marks[starts] = True
    return marks


def name_runs(starts, names, first_of_text, count, longest, longest_run):
    """Runs of one short symbol, of at most ``longest_run`` words, become one symbol."""
    if len(starts) < 2:
        return starts, names
    sizes = np.diff(np.append(starts, count))
    same = (names[1:] == names[:-1]) & (sizes[:-1] <= longest) & ~first_of_text[starts[1:]]
    heads = np.flatnonzero(np.concatenate(([True], ~same)))
    members = np.diff(np.append(heads, len(starts)))
    joined = (members > 1) & (members * sizes[heads] <= longest_run)
    keep = np.ones(len(starts), dtype=bool)
    keep[flat_ranges(heads[joined] + 1, members[joined] - 1)] = False
    renamed = names.copy()
    renamed[heads[joined]] = mix(names[heads[joined]] * U64(0xD1342543DE82EF95) + members[joined].astype(U64))
    return starts[keep], renamed[keep]


def name_pairs(starts, names, first_of_text, count, longest, number):
    """A left symbol and a right one after it, both short, become one symbol."""
    if len(starts) < 2:
        return starts, names
    sizes = np.diff(np.append(starts, count))
    salt = U64((number + 1) * 0x9E3779B97F4A7C15 % 2**64)
    right = mix(names + salt) >> U64(63) == 1
    short = sizes <= longest
    joins = short[:-1] & short[1:] & ~right[:-1] & right[1:] & ~first_of_text[starts[1:]]
    left = np.flatnonzero(joins)
    renamed = names.copy()
    renamed[left] = mix(names[left] * U64(0xDA942042E4DD58B5) + mix(names[left + 1]))
    keep = np.ones(len(starts), dtype=bool)
    keep[left + 1] = False
    return starts[keep], renamed[keep]


def read_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, words = word_bounds(data, offsets)
    return word_names(data, starts, ends), words


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 50, carry: Sequence[str] = (), spaces: bool = False) -> DataFrame:
    """Removes words covered by a window of ``width`` words that also starts in a text of smaller id.

    Returns per row of ``docs``: the id, ``kept`` (the words that stay, joined by one space; with
    ``spaces`` the text without the words that go and the white space between each and the next),
    ``n_words``, ``n_removed`` and ``runs`` (repeated windows as first window and number, null for
    none). Windows are judged on the input. Null and blank texts have no words and keep "". Texts of
    fewer than ``width`` words keep all. Repeated rows of one id get the same result each; if an id has
    different texts, the repeats found in any of them are cut at the same places in all. A text with
    a null id keeps all its words and repeats nothing. Columns named in ``carry`` come along, others
    play no part.
    """
    if width < 2 * MARGIN + LONGEST:
        raise ValueError(f"windows need {2 * MARGIN + LONGEST} words at least")
    others = [F.col(name).alias(f"carry_{name}") for name in carry]
    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"), *others)

    def find(values: np.ndarray, offsets: np.ndarray) -> Anchors:
        return find_anchors(values, offsets, width, MARGIN, symbol_starts(values, offsets))

    anchors = stored(anchor_rows(texts.where("id IS NOT NULL"), read_words, find), "recompression")
    ids = anchors.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("last"), F.count("*").alias("rows"))
    shared = stored(ids.where("least < last").select("key", "rows"), "shared")
    frequent = shared.where(F.col("rows") > repeats.MANY).select("key")
    runs = repeated_windows(texts, anchors, shared.select("key"), frequent, read_words, width, earlier=True)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in text_parts(batch):
                starts, ends, words = word_bounds(data, offsets)
                gone = run_marks(part.column("runs"), words, width)
                stay = np.flatnonzero(~gone)
                removed = np.concatenate(([0], np.cumsum(gone)))[words]
                if spaces:
                    kept, kept_offsets = without_words(data, offsets, starts, ends, words, gone)
                else:
                    kept, kept_offsets = joined_words(data, starts[stay], ends[stay], np.searchsorted(stay, words))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.Array.from_buffers(pa.string(), part.num_rows, [None, pa.py_buffer(kept_offsets), pa.py_buffer(kept)]),
                        pa.array(np.diff(words)),
                        pa.array(np.diff(removed)),
                        part.column("runs"),
                        *(part.column(name) for name in carried),
                    ],
                    names=["id", "kept", "n_words", "n_removed", "runs", *carried],
                )

    carried = [f"carry_{name}" for name in carry]
    kinds = "".join(f", `{name}` {kind}" for name, kind in texts.select(*carried).dtypes)
    schema = f"id long, kept string, n_words long, n_removed long, runs array<struct<start:int,n:int>>{kinds}"
    found = cut_runs(texts, runs, cut, schema)
    return found.select(F.col("id").alias(id), *found.columns[1:5], *(F.col(f"carry_{name}").alias(name) for name in carry))


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, one space between; ``words`` are the word offsets of the texts."""
    sizes = ends - starts + 1
    after = np.concatenate(([0], np.cumsum(sizes)))
    source = flat_ranges(starts, sizes)
    out = data[np.minimum(source, max(len(data) - 1, 0))] if len(source) else np.zeros(0, dtype=np.uint8)
    out[after[1:] - 1] = 32
    # The space after the last word of a text goes.
    filled = np.flatnonzero(np.diff(words))
    keep = np.ones(len(out), dtype=bool)
    keep[after[words[filled + 1]] - 1] = False
    lengths = after[words[1:]] - after[words[:-1]]
    lengths[filled] -= 1
    return out[keep], np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)


def without_words(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text without the words marked ``gone`` and the white space between each and the next word."""
    stops = ends.copy()
    stops[:-1] = starts[1:]
    last = words[1:][np.diff(words) > 0] - 1
    stops[last] = ends[last]
    depth = np.zeros(len(data) + 1, dtype=np.int8)
    depth[starts[gone]] += 1
    depth[stops[gone]] -= 1
    stay = np.cumsum(depth[:-1], dtype=np.int8) == 0
    return data[stay], np.concatenate(([0], np.cumsum(stay)))[offsets].astype(np.int32)
