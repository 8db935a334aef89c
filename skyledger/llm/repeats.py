"""Which windows of texts occur again: anchors, distinct spans, and windows of the spans that differ.

An anchor row stands for the windows that share an anchor (see ``anchors``). Where a whole span is
repeated all its windows are; only distinct spans around one anchor name that differ from each other
are compared window by window. Equal windows meet under (name, place of the window before the
anchor), so that a frequent name is spread by place. Tasks compare whole groups of rows of one anchor
name; where those may be too many, Spark groups the single windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.anchors import Anchors
from skyledger.llm.id_filter import key_bits, maybe_asked, with_mark
from skyledger.llm.tables import stored
from skyledger.llm.textscan import U64, Names, flat_ranges, packed_texts, slices, text_column, thrifty, unpacked
from skyledger.operators.joins import own_shuffle

ANCHOR_SCHEMA = "id long, first int, n int, copies int, place int, key long, span long"
# Windows that travel in one row.
BLOCK = 32
# Anchor rows of one name up to which tasks hold the windows around it.
MANY = 10_000

# Elements of the texts of a slice: their values under both families of names, and text offsets.
Reader = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def anchor_rows(texts: DataFrame, read: Reader, find: Callable[[np.ndarray, np.ndarray], Anchors]) -> DataFrame:
    """One row per anchor of ``texts`` (id, text); positions count from the start of the text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, offsets = read(*text_column(part.column("text")))
                found = find(values, offsets)
                base = offsets[found.text]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(found.text)),
                        pa.array((found.first - base).astype(np.int32)),
                        pa.array((found.last - found.first + 1).astype(np.int32)),
                        pa.array(found.copies.astype(np.int32)),
                        pa.array((found.anchor - found.first).astype(np.int32)),
                        pa.array(found.key.view(np.int64)),
                        pa.array(found.span.view(np.int64)),
                    ],
                    names=["id", "first", "n", "copies", "place", "key", "span"],
                )

    return texts.select("id", "text").mapInArrow(thrifty(scan), ANCHOR_SCHEMA)


def repeated_windows(
    texts: DataFrame, anchors: DataFrame, shared: DataFrame, frequent: DataFrame, read: Reader, width: int, earlier: bool
) -> DataFrame:
    """Runs of repeated windows as (id, start, n), written already.

    With ``earlier`` a window counts that also starts in a text of smaller id; else one that also
    starts anywhere else. ``texts`` are (id, text); ``shared`` holds the anchor names (key) that may
    matter, once each; ``frequent`` those that have more than ``MANY`` rows; both are written already.
    """
    # A semi join would be pushed below the filter and move all anchors.
    anchors = stored(maybe_asked(anchors, shared, "key").join(own_shuffle(shared, ["key"]), "key"), "shared-anchors")
    spans = anchors.groupBy("key", "span").agg(F.sum("copies").alias("times"), F.min("id").alias("least"))
    variants = spans.groupBy("key").agg((F.count("*") > 1).alias("varied"))
    notable = spans.join(own_shuffle(variants, ["key"]), "key").where(F.col("varied") | (F.col("times") > 1))
    whole = F.col("id") > F.col("least") if earlier else F.col("times") > 1
    # One text speaks for a span where it is compared with its variants.
    speaks = F.col("varied") & (F.col("id") == F.col("least"))
    marked = (
        anchors.join(own_shuffle(notable, ["key", "span"]), ["key", "span"])
        .withColumn("whole", whole)
        .withColumn("speaks", speaks)
        .where("whole OR speaks")
        .select("id", "first", "n", "copies", "place", "key", "span", "whole", "speaks")
    )
    marked = stored(marked, "marked-anchors")
    speaking = marked.where("speaks")
    some = not frequent.isEmpty()
    few = speaking.join(own_shuffle(frequent, ["key"]), "key", "left_anti") if some else speaking
    compared = (
        blocks_asked(texts, few, read, width)
        .repartition("key", "block")
        .sortWithinPartitions("key", "block")
        .mapInArrow(thrifty(compare_blocks(earlier)), "id long, start int, n int")
    )
    if some:
        many = speaking.join(own_shuffle(frequent, ["key"]), "key", "left_semi")
        compared = compared.unionByName(grouped_windows(blocks_asked(texts, many, read, width), earlier))
    whole = marked.where("whole").select("id", F.col("first").alias("start"), (F.col("n") * F.col("copies")).alias("n"))
    return stored(whole.unionByName(compared), "runs")


def blocks_asked(texts: DataFrame, speaking: DataFrame, read: Reader, width: int) -> DataFrame:
    """The windows of the anchor rows ``speaking``, see ``window_blocks``."""
    of_text = speaking.groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("first", "n", "copies", "place", "key", "span", "whole"))).alias("asked")
    )
    packed = packed_texts(maybe_asked(texts, speaking, "id").select("id", "text"))
    asked = packed.join(of_text, "id").select("id", "packed", "n_bytes", "asked")
    return asked.mapInArrow(thrifty(window_blocks(read, width)), BLOCK_SCHEMA)


def grouped_windows(blocks: DataFrame, earlier: bool) -> DataFrame:
    """Equal windows among rows of any number: what ``compare_blocks`` finds, one window a row.

    A frequent window is reduced before it travels, and the join that hands out what became of it
    can be split.
    """
    same = ["key", "place", "name"]
    step = F.explode(F.sequence(F.lit(0), (F.length("names") / 8).cast("int") - 1))
    windows = blocks.withColumn("step", step).select(
        "key",
        (F.col("place") - F.col("step")).alias("place"),
        F.substring("names", F.col("step") * 8 + 1, F.lit(8)).alias("name"),
        "span",
        "id",
        (F.col("start") + F.col("step")).alias("start"),
        "period",
        "copies",
        "settled",
    )
    value = "id" if earlier else "span"
    met = windows.groupBy(*same).agg(F.min(value).alias("low"), F.max(value).alias("high")).where("low < high").select(*same, "low")
    hits = windows.where("NOT settled").join(own_shuffle(met, same), same)
    hits = hits.where("id > low") if earlier else hits
    # What holds for a span holds for the copies that follow it.
    copy = F.explode(F.sequence(F.lit(0), F.col("copies") - 1))
    starts = hits.select("id", "start", "period", copy.alias("copy"))
    return starts.select("id", (F.col("start") + F.col("copy") * F.col("period")).alias("start"), F.lit(1).alias("n"))


BLOCK_SCHEMA = "key long, block int, place int, span long, id long, start int, period int, copies int, settled boolean, names binary"


def window_blocks(read: Reader, width: int):
    """Names of the windows asked for, in rows of ``BLOCK`` places before the anchor."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in unpacked(batch):
                values, offsets = read(data, offsets)
                names = Names(values, 1)
                lists = part.column("asked")
                owner = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
                asked = lists.flatten()
                field = {name: asked.field(name).to_numpy(zero_copy_only=False) for name in ("first", "n", "copies", "place", "key", "span", "whole")}
                # An id that has several texts may ask for places that this one lacks.
                fits = field["first"].astype(np.int64) + field["n"] + width - 1 <= np.diff(offsets)[owner]
                field, owner = {name: values[fits] for name, values in field.items()}, owner[fits]
                first = field["first"].astype(np.int64) + offsets[owner]
                place = field["place"].astype(np.int64)
                n = field["n"].astype(np.int64)
                # Places before the anchor run from place down to place - n + 1; cut them at multiples of BLOCK.
                high, low = place // BLOCK, (place - n + 1) // BLOCK
                pieces = high - low + 1
                row = np.repeat(np.arange(len(n)), pieces)
                block = flat_ranges(low, pieces)
                top = np.minimum(place[row], block * BLOCK + BLOCK - 1)
                bottom = np.maximum(place[row] - n[row] + 1, block * BLOCK)
                start = first[row] + place[row] - top
                count = top - bottom + 1
                every = flat_ranges(start, count)
                found = names.of(every, every + width)
                ends = np.concatenate(([0], np.cumsum(count) * 8)).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(ends), pa.py_buffer(found)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(field["key"][row]),
                        pa.array(block.astype(np.int32)),
                        pa.array(top.astype(np.int32)),
                        pa.array(field["span"][row]),
                        part.column("id").take(pa.array(owner[row])),
                        pa.array((start - offsets[owner[row]]).astype(np.int32)),
                        pa.array(field["n"][row]),
                        pa.array(field["copies"][row]),
                        pa.array(field["whole"][row].astype(bool)),
                        packed,
                    ],
                    names=["key", "block", "place", "span", "id", "start", "period", "copies", "settled", "names"],
                )

    return scan


def compare_blocks(earlier: bool, most_rows: int = 200_000):
    """Finds equal windows among rows sorted by key and block; holds whole groups, several at a time."""

    def compare(table: pa.Table) -> pa.RecordBatch:
        column = {name: table.column(name).to_numpy() for name in ("key", "place", "span", "id", "start", "period", "copies", "settled")}
        names = table.column("names").combine_chunks()
        if isinstance(names, pa.ChunkedArray):
            names = pa.concat_arrays(names.chunks)
        data, offsets = text_column(names)
        name = np.frombuffer(data.tobytes(), dtype=U64)
        count = np.diff(offsets) // 8
        row = np.repeat(np.arange(table.num_rows), count)
        step = flat_ranges(np.zeros(len(count), dtype=np.int64), count)
        key = column["key"][row]
        place = column["place"][row] - step
        order = np.lexsort((place, key, name))
        if not len(order):
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int32()), pa.array([], pa.int32())], names=["id", "start", "n"])
        changes = np.zeros(len(order), dtype=bool)
        changes[0] = True
        for values in (name, key, place):
            ordered = values[order]
            changes[1:] |= ordered[1:] != ordered[:-1]
        opens = np.flatnonzero(changes)
        group = np.cumsum(changes) - 1
        hit = np.zeros(len(order), dtype=bool)
        if earlier:
            ids = column["id"][row][order]
            hit[order] = ids > np.minimum.reduceat(ids, opens)[group]
        else:
            span = column["span"][row][order]
            hit[order] = (np.minimum.reduceat(span, opens) != np.maximum.reduceat(span, opens))[group]
        hit &= ~column["settled"][row]
        at = np.flatnonzero(hit)
        # Neighbouring hits of one row make one run.
        breaks = np.ones(len(at), dtype=bool)
        breaks[1:] = (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])
        heads = np.flatnonzero(breaks)
        runs = np.diff(np.append(heads, len(at)))
        # What holds for a span holds for the copies that follow it.
        source = row[at[heads]]
        copies = column["copies"][source].astype(np.int64)
        shift = flat_ranges(np.zeros(len(copies), dtype=np.int64), copies) * np.repeat(column["period"][source], copies)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(column["id"][source], copies)),
                pa.array((np.repeat(column["start"][source] + step[at[heads]], copies) + shift).astype(np.int32)),
                pa.array(np.repeat(runs, copies).astype(np.int32)),
            ],
            names=["id", "start", "n"],
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < most_rows:
                continue
            table = pa.Table.from_batches(held)
            keys, blocks = table.column("key").to_numpy(), table.column("block").to_numpy()
            change = np.flatnonzero((keys[1:] != keys[:-1]) | (blocks[1:] != blocks[:-1]))
            if not len(change):
                continue
            cut = int(change[-1]) + 1
            yield compare(table.slice(0, cut))
            held = table.slice(cut).to_batches()
            rows = table.num_rows - cut
        if rows:
            yield compare(pa.Table.from_batches(held))

    return scan


def gathered(runs: DataFrame) -> DataFrame:
    """The runs of each text in one row: (id, runs)."""
    return runs.groupBy("id").agg(F.collect_list(F.struct("start", "n")).alias("runs"))


def cut_runs(texts: DataFrame, runs: DataFrame, cut, schema: str) -> DataFrame:
    """Hands all rows of ``texts`` with the runs of their id to ``cut``; texts without runs are not moved.

    ``cut`` gets the columns of ``texts`` and ``runs``, null for none; the texts it takes by
    ``text_parts``. ``runs`` are read three times and should be written already.
    """
    marked = with_mark(texts, key_bits(runs, "id"), "id")
    found = gathered(runs)
    asked = packed_texts(marked.where("_asked").drop("_asked")).join(found, "id", "left")
    others = marked.where("NOT _asked").drop("_asked").withColumn("runs", F.lit(None).cast(found.schema["runs"].dataType))
    return others.mapInArrow(thrifty(cut), schema).unionByName(asked.mapInArrow(thrifty(cut), schema))


def run_marks(lists: pa.Array, offsets: np.ndarray, width: int) -> np.ndarray:
    """Marks the elements of a slice that the runs of its texts cover; a null list has none."""
    lists = lists.fill_null([]) if lists.null_count else lists
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    flat = lists.flatten()
    start = flat.field("start").to_numpy(zero_copy_only=False).astype(np.int64) + offsets[owner]
    end = start + flat.field("n").to_numpy(zero_copy_only=False) + width - 1
    start, end = np.minimum(start, offsets[owner + 1]), np.minimum(end, offsets[owner + 1])
    depth = np.zeros(int(offsets[-1]) + 1, dtype=np.int32)
    np.add.at(depth, start, 1)
    np.add.at(depth, end, -1)
    return np.cumsum(depth[:-1]) > 0
