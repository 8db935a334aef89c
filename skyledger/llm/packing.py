"""Best-fit packing: token pieces into sequences of fixed capacity.

Best-fit decreasing depends on lengths alone, and lengths are at most the capacity. So the plan is
made from the number of pieces of each length, whatever the number of documents: pieces of one length
go to sequences of one remaining room many at a time, exactly as one by one. Spark counts the lengths,
ranks the pieces within each length and hands every rank its place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.ranks import dense_ranks
from skyledger.llm.tables import stored
from skyledger.llm.textscan import forget_cache, slices, small_batches, thrifty
from skyledger.llm.tokens import encoder

# Text encoded at a time; words are looked up once per distinct word of it.
SLICE_BYTES = 4 << 20


class RoomTree:
    """A segment tree over remaining capacities: which is the least that holds a length?"""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = np.zeros(2 * self.size, dtype=bool)

    def mark(self, room: int, is_open: bool) -> None:
        node = room + self.size
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, length: int) -> int | None:
        """The least open room of at least ``length``."""
        node = length + self.size
        if self.open[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None


@dataclass
class Plan:
    """Ranks [rank, rank + count) of a length go to the sequences from ``sequence`` on, at ``offset``."""

    length: list[int] = field(default_factory=list)
    rank: list[int] = field(default_factory=list)
    sequence: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    sequences: int = 0

    def place(self, length: int, rank: int, sequence: int, offset: int) -> None:
        self.length.append(length)
        self.rank.append(rank)
        self.sequence.append(sequence)
        self.offset.append(offset)


def plan_best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing for ``counts`` pieces of each length, lengths from 1 to ``capacity``.

    Sequences of equal room are kept as runs of neighbouring numbers. A piece goes to the tightest
    sequence; that one stays the tightest until it is full for this length, so a run of sequences
    takes ``room // length`` pieces each.
    """
    plan, tree = Plan(), RoomTree(capacity)
    rooms: dict[int, list[tuple[int, int]]] = {}

    def give_back(room: int, sequence: int, count: int) -> None:
        if room and count:
            rooms.setdefault(room, []).append((sequence, count))
            tree.mark(room, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, count = capacity, plan.sequences, -(-left // (capacity // length))
                plan.sequences += count
            else:
                first, count = rooms[room].pop()
                if not rooms[room]:
                    tree.mark(room, False)
            each = room // length
            full = min(count, left // each)
            for slot in range(each if full else 0):
                plan.place(length, rank, first, capacity - room + slot * length)
                rank += full
            left -= full * each
            give_back(room - each * length, first, full)
            if full < count and left:  # fewer than one sequence takes
                for slot in range(left):
                    plan.place(length, rank, first + full, capacity - room + slot * length)
                    rank += 1
                give_back(room - left * length, first + full, 1)
                full, left = full + 1, 0
            give_back(room if room < capacity else 0, first + full, count - full)
    return plan


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Tokens of each text, ``end_id`` last, cut into pieces of ``capacity``; the last may be shorter.

    Gives (id, piece, start, length, ids_crc32) and, with ``keep_ids``, ``ids`` as binary: unsigned
    32-bit numbers, little-endian. A null text is empty, and so is one piece of the end id alone.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_cache("powers")
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids, offsets = encoder(tokenizer).ids(part.column("text"))
                sizes = np.diff(offsets) + 1
                ends = np.cumsum(sizes)
                closed = np.empty(int(sizes.sum()), dtype="<u4")
                keep = np.ones(len(closed), dtype=bool)
                keep[ends - 1] = False
                closed[keep], closed[~keep] = ids, end_id
                cuts = -(-sizes // capacity)
                row = np.repeat(np.arange(part.num_rows), cuts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                start = piece * capacity
                length = np.minimum(sizes[row] - start, capacity)
                at = (ends - sizes)[row] + start
                raw = [closed[a:b].tobytes() for a, b in zip(at, at + length)]
                columns = [
                    part.column("id").take(pa.array(row)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array([zlib.crc32(one) for one in raw], pa.int64()),
                ]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns, names = [*columns, pa.array(raw, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    texts = small_batches(docs).select(F.col(id).alias("id"), F.col(text).alias("text"))
    return texts.mapInArrow(thrifty(encode), schema).withColumnRenamed("id", id)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Packs all texts into as few sequences of at most ``capacity`` tokens as best fit finds.

    Returns the pieces of ``token_pieces`` with ``sequence_id`` and ``offset``: the place of the
    piece in its sequence, without gaps from 0. Repeated rows are packed like any others; an empty
    table gives an empty result. The plan holds at most one entry per pair of length and room.
    """
    pieces = stored(token_pieces(docs, tokenizer, capacity, end_id, id, text, keep_ids), "pieces")
    counts = {row.length: row["count"] for row in pieces.groupBy("length").count().collect()}  # one row per length
    plan = plan_best_fit(counts, capacity)
    # Entries by length, then rank; an entry holds from its rank to the next one's.
    order = np.lexsort((np.array(plan.rank, dtype=np.int64), np.array(plan.length, dtype=np.int64)))
    lengths, ranks, sequences, offsets = (np.array(v, dtype=np.int64)[order] for v in (plan.length, plan.rank, plan.sequence, plan.offset))
    wide = max(counts.values(), default=0) + 1

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Length and rank in one ascending number, as an index into the plan.
        marks = lengths * wide + ranks
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            entry = np.searchsorted(marks, length * wide + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in kept),
                    pa.array(sequences[entry] + rank - ranks[entry]),
                    pa.array(offsets[entry]),
                ],
                names=[*kept, "sequence_id", "offset"],
            )

    kept = pieces.columns
    schema = ", ".join(f"`{name}` {kind}" for name, kind in pieces.dtypes) + ", sequence_id long, offset long"
    ranked = dense_ranks(pieces, "length", [id, "piece", "ids_crc32"], "rank")
    return ranked.mapInArrow(thrifty(assign), schema)
