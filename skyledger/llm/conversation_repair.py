"""Repair of conversation structure: the cheapest edits that make roles alternate, by a run-length DP.

Turns are dealt to tasks by ranges of (conversation, turn). A conversation that lies within one task is
repaired there. The first and the last one of a task may go on in its neighbours, and long ones are kept
in chunks: for these, each task's part becomes a min-plus matrix over four states, the parts of a
conversation are chained by these matrices, and every part then unrolls its own choices.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.tables import stored
from skyledger.llm.turn_costs import (
    BLANK, CLASSES, DUPLICATE, END, LEGAL, NONE, STATES, TRUNCATED, Repairer, ending, illegal_pairs, rewritten, runs_of,
)
from skyledger.operators.joins import join_unique

WHITE = " \t\n\x0b\f\r"
# Turns and characters above which a conversation is kept in chunks of that size.
CHUNK_TURNS = 4096
CHUNK_CHARS = 1 << 20
# Turns and characters of finished conversations handed on at a time.
BATCH_TURNS = 5000
BATCH_CHARS = 1 << 21

_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_TURNS = "array<struct<role: string, text: string>>"


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, lost): turns damaged by a checksum of their place, for tests of repair.

    Nulls read as one space, but a null conv_id or turn stays null as a column. A twentieth of the
    places each is lost, emptied, stripped of sentence ends, repeated, or given to the user. A lost
    turn keeps its row, marked.
    """
    place = F.concat(*[F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id",)], F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(place) % 20).alias("_kind"),
    )
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_copy", F.explode(times)).select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("_kind") == 0).alias("lost")
    )


def _symbol(role: str, text: str) -> int:
    rest = text.rstrip(WHITE)
    fault = BLANK if not rest else NONE if rest[-1] in ".!?" else TRUNCATED
    return 4 * CLASSES.get(role[:1], 3) + fault


def _digest(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def _spread(turns: list[int]) -> tuple[int | None, int | None, int]:
    """Least, greatest and number of different turns; they come in order."""
    return (turns[0], turns[-1], len(set(turns))) if turns else (None, None, 0)


def _faults(symbols: bytes) -> list[int]:
    return [sum(symbol & 3 == fault for symbol in symbols) for fault in (BLANK, DUPLICATE, TRUNCATED)]


class _Writer:
    """Rows of the table of finished conversations and of chunks of others."""

    def __init__(self, names: list[str], kinds: list[pa.DataType]) -> None:
        self.names, self.kinds = names, kinds
        self.rows: list[tuple] = []
        self.turns = self.chars = 0

    def full(self) -> bool:
        return self.turns >= BATCH_TURNS or self.chars >= BATCH_CHARS

    def add(self, row: tuple, turns: int, chars: int) -> None:
        self.rows.append(row)
        self.turns, self.chars = self.turns + turns + 1, self.chars + chars

    def batch(self) -> pa.RecordBatch:
        columns = [pa.array(list(column), kind) for column, kind in zip(zip(*self.rows), self.kinds)]
        self.rows, self.turns, self.chars = [], 0, 0
        return pa.record_batch(columns, names=self.names)


_NAMES = ["conv", "task", "part", "chunk", "done", *_COUNTS, "low", "high", "different", "cost", "audit", "symbols", "digests", "turns"]
_TURNS_KIND = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_KINDS = [pa.int32(), pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * 8, pa.string(), pa.binary(), pa.list_(pa.binary()), _TURNS_KIND]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repairs the conversations that lie within this task; hands on the others in chunks."""
    task = TaskContext.get().partitionId()
    repairer = Repairer()
    writer: _Writer | None = None
    conv, part, chunk = None, -1, 0
    turns: list[tuple[str, str]] = []
    places: list[int] = []
    chars = 0

    def cut() -> None:
        """Hands on what is held of the conversation as a chunk."""
        nonlocal chunk, chars, turns, places
        symbols = bytes(_symbol(*turn) for turn in turns)
        digests = [None if symbol & 3 == BLANK else _digest(*turn) for symbol, turn in zip(symbols, turns)]
        row = (conv, task, part, chunk, False, None, None, None, None, *_spread(places), None, None, symbols, digests, [{"role": r, "text": t} for r, t in turns])
        writer.add(row, len(turns), chars)
        turns, places, chars, chunk = [], [], 0, chunk + 1

    def finish() -> None:
        nonlocal turns, places, chars
        seen: set = set()
        marks = bytearray()
        for turn in turns:
            symbol = _symbol(*turn)
            if symbol & 3 != BLANK and turn in seen:
                symbol |= DUPLICATE
            seen.add(turn)
            marks.append(symbol)
        symbols = bytes(marks)
        runs = runs_of(symbols)
        after, before, cost = repairer.costs(runs, END)
        edits, state = repairer.unroll(runs, after, 0)
        audit = "".join(edits) + ending(state)
        repaired = rewritten(turns, audit, 0)
        counts = [*_faults(symbols), illegal_pairs(symbols)]
        row = (conv, task, part, 0, True, *counts, *_spread(places), cost + before[0], audit, None, None, [{"role": r, "text": t} for r, t in repaired])
        writer.add(row, len(turns), chars)
        turns, places, chars = [], [], 0

    for batch in batches:
        if writer is None:
            writer = _Writer(_NAMES, [batch.schema.field("conv").type, *_KINDS])
        columns = [batch.column(name).to_pylist() for name in ("conv", "turn", "role", "text", "lost")]
        for its, turn, role, text, lost in zip(*columns):
            if its != conv or part < 0:
                if part == 0 or chunk:
                    cut()
                elif part > 0:
                    finish()
                conv, part, chunk = its, part + 1, 0
                if writer.full():
                    yield writer.batch()
            if not lost:
                turns.append((role, text))
                chars += len(text)
                if turn is not None:
                    places.append(turn)
                if len(turns) >= CHUNK_TURNS or chars >= CHUNK_CHARS:
                    cut()
                    if writer.full():
                        yield writer.batch()
    if part >= 0:
        cut()
        yield writer.batch()


def _segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task's part of a conversation does to costs, and its counts."""
    repairer = Repairer()
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            marks, lengths, low, high, different = bytearray(), [], None, None, 0
            for piece in row["pieces"]:
                symbols = bytearray(piece["symbols"])
                for at in piece["repeats"] or ():
                    symbols[at] |= DUPLICATE
                marks += symbols
                lengths.append(len(symbols))
                if piece["low"] is not None:
                    different += piece["different"] - (high == piece["low"])
                    low, high = piece["low"] if low is None else low, piece["high"]
            symbols = bytes(marks)
            matrix = [cost for costs in repairer.matrix(runs_of(symbols)) for cost in costs]
            first, last = (symbols[0] >> 2, symbols[-1] >> 2) if symbols else (None, None)
            out.append({
                "key": row["key"], "task": row["task"], "part": row["part"], "symbols": symbols, "lengths": lengths, "matrix": matrix,
                **dict(zip(_COUNTS, [*_faults(symbols), illegal_pairs(symbols)])), "first": first, "last": last, "low": low, "high": high, "different": different,
            })
        yield pa.RecordBatch.from_pylist(out, schema=_SEGMENT_KIND)


_SEGMENT = (
    "key string, task int, part int, symbols binary, lengths array<int>, matrix array<long>, blank long, duplicate long, "
    "truncated long, illegal long, first int, last int, low long, high long, different long"
)
_SEGMENT_KIND = pa.schema(
    [("key", pa.string()), ("task", pa.int32()), ("part", pa.int32()), ("symbols", pa.binary()), ("lengths", pa.list_(pa.int32())), ("matrix", pa.list_(pa.int64())),
     *[(name, pa.int64()) for name in _COUNTS], ("first", pa.int32()), ("last", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("different", pa.int64())]
)
_END = "key string, blank long, duplicate long, truncated long, illegal long, gaps long, cost long, ends array<struct<task: int, part: int, costs: array<long>, final: boolean>>"
_END_KIND = pa.schema(
    [("key", pa.string()), *[(name, pa.int64()) for name in [*_COUNTS, "gaps", "cost"]],
     ("ends", pa.list_(pa.struct([("task", pa.int32()), ("part", pa.int32()), ("costs", pa.list_(pa.int64())), ("final", pa.bool_())])))]
)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs to go after each part of a conversation, and its totals. It has one part per task at most."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            parts = row["parts"]
            totals = {name: sum(part[name] for part in parts) for name in _COUNTS}
            last = low = high = None
            different = 0
            for part in parts:
                if part["first"] is not None:
                    totals["illegal"] += last is not None and (last, part["first"]) not in LEGAL
                    last = part["last"]
                if part["low"] is not None:
                    different += part["different"] - (high == part["low"])
                    low, high = part["low"] if low is None else low, part["high"]
            costs, ends = list(END), []
            for part in reversed(parts):
                least = min(costs)
                ends.append({"task": part["task"], "part": part["part"], "costs": [cost - least for cost in costs], "final": part is parts[-1]})
                matrix = [part["matrix"][at : at + STATES] for at in range(0, STATES * STATES, STATES)]
                costs = [min(line[k] + costs[k] for k in range(STATES)) for line in matrix]
            gaps = 0 if low is None else high - low + 1 - different
            out.append({"key": row["key"], **totals, "gaps": gaps, "cost": costs[0], "ends": ends})
        yield pa.RecordBatch.from_pylist(out, schema=_END_KIND)


_WALK = "key string, task int, part int, after array<int>, walks array<array<struct<state: int, edits: string>>>"
_WALK_KIND = pa.schema(
    [("key", pa.string()), ("task", pa.int32()), ("part", pa.int32()), ("after", pa.list_(pa.int32())),
     ("walks", pa.list_(pa.list_(pa.struct([("state", pa.int32()), ("edits", pa.string())]))))]
)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of a part for each state it may begin in, chunk by chunk, and the states it ends in."""
    repairer = Repairer()
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            runs = runs_of(row["symbols"])
            costs, _, _ = repairer.costs(runs, tuple(row["costs"]))
            walks, after = [], []
            for state in range(STATES):
                edits, last = repairer.unroll(runs, costs, state)
                pieces, at, now = [], 0, state
                for length in row["lengths"]:
                    mine = "".join(edits[at : at + length])
                    pieces.append({"state": now, "edits": mine})
                    now = _after(row["symbols"][at : at + length], mine, now)
                    at += length
                if row["final"]:
                    pieces[-1]["edits"] += ending(last)
                walks.append(pieces)
                after.append(last)
            out.append({"key": row["key"], "task": row["task"], "part": row["part"], "after": after, "walks": walks})
        yield pa.RecordBatch.from_pylist(out, schema=_WALK_KIND)


def _after(symbols: bytes, edits: str, state: int) -> int:
    """The state after the edits of a chunk."""
    roles = "sua?"
    turns = [(roles[symbol >> 2], "") for symbol in symbols]
    made = rewritten(turns, edits, state)
    return 1 + CLASSES[made[-1][0][0]] if made else state


_START = "task int, part int, start int"


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each part of a conversation begins."""
    for batch in batches:
        out = []
        for parts in batch.column("parts").to_pylist():
            state = 0
            for part in parts:
                out.append({"task": part["task"], "part": part["part"], "start": state})
                state = part["after"][state]
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("task", pa.int32()), ("part", pa.int32()), ("start", pa.int32())]))


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = []
        for turns, state, edits in zip(*[batch.column(name).to_pylist() for name in ("turns", "state", "edits")]):
            made.append([{"role": r, "text": t} for r, t in rewritten([(turn["role"], turn["text"]) for turn in turns], edits, state)])
        kept = [name for name in batch.schema.names if name not in ("turns", "state")]
        yield pa.record_batch([*[batch.column(name) for name in kept], pa.array(made, _TURNS_KIND)], names=[*kept, "turns"])


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each conversation, which come in order."""
    key, digest, any_yet = None, None, False

    def row() -> pa.RecordBatch:
        return pa.record_batch([pa.array([key]), pa.array([digest.hexdigest()])], names=["key", "repaired_sha256"])

    for batch in batches:
        for its, body in zip(batch.column("key"), batch.column("body")):
            its, body = its.as_py(), body.as_py()
            if its != key:
                if digest is not None:
                    yield row()
                key, digest, any_yet = its, hashlib.sha256(), False
            if body is not None:
                digest.update(b"\n" * any_yet + body.encode())
                any_yet = True
    if digest is not None:
        yield row()


def _body(turns: str) -> Column:
    """``role:text`` of all turns, one below the other."""
    return F.array_join(F.transform(turns, lambda turn: F.concat(turn["role"], F.lit(":"), turn["text"])), "\n")


def _scanned(rows: DataFrame, lost: str | None) -> DataFrame:
    """Finished conversations and chunks of the others, from turns dealt by ranges of (conversation, turn).

    Turns of one place are ordered by role and text, and rows alike in all may part anywhere, so no
    conversation and no turn is too frequent for a range.
    """
    read = rows.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), (F.coalesce(F.col(lost), F.lit(False)) if lost else F.lit(False)).alias("lost"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.xxhash64("text").asc(), F.asc("row")]
    sorted_rows = read.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    kind = dict(sorted_rows.dtypes)["conv"]
    schema = (
        f"conv {kind}, task int, part int, chunk int, done boolean, blank long, duplicate long, truncated long, illegal long, low long, high long, "
        f"different long, cost long, audit string, symbols binary, digests array<binary>, turns {_TURNS}"
    )
    scanned = sorted_rows.mapInArrow(_scan, schema)
    return stored(scanned.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit(""))), "conversations")


def _repeats(chunks: DataFrame) -> DataFrame:
    """(task, part, chunk, repeats): places of turns whose role and text the conversation has earlier."""
    turns = chunks.select("key", "task", "part", "chunk", F.posexplode("digests").alias("at", "digest")).where("digest IS NOT NULL")
    place = F.struct("task", "part", "chunk", "at")
    firsts = turns.groupBy("key", "digest").agg(F.min(place).alias("first"), F.count("*").alias("times")).where("times > 1").drop("times")
    later = join_unique(turns, firsts, ["key", "digest"]).where(place > F.col("first"))
    return later.groupBy("task", "part", "chunk").agg(F.collect_list("at").alias("repeats"))


def repair_conversations(rows: DataFrame, lost: str | None = None, digests: bool = False) -> tuple[DataFrame, DataFrame]:
    """Cheapest edits that leave the role initials of each conversation as ``(s?(ua)+)?``.

    ``rows`` has conv_id, turn, role and text; other columns are ignored. Rows whose column ``lost`` is
    true do not count, but their conversation is listed. Turns go in order, null ones first, then by
    role and by a hash of the text. Null roles and texts are one space. Repeated rows are duplicates of
    the first.

    A turn is blank without a character that is no white space, else a duplicate when its role and text
    came before, else truncated unless its last such character is one of ``.!?``. Keeping costs 0,
    another role (user or assistant) 2, deleting 3 (a must for blank ones and duplicates), inserting an
    empty turn of user or assistant 2, and a truncated turn that stays 1.

    Gives two tables. The first has one row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal (neighbours whose initials are none of su, ua, au), cost, audit (K, R, D, I in order; of
    the cheapest the least in ASCII), and with ``digests`` repaired_sha256, of ``role:text`` lines. The
    second has the repaired turns: conv_id, task, chunk, turns; a conversation's pieces go in order of
    task and chunk.
    """
    scanned = _scanned(rows, lost)
    whole, chunks = scanned.where("done"), scanned.where("NOT done")
    pieces = chunks.select("key", "task", "part", "chunk", "symbols", "low", "high", "different").join(_repeats(chunks), ["task", "part", "chunk"], "left")
    inside = F.array_sort(F.collect_list(F.struct("chunk", "symbols", "repeats", "low", "high", "different")))
    # A part's symbols, a byte per turn, lay in one task before.
    segments = stored(pieces.groupBy("key", "task", "part").agg(inside.alias("pieces")).mapInArrow(_segment, _SEGMENT), "segments")
    summary = F.struct("task", "part", "matrix", *_COUNTS, "first", "last", "low", "high", "different")
    chained = stored(segments.groupBy("key").agg(F.array_sort(F.collect_list(summary)).alias("parts")).mapInArrow(_chain, _END), "chains")
    ends = chained.select(F.inline("ends"))
    walks = stored(segments.select("key", "task", "part", "symbols", "lengths").join(ends, ["task", "part"]).mapInArrow(_walk, _WALK), "walks")
    order = F.array_sort(F.collect_list(F.struct("task", "part", "after")))
    starts = walks.groupBy("key").agg(order.alias("parts")).select("parts").mapInArrow(_starts, _START)
    chosen = walks.join(starts, ["task", "part"]).select("task", "part", F.posexplode(F.get("walks", F.col("start"))).alias("chunk", "walk"))
    edited = chunks.select("key", "conv", "task", "part", "chunk", "turns").join(
        chosen.select("task", "part", "chunk", "walk.state", "walk.edits"), ["task", "part", "chunk"]
    )
    kind = dict(edited.dtypes)["conv"]
    columns = ["key", "conv", "task", "part", "chunk", "turns", "state", "edits"]
    edited = edited.select(*columns).mapInArrow(_rewrite, f"key string, conv {kind}, task int, part int, chunk int, edits string, turns {_TURNS}")
    edited = stored(edited, "edited")

    audits = edited.groupBy("key").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("task", "chunk", "edits"))), lambda piece: piece["edits"]), "").alias("audit"),
        F.first("conv").alias("conv"),
    )
    parted = chained.drop("ends").join(audits, "key")
    columns = [F.col("conv").alias("conv_id"), "gaps", *_COUNTS, "cost", "audit"]
    gaps = F.when(F.col("low").isNull(), 0).otherwise(F.col("high") - F.col("low") + 1 - F.col("different")).cast("long")
    complete = whole.withColumn("gaps", gaps)
    if digests:
        bodies = edited.select("key", "task", "chunk", F.when(F.size("turns") > 0, _body("turns")).alias("body"))
        # A hash of one long text is taken from end to end; a task holds one piece of it at a time.
        hashed = bodies.repartition("key").sortWithinPartitions("key", "task", "chunk").mapInArrow(_hash, "key string, repaired_sha256 string")
        parted = parted.join(hashed, "key")
        complete = complete.withColumn("repaired_sha256", F.sha2(_body("turns"), 256))
        columns.append("repaired_sha256")
    found = complete.select(*columns).unionByName(parted.select(*columns))
    repaired = [F.col("conv").alias("conv_id"), "task", "chunk", "turns"]
    return found, whole.select(*repaired).unionByName(edited.select(*repaired))
