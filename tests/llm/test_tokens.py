"""Token counts and packing against the tokenizer library and item-by-item best fit."""

from __future__ import annotations

import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from skyledger.llm.packing import RoomTree, pack, plan_best_fit
from skyledger.llm.token_counts import CACHE_SCHEMA, count_tokens
from skyledger.llm.tokens import WordEncoder, default_path
from skyledger.session import work_dir

from .samples import documents, frame

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ODD = ["", " ", "a  b   c ", "x  y", "  　a b", "don't you'll 's", "foo<|endoftext|> bar  <|endoftext|>\n\n x ",
       "<|startoftext|>a <|ENDOFTEXT|>", "á é ́b", "İSTANBUL Straße ǅ ΑΣ Σ", "\x1c a \x1f b",
       "tab\t\tx\n\ny", "1234 12a a12 ¼ x²", "日本語 テスト", "\U0001f642\U0001f642 a\U0001f642b", "a.b,c!! ... 'tis",
       "\x85 b", "ªº µm", "words, words. WORDS!!", "a\r\n b\v\fc", " lead", "trail  "]


@pytest.mark.parametrize("file", FILES)
def test_ids_are_those_of_the_library(file):
    draw = random.Random(1)
    texts = ODD + ["".join(draw.choice(" \t\n aBé'.,1́<|>") for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    texts += [row[1] or "" for row in documents()]
    encoder, library = WordEncoder(default_path(file)), Tokenizer.from_file(default_path(file))
    wanted = [one.ids for one in library.encode_batch(texts, add_special_tokens=False)]
    for first in range(0, len(texts), 500):
        ids, offsets = encoder.ids(pa.array(texts[first : first + 500]))
        found = [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
        assert found == wanted[first : first + 500]


def test_counts_come_from_the_cache(spark):
    rows = documents()
    path = default_path(FILES[0])
    cache = work_dir(spark, "cache")
    library = Tokenizer.from_file(path)
    wanted = sorted((row[0], len((row[1] or "").encode()), len(library.encode(row[1] or "", add_special_tokens=False).ids)) for row in rows)
    half = frame(spark, rows[: len(rows) // 2], extra=True)
    count_tokens(half, path, cache=cache).count()
    first = spark.read.schema(CACHE_SCHEMA).parquet(cache).count()
    assert first == len({row[1] or "" for row in rows[: len(rows) // 2]})
    found = count_tokens(frame(spark, rows, extra=True), path, cache=cache)
    assert sorted(map(tuple, found.collect())) == wanted
    assert spark.read.schema(CACHE_SCHEMA).parquet(cache).count() == len({row[1] or "" for row in rows})
    count_tokens(frame(spark, rows), path, cache=cache).count()
    assert spark.read.schema(CACHE_SCHEMA).parquet(cache).count() == len({row[1] or "" for row in rows})


def test_counts_of_odd_tables(spark):
    path = default_path(FILES[0])
    assert count_tokens(frame(spark, []), path).count() == 0
    rows = [(None, "a b", None, None, None), (1, None, None, None, None), (1, None, None, None, None)]
    assert sorted(map(tuple, count_tokens(frame(spark, rows), path).collect()), key=str) == [(1, 0, 0), (1, 0, 0), (None, 3, 2)]


def best_fit(lengths, capacity):
    """Sorted remaining rooms after best-fit decreasing, piece by piece."""
    rooms: list[int] = []
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        room = rooms.pop(at) if at < len(rooms) else capacity
        bisect.insort(rooms, room - length)
    return rooms


@pytest.mark.parametrize("seed", range(80))
def test_plan_is_best_fit_decreasing(seed):
    draw = random.Random(seed)
    capacity = draw.choice([7, 16, 50, 100])
    counts = Counter(draw.randint(1, capacity) for _ in range(draw.randint(0, 300)))
    plan = plan_best_fit(counts, capacity)
    entries = sorted(zip(plan.length, plan.rank, plan.sequence, plan.offset))
    filled = defaultdict(list)
    for at, (length, rank, sequence, offset) in enumerate(entries):
        last = entries[at + 1][1] if at + 1 < len(entries) and entries[at + 1][0] == length else counts[length]
        for step in range(last - rank):
            filled[sequence + step].append((offset, length))
    for pieces in filled.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
    rooms = sorted(capacity - sum(length for _, length in pieces) for pieces in filled.values())
    assert rooms == best_fit(list(counts.elements()), capacity)
    assert plan.sequences == len(rooms)


def test_room_tree_finds_the_tightest():
    draw, tree, rooms = random.Random(3), RoomTree(100), set()
    for _ in range(500):
        room = draw.randint(1, 100)
        tree.mark(room, room not in rooms)
        rooms ^= {room}
        length = draw.randint(1, 100)
        assert tree.tightest(length) == min((one for one in rooms if one >= length), default=None)


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing_holds_every_token_once(spark, capacity):
    rows = documents(2)
    path = default_path(FILES[1])
    library = Tokenizer.from_file(path)
    found = pack(frame(spark, rows, extra=True), path, capacity, keep_ids=True).collect()
    wanted = []
    for row in rows:
        ids = [*library.encode(row[1] or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            raw = np.array(ids[start : start + capacity], dtype="<u4").tobytes()
            wanted.append((row[0], piece, start, len(raw) // 4, zlib.crc32(raw), raw))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in found) == sorted(wanted)
    sequences = defaultdict(list)
    for row in found:
        sequences[row.sequence_id].append((row.offset, row.length))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(sequences) == len(best_fit([row.length for row in found], capacity))


def test_packing_of_odd_tables(spark):
    path = default_path(FILES[1])
    assert pack(frame(spark, []), path).count() == 0
    rows = [(None, "a", None, None, None), (1, None, None, None, None), (1, None, None, None, None)]
    found = pack(frame(spark, rows), path, capacity=4).collect()
    assert sorted((r.sequence_id, r.offset, r.length) for r in found) == [(0, 0, 2), (0, 2, 1), (0, 3, 1)]
