"""Mixing and sharding against their laws, and apportionment against highest quotients."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from skyledger.llm.mixing import fill_targets, mix_sources, sainte_lague
from skyledger.llm.sharding import place_units, shard_documents

from .samples import documents, frame


def quotients(weights, seats, most):
    won = [0] * len(weights)
    for _ in range(min(seats, sum(limit for weight, limit in zip(weights, most) if weight > 0))):
        best = max(range(len(weights)), key=lambda at: (weights[at] / (2 * won[at] + 1) if won[at] < most[at] else -1, -at))
        won[best] += 1
    return won


@pytest.mark.parametrize("seed", range(60))
def test_seats_go_to_highest_quotients(seed):
    draw = random.Random(seed)
    number = draw.randint(1, 12)
    weights = [draw.choice([0.0, draw.uniform(0.1, 50), draw.randint(1, 9)]) for _ in range(number)]
    most = [draw.choice([0, 2, 5, 1000]) for _ in range(number)]
    seats = draw.randint(0, 200)
    found = sainte_lague(np.array(weights), seats, np.array(most)).tolist()
    wanted = quotients(weights, seats, most)
    assert sum(found) == sum(wanted)
    # Ties may fall to either side; the quotients that won are the same.
    spent = lambda won: sorted(weights[at] / (2 * seat + 1) for at, number in enumerate(won) for seat in range(number))
    assert np.allclose(spent(found), spent(wanted))


def test_targets_stop_and_share_the_excess():
    sizes, weights = np.array([10.0, 100, 30, 0]), np.array([3.0, 1, 2, 3])
    found = fill_targets(sizes, weights, 1.5, 2)
    assert found.tolist() == [20, 140, 60, 0] or np.isclose(found.sum(), 210)
    assert (found <= 2 * sizes + 1e-9).all()
    assert fill_targets(np.zeros(2), np.ones(2), 1.5, 2).tolist() == [0, 0]


def test_mix_keeps_its_laws(spark):
    rows = documents()
    found = mix_sources(frame(spark, rows, extra=True), block_tokens=4, carry=["lang"])
    again = mix_sources(frame(spark, rows[::-1]), block_tokens=4)
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    mix = {row.doc_id: row for row in found.collect()}
    assert sorted(map(tuple, again.select(*columns).collect())) == sorted(tuple(mix[id][name] for name in columns) for id in mix)
    size, taken, target = Counter(), Counter(), {}
    order = sorted({row[3] for row in rows}, key=lambda source: (source is None, (source or "").encode()))
    for row in rows:
        one = mix[row[0]]
        assert one.size == len((row[1] or "").encode().split())
        assert one.taken <= 2 * one.size
        assert one.taken == one.passes * one.size + sum(part.end - part.start for part in one.parts)
        assert all(0 <= part.start < part.end <= one.size for part in one.parts)
        size[row[3]] += one.size
        taken[row[3]] += one.taken
        target[row[3]] = one.target
    wanted = fill_targets(np.array([size[source] for source in order], float), np.resize([3.0, 1, 2], len(order)), 1.5, 2)
    for source, aim in zip(order, wanted):
        assert abs(target[source] - aim) < 1e-6
        assert abs(taken[source] - aim) <= max(16, 0.01 * aim)
    assert {row.source_size for row in mix.values()} == set(size.values())


def test_mix_of_odd_tables(spark):
    assert mix_sources(frame(spark, [])).count() == 0
    rows = [(1, None, None, "a", None), (1, None, None, "a", None), (None, "a b c", None, None, None)]
    found = sorted((row.size, row.taken) for row in mix_sources(frame(spark, rows)).collect())
    assert found[:2] == [(0, 0), (0, 0)] and found[2][0] == 3 and found[2][1] <= 6


def test_shards_are_even_and_whole(spark):
    rows = documents()
    rows = [row for row in rows if len(row[1] or "") < 4000] + [(1000 + at, f"filler {at}", None, None, None) for at in range(300)]
    found = shard_documents(frame(spark, rows, extra=True), shards=4).collect()
    texts = {row[0]: (row[1] or "").encode() for row in rows}
    size, slots, homes = Counter(), defaultdict(list), defaultdict(set)
    for row in found:
        raw = texts[row.doc_id]
        assert (row.size, row.text_crc32, row.tokens) == (len(raw) + 1, zlib.crc32(raw), len(raw.split()))
        size[row.shard] += row.size
        slots[row.shard].append(row.slot)
        homes[raw].add(row.shard)
    assert set(slots) == set(range(4))
    assert all(sorted(one) == list(range(len(one))) for one in slots.values())
    assert max(size.values()) <= 1.02 * min(size.values())
    assert all(len(shards) == 1 for shards in homes.values())
    assert sorted(map(tuple, found)) == sorted(map(tuple, shard_documents(frame(spark, rows[::-1]), shards=4).collect()))


def test_a_group_above_a_shard_is_cut(spark):
    rows = [(at, "the same text", None, None, None) for at in range(900)] + [(5000 + at, f"other {at}", None, None, None) for at in range(300)]
    size = Counter()
    for row in shard_documents(frame(spark, rows), shards=8).collect():
        size[row.shard] += row.size
    assert len(size) == 8 and max(size.values()) <= 1.1 * min(size.values())


def test_shards_of_odd_tables(spark):
    assert shard_documents(frame(spark, [])).count() == 0
    rows = [(None, None, None, None, None), (1, "", None, None, None), (1, "", None, None, None)]
    found = shard_documents(frame(spark, rows), shards=2).collect()
    assert sorted(row.size for row in found) == [1, 1, 1]


def test_units_fill_all_dimensions():
    draw = np.random.default_rng(1)
    vectors = draw.lognormal(size=(2000, 3))
    placed = place_units(vectors, 8)
    for dimension in range(3):
        fill = np.bincount(placed, weights=vectors[:, dimension], minlength=8)
        assert fill.max() <= 1.05 * fill.min()
