"""N-gram Jaccard join and components against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from skyledger.llm import jaccard_join
from skyledger.llm.components import components, local_roots
from skyledger.llm.jaccard_join import Trie, jaccard_components, not_together, overlap_needed, prefix_length, prefix_overlap_needed

from .samples import documents, frame


def shingles(text, n):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = lower.encode().split()
    return frozenset(zip(*[words[at:] for at in range(n)])) if len(words) >= n else frozenset([tuple(words)] if words else [])


def roots(ids, links):
    up = {id: id for id in ids}

    def find(id):
        while up[id] != id:
            id = up[id]
        return id

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {id: find(id) for id in ids}


def brute(rows, n, percent):
    sets = {row[0]: shingles(row[1], n) for row in rows}
    links = []
    for a, one in sets.items():
        for b, other in sets.items():
            both = len(one & other)
            if a < b and one and 100 * both >= percent * (len(one) + len(other) - both):
                links.append((a, b))
    least = roots(sets, links)
    return sorted((id, len(one), least[id]) for id, one in sets.items())


@pytest.mark.parametrize("n,percent,block", [(3, 90, 256), (5, 80, 2), (1, 50, 3), (2, 100, 256)])
def test_components_match_brute_force(spark, monkeypatch, n, percent, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "FEW", 8 if block > 100 else 2)
    rows = documents(n)
    found = jaccard_components(frame(spark, rows, extra=True), n, percent)
    assert sorted(tuple(row) for row in found.collect()) == brute(rows, n, percent)


def test_exact_border_of_similarity(spark):
    # 19 shared of 20 and 21 single words: 95 of 100 links at 95, not at 96.
    one = " ".join(f"w{at}" for at in range(20))
    rows = [(1, one, None, None, None), (2, one.replace("w7 ", ""), None, None, None)]
    assert [row.component_id for row in jaccard_components(frame(spark, rows), 1, 95).orderBy("doc_id").collect()] == [1, 1]
    assert [row.component_id for row in jaccard_components(frame(spark, rows), 1, 96).orderBy("doc_id").collect()] == [1, 2]


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(4, "a b c d e f", None, None, None)] * 3 + [(None, "a b c d e f", None, None, None), (9, "A B C D E F", None, None, None)]
    found = sorted((tuple(row) for row in jaccard_components(frame(spark, rows), 3, 90).collect()), key=str)
    assert found == [(4, 4, 4)] * 3 + [(9, 4, 4), (None, 4, None)]
    assert jaccard_components(frame(spark, [])).count() == 0


def test_frequent_ngrams_change_nothing_but_the_order(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SEEN_TIMES", 1)
    rows = documents(8)
    found = jaccard_components(frame(spark, rows), 3, 80)
    assert sorted(tuple(row) for row in found.collect()) == brute(rows, 3, 80)


def test_groups_of_copies_meet_once_and_keep_all_links(spark):
    draw = random.Random(11)
    pairs = {tuple(sorted(draw.sample(range(60), 2))) for _ in range(300)}
    many = [(at, 5) for at in range(5, 25, 3)]
    frame_of = lambda found, schema: spark.createDataFrame(sorted(found), schema)
    kept = {tuple(row) for row in not_together(frame_of(pairs, "a long, b long"), frame_of(many, "class long, host long")).collect()}
    at_host: dict[int, set[int]] = {}
    for a, b in kept:
        at_host.setdefault(a, {a}).add(b)
    for member, host in many:
        at_host.setdefault(host, set()).add(member)
    assert kept < pairs
    assert all(any(a in there and b in there for there in at_host.values()) for a, b in pairs)


def test_trie_finds_all_pairs():
    draw = random.Random(2)
    for _ in range(60):
        universe = range(1, draw.choice([6, 12, 40]))
        sets = [np.array(sorted(draw.sample(list(universe), draw.randint(1, len(universe)))), dtype=">u8") for _ in range(draw.randint(1, 30))]
        queries = sets[: len(sets) // 2 + 1]
        percent = draw.choice([30, 50, 80, 90, 100])
        sizes = np.array([len(one) for one in sets])
        x, y = Trie(sets, sizes).alike(queries, sizes[: len(queries)], overlap_needed(percent))
        wanted = set()
        for a, one in enumerate(queries):
            for b, other in enumerate(sets):
                both = len(set(one.tolist()) & set(other.tolist()))
                if 100 * both >= percent * (len(one) + len(other) - both):
                    wanted.add((a, b))
        assert sorted(zip(x.tolist(), y.tolist())) == sorted(wanted)


def test_components_of_links(spark):
    draw = random.Random(4)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(at, at + 1) for at in range(1000, 1100)] + [(5000, at) for at in range(4000, 4300)]
    links += [(7, 7), links[0]]
    found = {row.id: row.component_id for row in components(spark.createDataFrame(links, "a long, b long")).collect()}
    linked = {id for a, b in links if a != b for id in (a, b)}
    assert found == roots(linked, [link for link in links if link[0] != link[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    a, b = np.array([5, 9, 3, 20]), np.array([9, 7, 4, 21])
    assert dict(zip(*(one.tolist() for one in local_roots(a, b)))) == {3: 3, 4: 3, 5: 5, 7: 5, 9: 5, 20: 20, 21: 20}


def test_prefixes_leave_every_alike_pair_possible():
    draw = random.Random(5)
    for _ in range(200):
        percent = draw.choice([30, 50, 80, 90, 100])
        base = draw.sample(range(1, 400), draw.randint(3, 60))
        sets = []
        for _ in range(12):
            kept = [x for x in base if draw.random() > draw.choice([0, 0.02, 0.1, 0.4])] or base
            sets.append(np.array(sorted({*kept, *draw.sample(range(1, 400), draw.choice([0, 1, 3, 10]))}), dtype=">u8"))
        sizes = np.array([len(one) for one in sets])
        prefixes = [one[: prefix_length(len(one), percent)] for one in sets]
        possible = set(zip(*(at.tolist() for at in Trie(prefixes, sizes).alike(prefixes, sizes, prefix_overlap_needed(percent)))))
        alike = set(zip(*(at.tolist() for at in Trie(sets, sizes).alike(sets, sizes, overlap_needed(percent)))))
        assert alike <= possible
