"""The divergence audit against plain counting with Python's integers."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from skyledger.llm import divergence as module
from skyledger.llm.divergence import divergence, joint_tables, term_counts
from skyledger.llm.queries import op11_source_divergence

from .samples import documents, frame

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def counted(rows, least_docs):
    groups, seen = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, _ in rows:
        words = TERM.findall((text or "").translate(LOWER))
        groups[lang or "", source or ""].update(words)
        seen[lang or ""].update(set(words))
    kept = {lang: {term for term, docs in terms.items() if docs >= least_docs} for lang, terms in seen.items()}
    return groups, kept


def expected(rows, least_docs=3, top=200):
    groups, kept = counted(rows, least_docs)

    def shares(counts, terms):
        size = sum(counts[term] for term in terms)
        return {term: 1 + 1_000_000_000 * (counts[term] + 1) // (size + len(terms)) for term in terms}

    def ranked(lang, source, part, values, most=None):
        order = sorted(values, key=lambda pair: (-pair[1], pair[0].encode()))[:most]
        return [(lang, source, part, item, value, rank) for rank, (item, value) in enumerate(order, 1)]

    out = []
    for lang, terms in kept.items():
        p = {source: shares(counts, terms) for (its, source), counts in groups.items() if its == lang}
        q = shares(sum((counts for (its, _), counts in groups.items() if its == lang), Counter()), terms)
        for source in p:
            pairs = [(other, sum((p[source][t] - p[other][t]) ** 2 // p[other][t] for t in terms)) for other in p if other != source]
            out += ranked(lang, source, "pair", pairs)
            above = [(t, (p[source][t] - q[t]) ** 2 // q[t]) for t in terms if groups[lang, source][t] > 0 and p[source][t] > q[t]]
            out += ranked(lang, source, "term", above, top)
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.collect()))


def table(seed=3):
    """Words of all frequencies in five sources of three languages, and the odd texts."""
    draw = random.Random(seed)
    names = ["".join(draw.choice("abCDé日") for _ in range(draw.randint(1, 5))) for _ in range(120)]
    rows = documents(seed)
    for number in range(150):
        words = [names[min(int(draw.expovariate(0.06)), 119)] for _ in range(draw.randint(0, 120))]
        text = "".join(word + draw.choice([" ", ".", "1", "\n", "_"]) for word in words)
        rows.append((5000 + number, text, draw.choice(["en", "de", None, ""]), draw.choice(["a", "b", "é", None, "Z"]), 0))
    return rows


def test_values_and_ranks(spark):
    rows = table()
    df = divergence(frame(spark, rows, extra=True))
    assert dict(df.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}
    assert found(df) == expected(rows)


@pytest.mark.parametrize("columns, cells", [(7, 1 << 23), (1024, 64), (3, 9)])
def test_small_blocks_and_tiles_give_the_same(spark, monkeypatch, columns, cells):
    monkeypatch.setattr(module, "COLUMNS", columns)
    monkeypatch.setattr(module, "CELLS", cells)
    rows = table(4)
    assert found(divergence(frame(spark, rows), least_docs=2, top=7)) == expected(rows, 2, 7)


def test_joint_tables(spark):
    rows = table(5)
    groups, kept = counted(rows, 3)
    wanted = Counter()
    for lang, terms in kept.items():
        sources = sorted(source for its, source in groups if its == lang)
        for i, a in enumerate(sources):
            for b in sources[i:]:
                for term in terms:
                    x, y = groups[lang, a][term], groups[lang, b][term]
                    if x and y:
                        wanted[lang, a, x, b, y] += 1
    assert found(joint_tables(term_counts(frame(spark, rows)))) == sorted((*key, terms) for key, terms in wanted.items())


def test_small_pieces_and_early_flushes_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(module, "PIECE", 5)
    monkeypatch.setattr(module, "HELD_TERMS", 10)
    rows = table(6)
    assert found(divergence(frame(spark, rows))) == expected(rows)


def test_groups_without_terms(spark):
    rows = [(1, None, None, None, None), (2, "1 2 3", "", "x", 0), (3, "alone", "de", "x", 0), (3, "alone", "de", "y", 0), (4, "", "fr", "x", 0)]
    rows += [(5, "same", "en", source, 0) for source in ("a", "b", "b", None)] + [(6, "", "en", "c", 0)]
    assert found(divergence(frame(spark, rows))) == expected(rows)
    assert divergence(frame(spark, [])).count() == 0


def test_query(spark):
    rows = table(8)
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/divergence-query"
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    assert found(op11_source_divergence(spark, folder)) == expected(rows)
