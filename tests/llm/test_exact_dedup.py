"""Exact duplicates against grouping in Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest

from skyledger.llm import exact_dedup
from skyledger.llm.exact_dedup import exact_copies
from skyledger.llm.queries import op12_exact_dedup

from .samples import documents, frame

SPACE = re.compile(r"[\x20\x09-\x0D]")


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[SPACE.sub("", row[1] or "")].append((-len(row[1] or ""), row[0] is None, row[0] or 0, row[0]))
    out = []
    for normal, members in groups.items():
        members.sort(key=lambda member: member[:3])
        digest = hashlib.sha256(normal.encode()).hexdigest()
        out += [(member[3], members[0][3], len(members), place == 0, digest) for place, member in enumerate(members)]
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def spaced(draw, text):
    """The same text with other white space."""
    return "".join(c if not SPACE.match(c) else "".join(draw.choice(" \t\n\x0b\f\r") for _ in range(draw.randint(0, 3))) for c in text)


def table(seed=3):
    draw = random.Random(seed)
    rows = documents(seed)
    texts = [row[1] or "" for row in rows]
    rows += [(1000 + n, spaced(draw, draw.choice(texts)), "en", "a", 0) for n in range(60)]
    # Alike in length and beginning, or in length only.
    rows += [(2000 + n, "x" * 100 + "abc"[n % 3], None, None, 0) for n in range(6)]
    rows += [(2100 + n, "abc"[n % 3] + "x" * 100, None, None, 0) for n in range(6)]
    return rows


def test_equal_texts_meet(spark):
    rows = table()
    df = exact_copies(frame(spark, rows, extra=True), digests=True)
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert found(df) == expected(rows)


def test_repeated_rows_missing_ids_and_one_hot_group(spark):
    rows = [(5, "a b", None, None, 0)] * 3 + [(5, "ab", None, None, 0), (4, "a b", None, None, 0), (None, "a  b", None, None, 0)]
    rows += [(None, None, None, None, None)] * 2 + [(9, " \n", None, None, 0)]
    rows += [(n, "the same line", "en", "a", 0) for n in range(100, 900)] + [(3, "the\tsame  line", "en", "a", 0)]
    assert found(exact_copies(frame(spark, rows), digests=True)) == expected(rows)
    assert sum(row.kept for row in exact_copies(frame(spark, rows)).collect()) == 3


def test_columns_travel_along(spark):
    rows = table(4)
    df = frame(spark, rows, extra=True).withColumnRenamed("doc_id", "_id").withColumnRenamed("text", "_normal")
    kept = exact_copies(df, id="_id", text="_normal", carry=["lang"])
    by_id = defaultdict(list)
    for row in rows:
        by_id[row[0]].append(row[2])
    assert all(row.lang in by_id[row["_id"]] for row in kept.collect())
    assert kept.count() == len(rows)


def test_a_full_filter_only_costs_time(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FILTER_BITS", 8)
    rows = table(6)
    assert found(exact_copies(frame(spark, rows), digests=True)) == expected(rows)


def test_empty_table(spark):
    assert exact_copies(frame(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = exact_copies(frame(spark, documents()), digests=True)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query(spark):
    rows = table(8)
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/exact-dedup-query"
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    assert found(op12_exact_dedup(spark, folder)) == expected(rows)
