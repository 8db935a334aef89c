"""Substring and suffix dedup against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import repeats
from skyledger.llm.substring_dedup import LONGEST, MARGIN, remove_repeats, symbol_starts
from skyledger.llm.suffix_dedup import MARGIN as BYTE_MARGIN
from skyledger.llm.suffix_dedup import remove_repeated_bytes

from .samples import documents, frame


def brute_words(rows, width):
    split = [(row[0], (row[1] or "").encode().split()) for row in rows]
    least = {}
    for id, words in split:
        for at in range(len(words) - width + 1):
            window = tuple(words[at : at + width])
            least[window] = min(least.get(window, id), id)
    found = []
    for id, words in split:
        gone = [False] * len(words)
        for at in range(len(words) - width + 1):
            if least[tuple(words[at : at + width])] < id:
                gone[at : at + width] = [True] * width
        kept = b" ".join(word for word, out in zip(words, gone) if not out)
        found.append((id, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(found)


def brute_bytes(rows, width):
    texts = [(row[0], (row[1] or "").encode()) for row in rows]
    times = Counter(text[at : at + width] for _, text in texts for at in range(len(text) - width + 1))
    found = []
    for id, text in texts:
        gone = np.zeros(len(text) + 1, dtype=int)
        for at in range(len(text) - width + 1):
            if times[text[at : at + width]] > 1:
                gone[at] += 1
                gone[min(at + width, len(text))] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))[: len(gone)]).sum())
        kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
        found.append((id, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found)


def found_words(df, width):
    rows = remove_repeats(df, width=width).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    return sorted(tuple(row) for row in rows.collect())


def found_bytes(df, width, batches=3):
    rows = remove_repeated_bytes(df, width=width, batches=batches)
    rows = rows.select("doc_id", "n_bytes", "n_removed", F.size("removed"), F.sha2("kept", 256))
    return sorted(tuple(row) for row in rows.collect())


@pytest.mark.parametrize("width", [2 * MARGIN + LONGEST, 50])
def test_words_match_brute_force(spark, width):
    rows = documents(width)
    found = found_words(frame(spark, rows, extra=True), width)
    assert found == brute_words(rows, width)
    assert sum(row[2] for row in found) > 500


@pytest.mark.parametrize("width,batches", [(2 * BYTE_MARGIN + 1, 5), (400, 1)])
def test_bytes_match_brute_force(spark, width, batches):
    rows = [row for row in documents(width) if len(row[1] or "") < 20_000]
    found = found_bytes(frame(spark, rows, extra=True), width, batches)
    assert found == brute_bytes(rows, width)
    assert sum(row[2] for row in found) > 500


def test_removed_spans_tell_the_cut(spark):
    rows = documents(3)[:40]
    for row in remove_repeated_bytes(frame(spark, rows), width=150).join(frame(spark, rows), "doc_id").collect():
        raw = (row.text or "").encode()
        for span in reversed(row.removed):
            raw = raw[: span.start] + raw[span.start + span.length :]
        assert bytes(row.kept) == raw


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{at}" for at in range(80))
    rows = [(1, text, None, None, None), (1, text, None, None, None), (None, text, None, None, None), (2, text, None, None, None)]
    words = remove_repeats(frame(spark, rows)).select("doc_id", "n_removed").collect()
    assert sorted(map(tuple, words), key=str) == [(1, 0), (1, 0), (2, 80), (None, 0)]
    bytes_ = remove_repeated_bytes(frame(spark, rows), width=101).select("doc_id", "n_removed").collect()
    assert sorted(map(tuple, bytes_), key=str) == [(1, len(text)), (1, len(text)), (2, len(text)), (None, 0)]


def test_one_id_with_two_texts_does_not_fail(spark):
    text = " ".join(f"w{at}" for at in range(80))
    rows = [(1, text, None, None, None), (2, text, None, None, None), (2, "short one", None, None, None)]
    assert remove_repeats(frame(spark, rows)).count() == 3
    assert remove_repeated_bytes(frame(spark, rows), width=101).count() == 3


def test_empty_tables(spark):
    assert remove_repeats(frame(spark, [])).count() == 0
    assert remove_repeated_bytes(frame(spark, [])).count() == 0


def test_narrow_windows_are_refused(spark):
    with pytest.raises(ValueError):
        remove_repeats(frame(spark, []), width=2 * MARGIN)
    with pytest.raises(ValueError):
        remove_repeated_bytes(frame(spark, []), width=2 * BYTE_MARGIN)


def test_symbols_depend_on_their_surroundings_only():
    """The same words between different neighbours get the same symbol starts inside."""
    draw = np.random.default_rng(1)
    for trial in range(50):
        alphabet = draw.integers(1, 2**63, 4 if trial % 2 else 50).astype(np.uint64)
        middle = draw.choice(alphabet, 120)
        marks = []
        for _ in range(2):
            left, right = draw.choice(alphabet, draw.integers(0, 40)), draw.choice(alphabet, draw.integers(0, 40))
            whole = np.concatenate((left, middle, right))
            starts = symbol_starts(whole, np.array([0, len(whole)]))
            marks.append(starts[len(left) : len(left) + 120][MARGIN : 120 - MARGIN])
            assert np.diff(np.flatnonzero(starts)).max() <= LONGEST
        assert (marks[0] == marks[1]).all()


@pytest.mark.parametrize("width", [50, 400])
def test_no_task_holds_all_variants_of_a_passage(spark, monkeypatch, width):
    """A passage that many texts share in contexts of their own, and a bound below their number."""
    draw = np.random.default_rng(7)
    passage = " ".join(f"p{at}" for at in range(130))
    own = [[" ".join(f"w{word}" for word in draw.integers(0, 10**6, 45)) for _ in range(2)] for _ in range(90)]
    rows = [(3 * at, f"{left} {passage} {right}", None, None, None) for at, (left, right) in enumerate(own)]
    rows += [(500, "two step " * 200, None, None, None), (501, "x " + "two step " * 150, None, None, None)]
    compare_blocks = repeats.compare_blocks

    def bounded(earlier):
        scan = compare_blocks(earlier)

        def watch(batches):
            sizes = {}
            for batch in batches:
                for group in zip(batch.column("key").to_pylist(), batch.column("block").to_pylist()):
                    sizes[group] = sizes.get(group, 0) + 1
                    assert sizes[group] <= 40
                yield from scan(iter([batch]))

        return watch

    monkeypatch.setattr(repeats, "MANY", 40, raising=False)
    monkeypatch.setattr(repeats, "compare_blocks", bounded)
    if width == 50:
        assert found_words(frame(spark, rows), width) == brute_words(rows, width)
    else:
        assert found_bytes(frame(spark, rows), width) == brute_bytes(rows, width)


@pytest.mark.parametrize("width", [50, 400])
def test_windows_grouped_by_spark_match_brute_force(spark, monkeypatch, width):
    rows = [row for row in documents(width) if len(row[1] or "") < 20_000]
    monkeypatch.setattr(repeats, "MANY", 0)
    if width == 50:
        assert found_words(frame(spark, rows, extra=True), width) == brute_words(rows, width)
    else:
        assert found_bytes(frame(spark, rows, extra=True), width) == brute_bytes(rows, width)
