"""Conversation repair against a turn-by-turn search over all edits."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from skyledger.llm import conversation_repair as module
from skyledger.llm.conversation_repair import damage, repair_conversations
from skyledger.llm.queries import op13_conversation_repair
from skyledger.llm.turn_costs import FAR, STATES, Repairer, product, transition

TURNS = "conv_id long, turn long, role string, text string"
SOLID = re.compile(r"[^\x20\x09-\x0D]")
DONE = re.compile(r"(s?(ua)+)?\Z")


def damaged(rows):
    """Turns after damage, and the conversations there were."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [] if kind == 0 else [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        solid = SOLID.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(turns):
    """(cost, audit, repaired turns) by trying every edit on every sequence of roles kept so far."""
    fits = lambda roles: re.match(r"(s?(ua)*u?)?\Z", roles)
    # By the last role: the roles so far beyond it do not matter.
    best = {"": (0, "", ())}

    def insert(best):
        for _ in range(2):
            for last, (cost, audit, made) in list(best.items()):
                for role in ("user", "assistant"):
                    roles = {"": "", "s": "s", "u": "u", "a": "ua"}[last] + role[0]
                    better(best, role[0], (cost + 2, audit + "I", (*made, (role, "")))) if fits(roles) else None

    def better(best, last, entry):
        if last not in best or entry[:2] < best[last][:2]:
            best[last] = entry

    for (role, text), fault in zip(turns, faults(turns)):
        insert(best)
        after: dict = {}
        for last, (cost, audit, made) in best.items():
            better(after, last, (cost + 3, audit + "D", made))
            if fault in ("blank", "duplicate"):
                continue
            for edit, name, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                roles = {"": "", "s": "s", "u": "u", "a": "ua"}[last] + (name[:1] or "?")
                if fits(roles) and name[:1] in ("s", "u", "a"):
                    better(after, name[:1], (cost + price + (fault == "truncated"), audit + edit, (*made, (name, text))))
        best = after
    insert(best)
    return min(entry for last, entry in best.items() if last in ("", "a"))


def order(row):
    return (row[1] is not None, row[1] or 0, row[2])


def expected(rows, all_rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    out = []
    for conv in {row[0] for row in all_rows}:
        members = sorted(groups[conv], key=order)
        turns = [row[2:] for row in members]
        found = faults(turns)
        numbers = {row[1] for row in members if row[1] is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        initials = [(a[0][:1], b[0][:1]) for a, b in zip(turns, turns[1:])]
        illegal = sum("".join(pair) not in ("su", "ua", "au") for pair in initials)
        cost, audit, made = cheapest(turns)
        assert DONE.match("".join(role[0] for role, _ in made))
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in made).encode()).hexdigest()
        out.append((conv, gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def results(df):
    return sorted(map(tuple, df.collect()), key=repr)


def table(seed=1, conversations=60, longest=14):
    draw = random.Random(seed)
    rows = []
    for conv in range(conversations):
        texts = ["Hello.", "why", " \t", "", "Yes!", "No? ", "é…", None, "a\nb."]
        places = draw.sample(range(-3, 40), draw.randint(1, longest))
        role = itertools.cycle(["user", "assistant"])
        for place in places:
            named = next(role) if draw.random() < 0.7 else draw.choice(["system", "user", "assistant", "tool", None, "", "author"])
            text = draw.choice(texts) if draw.random() < 0.4 else f"text {draw.randint(0, 99)}."
            rows.append((conv, place if draw.random() < 0.95 or places.index(place) else None, named, text))
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Ho."), (None, 2, None, None), (10**12, None, None, None)]
    rows += [(7777, n, "user" if n % 2 else "assistant", f"long {n % 50}" + "." * (n % 3 > 0)) for n in range(700)]
    rows += [(8888, n // 9, "user", "same.") for n in range(90)]
    return rows


def turns_frame(spark, rows, parts=5):
    df = spark.createDataFrame(rows, TURNS).repartition(parts)
    for name in ("conv", "task", "part", "chunk", "key", "row", "lost", "digests", "cost"):
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    return df


def test_powers_are_repeated_products():
    repairer = Repairer()
    for symbol in range(16):
        costs = (0, 4, 2, 0)
        for count in range(1, 40):
            one = transition(symbol)
            power = one
            for _ in range(count - 1):
                power = product(power, one)
            straight = [min(power[i][j] + costs[j] for j in range(STATES)) for i in range(STATES)]
            found, less = repairer.back(symbol, count, costs)
            assert [cost + less for cost in found] == straight
            assert all(cost < FAR for cost in found)


@pytest.mark.parametrize("chunk", [4096, 3])
def test_repair_is_the_cheapest(spark, monkeypatch, chunk):
    monkeypatch.setattr(module, "CHUNK_TURNS", chunk)
    monkeypatch.setattr(module, "BATCH_TURNS", 20)
    rows = table()
    found, _ = repair_conversations(damage(turns_frame(spark, rows)), lost="lost", digests=True)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert results(found) == expected(damaged(rows), rows)


def test_undamaged_turns_and_repaired_texts(spark, monkeypatch):
    monkeypatch.setattr(module, "CHUNK_CHARS", 40)
    rows = table(2)
    found, turns = repair_conversations(turns_frame(spark, rows), digests=True)
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert results(found) == expected(plain, rows)
    texts = defaultdict(list)
    for row in sorted(turns.collect(), key=lambda row: (row.task, row.chunk)):
        texts[row.conv_id] += [f"{turn.role}:{turn.text}" for turn in row.turns]
    digests = {row.conv_id: row.repaired_sha256 for row in found.collect()}
    assert digests == {conv: hashlib.sha256("\n".join(lines).encode()).hexdigest() for conv, lines in texts.items()}


def test_one_conversation_over_all_tasks(spark):
    draw = random.Random(9)
    rows = [(1, n, draw.choice(["user", "assistant", "assistant", "system"]), f"t{draw.randint(0, 400)}" + draw.choice(["", "."])) for n in range(3000)]
    found, _ = repair_conversations(damage(turns_frame(spark, rows)), lost="lost", digests=True)
    assert results(found) == expected(damaged(rows), rows)


def test_lost_conversations_and_empty_tables(spark):
    rows = [(conv, turn, "user", "x.") for conv in range(400) for turn in range(1)]
    found, _ = repair_conversations(damage(turns_frame(spark, rows)), lost="lost", digests=True)
    assert results(found) == expected(damaged(rows), rows)
    empty = hashlib.sha256(b"").hexdigest()
    assert (0, 0, 0, 0, 0, 0, "", empty) in {row[1:] for row in results(found)}
    found, turns = repair_conversations(damage(turns_frame(spark, [])), lost="lost", digests=True)
    assert found.count() == 0 and turns.count() == 0


def test_names_of_conversations_may_be_text(spark):
    rows = [(str(conv), turn, role, text) for conv, turn, role, text in table(3, 20) if conv is not None]
    df = spark.createDataFrame(rows, TURNS.replace("conv_id long", "conv_id string")).repartition(3)
    found, _ = repair_conversations(damage(df), lost="lost", digests=True)
    assert results(found) == expected(damaged(rows), rows)


def test_query(spark):
    rows = table(5)
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/conversation-query"
    turns_frame(spark, rows).write.parquet(f"{folder}/conversations.parquet")
    assert results(op13_conversation_repair(spark, folder)) == expected(damaged(rows), rows)
