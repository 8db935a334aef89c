"""Cheapest repair of a sequence of turns by min-plus algebra over runs of equal symbols.

A symbol is a byte: 4 times the class of the role (0 system, 1 user, 2 assistant, 3 other) plus the
fault (0 none, 1 truncated, 2 blank, 3 duplicate). A repaired conversation reads, by role initials,
``(s?(ua)+)?``; the states are nothing yet, after s, after u, after a.
"""

from __future__ import annotations

from itertools import groupby

NONE, TRUNCATED, BLANK, DUPLICATE = range(4)
CLASSES = {"s": 0, "u": 1, "a": 2}
STATES = 4
FAR = 1 << 50
# Costs of edits; a truncated turn that is not deleted costs TRUNCATED more.
DELETE, INSERT, REROLE = 3, 2, 2
# The state after a turn of a class is kept, where it may stand.
KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
# The state after a turn of whatever role fits is inserted or takes the place of another.
FITTING = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
# Costs of what has to be inserted after the last turn.
END = (0, 2 * INSERT, INSERT, 0)
LEGAL = {(0, 1), (1, 2), (2, 1)}
MOST_CACHED = 200_000


def product(left: tuple, right: tuple) -> tuple:
    """Min-plus product of two matrices."""
    return tuple(
        tuple(min(min(left[i][k] + right[k][j] for k in range(STATES)), FAR) for j in range(STATES)) for i in range(STATES)
    )


def transition(symbol: int) -> tuple:
    """Costs of getting from state to state over one turn, with insertions before it."""
    kind, fault = divmod(symbol, 4)
    insert = [[FAR] * STATES for _ in range(STATES)]
    over = [[FAR] * STATES for _ in range(STATES)]
    for state in range(STATES):
        once = FITTING[state]
        for cost, to in ((2 * INSERT, FITTING[once]), (INSERT, once), (0, state)):
            insert[state][to] = min(insert[state][to], cost)
        over[state][state] = DELETE
        if fault <= TRUNCATED:
            over[state][once] = min(over[state][once], REROLE + fault)
            if (state, kind) in KEPT:
                to = KEPT[state, kind]
                over[state][to] = min(over[state][to], fault)
    return product(tuple(map(tuple, insert)), tuple(map(tuple, over)))


def runs_of(symbols: bytes) -> list[tuple[int, int]]:
    return [(symbol, sum(1 for _ in same)) for symbol, same in groupby(symbols)]


class Repairer:
    """Costs to go and choices, kept for the states of costs met before.

    Costs to go are vectors over states, less their least entry; few different ones occur.
    """

    def __init__(self) -> None:
        self.powers: dict[int, list[tuple]] = {}
        self.stepped: dict[tuple, tuple[tuple, int]] = {}
        self.chosen: dict[tuple, tuple[str, int]] = {}

    def power(self, symbol: int, exponent: int) -> tuple:
        """The transition of ``symbol`` to the power of two ``2 ** exponent``."""
        powers = self.powers.setdefault(symbol, [transition(symbol)])
        while len(powers) <= exponent:
            powers.append(product(powers[-1], powers[-1]))
        return powers[exponent]

    def back(self, symbol: int, count: int, costs: tuple) -> tuple[tuple, int]:
        """Costs to go before ``count`` turns of a symbol from those after them, and what was taken off."""
        key = (symbol, count, costs)
        found = self.stepped.get(key)
        if found is None:
            exponent, left = 0, count
            while left:
                if left & 1:
                    power = self.power(symbol, exponent)
                    costs = tuple(min(min(row[k] + costs[k] for k in range(STATES)), FAR) for row in power)
                exponent, left = exponent + 1, left >> 1
            least = min(costs)
            found = tuple(cost if cost >= FAR else cost - least for cost in costs), least
            if len(self.stepped) > MOST_CACHED:
                self.stepped.clear()
            self.stepped[key] = found
        return found

    def costs(self, runs: list[tuple[int, int]], end: tuple) -> tuple[list[tuple], tuple, int]:
        """Costs to go after each run, those before the first, and what was taken off all of them."""
        after, total = [], 0
        for symbol, count in reversed(runs):
            after.append(end)
            end, less = self.back(symbol, count, end)
            total += less
        return after[::-1], end, total

    def matrix(self, runs: list[tuple[int, int]]) -> list[list[int]]:
        """Costs from state to state over all runs; a column is the costs to go to one state."""
        columns = []
        for state in range(STATES):
            _, costs, less = self.costs(runs, tuple(0 if at == state else FAR for at in range(STATES)))
            columns.append([min(cost + less, FAR) for cost in costs])
        return [[column[state] for column in columns] for state in range(STATES)]

    def choose(self, symbol: int, state: int, costs: tuple) -> tuple[str, int]:
        """The edits up to and including one turn, least in ASCII of the cheapest, and the state after it."""
        key = (symbol, state, costs)
        found = self.chosen.get(key)
        if found is None:
            before = [min(row[k] + costs[k] for k in range(STATES)) for row in self.power(symbol, 0)]
            kind, fault = divmod(symbol, 4)
            edits = ""
            while True:
                wanted, fitting = before[state], FITTING[state]
                if DELETE + costs[state] == wanted:
                    found = edits + "D", state
                    break
                if INSERT + before[fitting] == wanted:
                    edits, state = edits + "I", fitting
                    continue
                kept = KEPT.get((state, kind))
                if kept is not None and fault + costs[kept] == wanted:
                    found = edits + "K", kept
                else:
                    found = edits + "R", fitting
                break
            if len(self.chosen) > MOST_CACHED:
                self.chosen.clear()
            self.chosen[key] = found
        return found

    def unroll(self, runs: list[tuple[int, int]], after: list[tuple], state: int) -> tuple[list[str], int]:
        """The edits of each turn, from a state on, and the last state."""
        edits = []
        for (symbol, count), costs in zip(runs, after):
            inside = [costs]
            for _ in range(count - 1):
                inside.append(self.back(symbol, 1, inside[-1])[0])
            while inside:
                edit, state = self.choose(symbol, state, inside.pop())
                edits.append(edit)
        return edits, state


def ending(state: int) -> str:
    """Edits after the last turn."""
    return "I" * (END[state] // INSERT)


def rewritten(turns: list[tuple[str, str]], edits: str, state: int) -> list[tuple[str, str]]:
    """Turns after their edits, from a state on."""
    out, at = [], 0
    for edit in edits:
        if edit == "I":
            state = FITTING[state]
            out.append((ROLES[state], ""))
            continue
        role, text = turns[at]
        at += 1
        if edit == "K":
            state = KEPT[state, CLASSES[role[:1]]]
            out.append((role, text))
        elif edit == "R":
            state = FITTING[state]
            out.append((ROLES[state], text))
    return out


def illegal_pairs(symbols: bytes) -> int:
    """Neighbouring turns whose role initials are none of su, ua, au."""
    kinds = [symbol >> 2 for symbol in symbols]
    return sum(pair not in LEGAL for pair in zip(kinds, kinds[1:]))
