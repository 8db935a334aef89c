"""Anchors: few positions of a sequence, chosen by content, that tie equal windows together.

A window of ``width`` elements picks the least ranked candidate position between ``margin`` and
``width - margin`` from its start. Ranks and candidates depend on the ``margin`` elements on either
side only, so equal windows pick the same relative position, whichever document they stand in. The
windows that pick one anchor are neighbours; they are handled as one span. Where a text repeats a
short period, spans alike follow each other; they are one entry with a number of copies.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from skyledger.llm.textscan import U64, Names, mix, window_minimum

# Low bits of a rank hold the position, so that the leftmost of equal ranks wins.
POSITION_BITS = U64(30)


@dataclass
class Anchors:
    """Spans of windows: those starting at ``first`` to ``last`` share one anchor."""

    text: np.ndarray  # index of the text in the batch
    anchor: np.ndarray  # position of the anchor's surroundings, counted in the batch
    first: np.ndarray  # first window start, counted in the batch
    last: np.ndarray  # last window start
    key: np.ndarray  # name of the surroundings of the anchor
    span: np.ndarray  # name of everything the windows cover, and of the anchor's place in it
    copies: np.ndarray  # spans alike that follow each other without a gap, as in repeated words


def find_anchors(values: np.ndarray, offsets: np.ndarray, width: int, margin: int, candidates: np.ndarray | None = None) -> Anchors:
    """Anchors of all windows that lie inside one text; ``offsets`` are those of the texts.

    ``candidates`` marks positions that may be anchors; it must leave one at least in every
    ``width - 2 * margin + 1`` neighbours. Texts shorter than ``width`` have no window.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(values) < width:
        return Anchors(none, none, none, none, none.astype(U64), none.astype(U64), none)
    keys = Names(values, 0).windows(2 * margin)  # keys[i] names the surroundings of position i + margin
    ranks = (keys >> POSITION_BITS << POSITION_BITS) | np.arange(len(keys), dtype=U64)
    if candidates is not None:
        ranks[~candidates[margin : margin + len(keys)]] = ~U64(0)
    best = window_minimum(ranks, width - 2 * margin + 1)
    picked = (best & ((U64(1) << POSITION_BITS) - U64(1))).astype(np.int64)
    inside = np.zeros(len(picked) + 1, dtype=np.int8)
    sizes = np.diff(offsets)
    long = np.flatnonzero(sizes >= width)
    inside[offsets[long]] = 1
    np.add.at(inside, offsets[long + 1] - width + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    if not len(starts):
        return Anchors(none, none, none, none, none.astype(U64), none.astype(U64), none)
    chosen = picked[starts]
    change = np.flatnonzero((np.diff(starts) != 1) | (np.diff(chosen) != 0)) + 1
    opens = np.concatenate(([0], change))
    closes = np.concatenate((change, [len(starts)])) - 1
    first, last, anchor = starts[opens], starts[closes], chosen[opens]
    text = np.searchsorted(offsets, first, side="right") - 1
    span = mix(Names(values, 1).of(first, last + width) + (anchor - first).astype(U64) * U64(0xA24BAED4963EE407))
    key = keys[anchor]
    alike = (span[1:] == span[:-1]) & (key[1:] == key[:-1]) & (text[1:] == text[:-1])
    alike &= (first[1:] == last[:-1] + 1) & (last[1:] - first[1:] == last[:-1] - first[:-1])
    heads = np.flatnonzero(np.concatenate(([True], ~alike)))
    copies = np.diff(np.append(heads, len(first)))
    return Anchors(text[heads], anchor[heads], first[heads], last[heads], key[heads], span[heads], copies)
