"""Pre-tokens of byte-level BPE without regular expressions.

Every codepoint gets a class. The state "what does the current pre-token consist of" is a function of
the state before and the class, and such functions compose associatively: blocks of codepoints are
composed side by side, their compositions are chained, and a second pass gives the state before every
codepoint. State and class decide whether a pre-token begins; only white space also looks one ahead.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

import numpy as np

# What the pattern of the rank files distinguishes.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

LETTER, NUMBER, OTHER, SHORT, LONG, SPACE, WHITE = range(7)  # SHORT, LONG: "'" of a contraction
IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, AFTER_WHITE, ONE_LEFT, TWO_LEFT, CLOSED = range(8)
CLASSES, STATES, BLOCK = 7, 8, 64


@cache
def _class_of_codepoint() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter(
        (kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)),
        np.uint8, sys.maxunicode + 1,
    )
    table[list(WHITE_SPACE)] = WHITE
    table[0x20] = SPACE
    return table


def _next_state(state: int, kind: int) -> int:
    if state in (TWO_LEFT, ONE_LEFT):
        return ONE_LEFT if state == TWO_LEFT else CLOSED
    if kind in (SHORT, LONG) and state not in (AFTER_SPACE, IN_OTHERS):
        return ONE_LEFT if kind == SHORT else TWO_LEFT
    return {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, SPACE: AFTER_SPACE, WHITE: AFTER_WHITE}.get(
        kind, IN_OTHERS
    )


NO, YES, IF_LAST = range(3)


def _begins(state: int, kind: int) -> int:
    if state in (TWO_LEFT, ONE_LEFT):
        return NO
    if state == CLOSED:
        return YES
    if kind in (SPACE, WHITE):  # the last of a run of white space stands alone or joins what follows
        return IF_LAST if state in (AFTER_SPACE, AFTER_WHITE) else YES
    same = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS}.get(kind, IN_OTHERS)
    return NO if state in (same, AFTER_SPACE) else YES


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state and begin of a pre-token by class and state; classes from 7 on open a text."""
    pairs = [
        (CLOSED if kind >= CLASSES else state, kind % CLASSES)
        for kind in range(2 * CLASSES) for state in range(STATES)
    ]
    return (
        np.array([_next_state(*pair) for pair in pairs], np.intp),
        np.array([_begins(*pair) for pair in pairs], np.uint8),
    )


def states_before(kinds: np.ndarray) -> np.ndarray:
    """The state before every codepoint, by a scan over compositions of transition functions."""
    step, _ = _tables()
    n = len(kinds)
    rows = -(-n // BLOCK)
    padded = np.zeros(rows * BLOCK, np.uint8)
    padded[:n] = kinds
    columns = np.ascontiguousarray(padded.reshape(rows, BLOCK).T).astype(np.intp) * STATES
    composed = np.tile(np.arange(STATES, dtype=np.intp), (rows, 1))
    for column in columns:
        composed += column[:, None]
        composed = step.take(composed)
    entered, state = np.empty(rows, np.intp), CLOSED
    for row, function in enumerate(composed.tolist()):
        entered[row] = state
        state = function[state]
    before = np.empty((BLOCK, rows), np.uint8)
    for at, column in enumerate(columns):
        before[at] = entered
        entered = step.take(column + entered)
    return before.T.reshape(-1)[:n]


def codepoints(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every codepoint its first byte, value, class, and whether a text opens there (also at the end)."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    opens = np.zeros(len(points) + 1, bool)
    opens[np.searchsorted(at, offsets[:-1])] = True  # an empty text opens where the next one does
    opens[-1] = True
    return at, points, _class_of_codepoint()[points], opens


def pretoken_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The byte at which each pre-token begins; none spans two texts.

    ``data`` holds valid UTF-8 of all texts, ``offsets`` where each begins and the last ends.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    at, points, kinds, opens = codepoints(data, offsets)

    quotes = np.flatnonzero(points == ord("'"))
    if len(quotes):
        ahead = np.zeros((2, len(quotes)), np.uint32)
        for far in (1, 2):
            inside = quotes[np.minimum(quotes + far, len(points)) < len(points)]
            ahead[far - 1, : len(inside)] = points[inside + far]
        ahead[0][opens[quotes + 1]] = 0
        ahead[1][opens[quotes + 1] | opens[np.minimum(quotes + 2, len(points))]] = 0
        for ending in CONTRACTIONS:
            fits = ahead[0] == ord(ending[0])
            if len(ending) == 2:
                fits &= ahead[1] == ord(ending[1])
            kinds[quotes[fits]] = SHORT if len(ending) == 1 else LONG

    white = (kinds == SPACE) | (kinds == WHITE)
    ink_follows = np.zeros(len(points), bool)
    ink_follows[:-1] = ~white[1:] & ~opens[1:-1]
    kinds = kinds + np.uint8(CLASSES) * opens[:-1].astype(np.uint8)
    begins = _tables()[1][kinds.astype(np.intp) * STATES + states_before(kinds)]
    return at[(begins == YES) | ((begins == IF_LAST) & ink_follows)]
