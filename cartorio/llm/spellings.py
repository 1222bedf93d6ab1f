"""Spelling variants by finite-state composition (operator 11).

The vocabulary is made a minimised acyclic acceptor A; T is the transducer that replaces, inserts or
deletes exactly one letter. The pairs that A o T o A accepts are the words one edit apart. Every edge of
A knows how many words end before it, so a path through A is the number of its word, and the composed
machine is walked for many words at once, level by level, as arrays.

No machine holds the whole vocabulary: it is entered from many initial states. A pair whose edit lies in
the second half of the shorter word shares the first half, another one the second; so words that share a
half are one part, entered from the state that half leads to. A part of more words than a task should
hold is cut again in the same way, on what its words don't share. Where an insertion could stand in
several places it is taken at the first letter that differs, so every pair is accepted in one part, once.
Tasks return counts and the best neighbour of each word, never pairs.

Defined results: null texts hold no words; an empty table gives an empty table; words are compared by
code point, at any length; equal counts are ordered by code point. A part that can't be cut has at most
two letters left a word: at most a + a*a words, for an alphabet of a letters.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.sources.scratch import fresh_folder

#: Words of a part, from which on it is cut; words of all parts walked side by side; pairs of edges at once.
CROWDED, TOGETHER, PAIRS = 5_000, 20_000, 1 << 20
_GROUP = 0x110000  # the edges of the start are parts, above all code points
KEY = ("size", "pre", "suf", "open")


# --- the acceptor ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Acceptor:
    """Edges of a state: ``first[state]`` to ``first[state + 1]``, by rising symbol; ``before`` is the
    number of words that leave the state ahead of the edge. The start is the last state."""

    first: np.ndarray
    symbols: np.ndarray
    targets: np.ndarray
    before: np.ndarray
    final: np.ndarray

    @property
    def keys(self) -> np.ndarray:
        owner = np.repeat(np.arange(len(self.final)), np.diff(self.first))
        return owner << 32 | self.symbols


def minimised(words: Sequence[Sequence[int]]) -> Acceptor:
    """The smallest acceptor of words given in rising order, each once: equal futures are one state."""
    known: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    counts: list[int] = []
    open_: list[list] = [[False, []]]  # of the word last read: whether a prefix is a word, its edges

    def close(depth: int, word: Sequence[int]) -> None:
        while len(open_) > depth + 1:
            final, edges = open_.pop()
            state = final, tuple(edges)
            if state not in known:
                known[state] = len(states)
                states.append(state)
                counts.append(final + sum(counts[target] for _, target in edges))
            open_[-1][1].append((word[len(open_) - 1], known[state]))

    last: Sequence[int] = ()
    for word in words:
        shared = 0
        for mine, other in zip(word, last):
            if mine != other:
                break
            shared += 1
        close(shared, last)
        open_.extend([False, []] for _ in range(len(word) - shared))
        open_[-1][0] = True
        last = word
    close(0, last)
    states.append((open_[0][0], tuple(open_[0][1])))

    first = np.cumsum([0] + [len(edges) for _, edges in states])
    symbols = np.array([symbol for _, edges in states for symbol, _ in edges], np.int64)
    targets = np.array([target for _, edges in states for _, target in edges], np.int64)
    held = np.array(counts, np.int64)[targets] if len(targets) else targets
    before = np.cumsum(held) - held
    final = np.array([state[0] for state in states])
    owner = np.repeat(np.arange(len(states)), np.diff(first))
    before = before - before[first[owner]] + final[owner] if len(before) else before
    return Acceptor(first, symbols, targets, before, final)


def _edges(machine: Acceptor, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All edges of some states: the place of the state, and the edge."""
    many = machine.first[states + 1] - machine.first[states]
    owner = np.repeat(np.arange(len(states)), many)
    return owner, machine.first[states][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)


class Composition:
    """A o T o A, entered at every part of the start."""

    def __init__(self, machine: Acceptor, short: np.ndarray, open_: np.ndarray) -> None:
        """``short``: letters of a part's shorter words; ``open_``: may a letter be added at their end?"""
        self.machine, self.keys = machine, machine.keys
        self.short, self.open = short, open_

    def pairs(self) -> Iterator[np.ndarray]:
        """The numbers of accepted pairs of words, in arrays of two columns."""
        m = self.machine
        start = len(m.final) - 1
        edges = np.arange(m.first[start], m.first[start + 1])
        state, number, part = m.targets[edges], m.before[edges], np.arange(len(edges))
        depth = 0
        while len(state):  # nothing edited so far: both copies of A are in one state
            row, edge = _edges(m, state)
            many = (m.first[state + 1] - m.first[state])[row]
            upto = np.cumsum(many)
            begin = 0
            while begin < len(row):  # a bounded number of pairs of edges is followed to the end
                base = upto[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(upto, base + PAIRS, side="right")))
                some = row[begin:end]
                yield from self._edited(state[some], number[some], part[some], edge[begin:end], depth)
                begin = end
            state, number, part = m.targets[edge], number[row] + m.before[edge], part[row]
            depth += 1

    def _edited(
        self, state: np.ndarray, number: np.ndarray, part: np.ndarray, edge: np.ndarray, depth: int
    ) -> Iterator[np.ndarray]:
        """The edit happens here: ``edge`` is read by the second copy of A only."""
        m = self.machine
        longer = number + m.before[edge]
        ended = m.final[state] & m.final[m.targets[edge]] & self.open[part]
        yield np.column_stack([number[ended], longer[ended]])  # added after the last letter

        row, other = _edges(m, state)
        apart = other != edge[row]
        row, other = row[apart], other[apart]
        # Replaced: the copies read two different letters; each pair in one order.
        once = edge[row] < other
        r, o = row[once], other[once]
        yield from self._together(
            m.targets[edge[r]], m.targets[o], longer[r], number[r] + m.before[o], part[r], depth + 1
        )
        # Inserted: the second copy reads a letter more, then both what follows it in the first.
        there, target = self._step(m.targets[edge[row]], m.symbols[other])
        r, o = row[there], other[there]
        yield from self._together(
            m.targets[o], m.targets[target], number[r] + m.before[o], longer[r] + m.before[target], part[r], None
        )

    def _step(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the states read the symbol, and by what edge."""
        wanted = states << 32 | symbols
        at = np.searchsorted(self.keys, wanted)
        there = at < len(self.keys)
        there[there] = self.keys[at[there]] == wanted[there]
        return there, at[there]

    def _together(self, one, two, a, b, part, depth: int | None) -> Iterator[np.ndarray]:
        """Both copies read the same letters until both accept. With ``depth``, words of equal length,
        which a part accepts only if they are its shorter ones."""
        m = self.machine
        while len(one):
            over = m.final[one] & m.final[two]
            if depth is not None:
                over &= self.short[part] == depth
                depth += 1
            yield np.column_stack([a[over], b[over]])
            row, edge = _edges(m, one)
            there, target = self._step(two[row], m.symbols[edge])
            row, edge = row[there], edge[there]
            one, two = m.targets[edge], m.targets[target]
            a, b, part = a[row] + m.before[edge], b[row] + m.before[target], part[row]


# --- parts ----------------------------------------------------------------------------------------


def _halved(entries: DataFrame) -> DataFrame:
    """Every part cut in two: words that share the first half of the rest too, or the second."""
    left = F.col("size") - F.length("pre") - F.length("suf")  # letters of the rest of a shorter word
    half = F.floor(left / 2).cast("int")
    long = F.length("rest")
    tail = (left - half).cast("int")
    rest = F.col("rest")
    return entries.select("word", "n", "size", F.explode(F.array(
        F.struct(
            F.concat("pre", rest.substr(F.lit(1), half)).alias("pre"),
            rest.substr(half + 1, long).alias("rest"), F.col("suf").alias("suf"), F.col("open").alias("open"),
        ),
        F.struct(
            F.col("pre").alias("pre"), rest.substr(F.lit(1), long - tail).alias("rest"),
            F.concat(rest.substr(long - tail + 1, tail), F.col("suf")).alias("suf"), F.lit(False).alias("open"),
        ),
    )).alias("cut")).select("word", "n", "size", "cut.*")


def _parts(words: DataFrame, folder: str, crowded: int) -> DataFrame:
    """Words with the parts they lie in: as words of ``size`` letters and as those of one more."""
    entries = _halved(words.select(
        "word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("size"),
        F.lit("").alias("pre"), F.col("word").alias("rest"), F.lit("").alias("suf"), F.lit(True).alias("open"),
    ).filter("size >= 0"))
    turn = 0
    while True:
        full = _written(
            entries.filter(F.col("size") - F.length("pre") - F.length("suf") >= 2)
            .groupBy(*KEY).agg(F.count("*").alias("held")).filter(F.col("held") > crowded).select(*KEY),
            folder, f"crowded{turn}",
        )
        if full.isEmpty():
            return entries
        entries = _written(
            entries.join(full, list(KEY), "left_anti").unionByName(
                _halved(entries.join(full, list(KEY), "left_semi").select("word", "n", "size", "pre", "rest", "suf", "open"))
            ), folder, f"parts{turn}",
        )
        turn += 1


_NEAR = "word string, near bigint, form string, form_n bigint"


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _whole_parts(batches):
        made = _neighbours(*rows)
        if made.num_rows:
            yield made


def _whole_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list, list]]:
    """Words, counts, rests and keys of whole parts of at least two words."""
    words, counts, rests, keys = [], [], [], []
    part: list[tuple] = []
    key = None

    def closed() -> None:
        if len(part) > 1:
            for word, n, rest in part:
                words.append(word)
                counts.append(n)
                rests.append(rest)
                keys.append(key)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("word", "n", "rest", *KEY)]
        for word, n, rest, *this in zip(*columns):
            if this != key:
                closed()
                part, key = [], this
                if len(words) >= TOGETHER:
                    yield words, counts, rests, keys
                    words, counts, rests, keys = [], [], [], []
            part.append((word, n, rest))
    closed()
    if words:
        yield words, counts, rests, keys


def _neighbours(words: list, counts: list, rests: list, keys: list) -> pa.RecordBatch:
    """How many words of its part each word is near to, and the first of them by count and word."""
    short, open_, symbols, last = [], [], [], None
    for rest, key in zip(rests, keys):
        if key != last:
            size, pre, suf, may_end = key
            short.append(size - len(pre) - len(suf))
            open_.append(may_end)
            last = key
        symbols.append((_GROUP + len(short), *map(ord, rest)))
    order = sorted(range(len(words)), key=lambda at: (-counts[at], words[at]))
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    near, best = np.zeros(len(words), np.int64), np.full(len(words), len(words))
    for pairs in Composition(minimised(symbols), np.array(short), np.array(open_)).pairs():
        for one, two in (pairs.T, pairs.T[::-1]):
            np.add.at(near, one, 1)
            np.minimum.at(best, one, place[two])
    found = np.flatnonzero(near).tolist()
    forms = [order[at] for at in best[found].tolist()]
    return pa.RecordBatch.from_arrays(
        [pa.array([words[at] for at in found], pa.string()), pa.array(near[found], pa.int64()),
         pa.array([words[at] for at in forms], pa.string()), pa.array([counts[at] for at in forms], pa.int64())],
        names=["word", "near", "form", "form_n"],
    )


# --- the whole ------------------------------------------------------------------------------------


def variants(words: DataFrame, factor: int = 10, crowded: int = CROWDED) -> DataFrame:
    """``words``: ``word`` (each once, none null) and ``n``. Returns them with ``n_near``, ``form`` and
    ``form_n`` (the near word of largest n, if that is ``factor`` times as large), and ``root``, where
    the forms lead to."""
    folder = fresh_folder(words.sparkSession, "spellings")
    words = _written(words.select("word", F.col("n").cast("bigint").alias("n")), folder, "words")
    parts = _parts(words, folder, crowded).repartition(*KEY).sortWithinPartitions(*KEY, "rest")
    near = parts.mapInArrow(_judged, _NEAR).groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("first")
    )
    follows = -F.col("first.less") >= factor * F.col("n")
    found = _written(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(follows, F.col("first.form")).alias("form"), F.when(follows, -F.col("first.less")).alias("form_n"),
        ), folder, "near",
    )
    return found.join(_roots(found, factor, folder), "word", "left").withColumn("root", F.coalesce("root", "word"))


def _roots(found: DataFrame, factor: int, folder: str) -> DataFrame:
    """``word`` and ``root`` of every word that has a form, by doubling: each step is followed twice as
    far as before. A form is ``factor`` times as frequent, so the largest count bounds the steps."""
    roots = found.filter("form is not null").select("word", F.col("form").alias("root"))
    most, steps = found.agg(F.max("n")).first()[0] or 0, 1
    while factor ** (steps + 1) <= most:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = _written(
            roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")),
            folder, f"roots{steps}",
        )
        steps *= 2
    return roots


def _written(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")
