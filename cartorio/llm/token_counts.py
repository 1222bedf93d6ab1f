"""Token counts by merging all pre-tokens in step (operator 10).

Distinct pre-tokens of a group of texts are held as one ragged array of symbols. In every round each
pre-token's lowest-ranked pair is merged at all its places at once, in all pre-tokens together, until
none has a pair left; the surviving symbols are counted. A merged symbol's own pairs always rank after
the merge that made it, so merging all places of a pair at once equals merging them one by one.

Defined results: a null or empty text counts 0 bytes and 0 tokens; a special string inside a text is
one token, as the library takes it by default; texts are never cut; repeated rows count each for
itself; an empty table gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio.llm.pairs import NONE, Memo, PairTable
from cartorio.llm.pretokens import pretoken_starts
from cartorio.llm.ragged import bytes_of, distinct_slices, groups, run_sums, taken


@dataclass(frozen=True)
class Merges:
    byte_ids: np.ndarray
    pairs: PairTable
    special: tuple[bytes, ...]


def _letters_of_bytes() -> list[str]:
    """The visible letter that stands for each byte in a byte-level vocabulary: printable bytes for
    themselves, the others in order from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


def read_merges(path: str) -> Merges:
    """A byte-level BPE of the tokenizers library; runs on the driver, the result is of fixed size."""
    whole = json.loads(Path(path).read_text(encoding="utf-8"))
    ids = whole["model"]["vocab"]
    pairs = {
        (ids[left], ids[right]): (rank, ids[left + right])
        for rank, (left, right) in enumerate(whole["model"]["merges"])
    }
    return Merges(
        np.array([ids[letter] for letter in _letters_of_bytes()], np.int64), PairTable(pairs),
        tuple(token["content"].encode() for token in whole["added_tokens"]),
    )


def surviving(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> np.ndarray:
    """How many symbols each run (none empty) has when no pair of it merges any more."""
    counts, owner = np.zeros(len(lengths), np.int64), np.arange(len(lengths))
    ranks, merged = _pair_ranks(symbols, lengths, table)
    while len(owner):
        starts = np.cumsum(lengths) - lengths
        best = np.minimum.reduceat(ranks, starts)
        over = best >= NONE
        counts[owner[over]] = lengths[over]
        if over.any():
            kept = np.repeat(~over, lengths)
            symbols, ranks, merged = symbols[kept], ranks[kept], merged[kept]
            owner, lengths, best = owner[~over], lengths[~over], best[~over]
            if not len(owner):
                break
        hit = ranks == np.repeat(best, lengths)
        at = np.flatnonzero(hit)
        follows = np.diff(at, prepend=-2) == 1  # places that overlap: every second one is merged
        chain = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
        at = at[(np.arange(len(at)) - chain) % 2 == 0]
        symbols[at] = merged[at]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        gone = np.zeros(len(symbols) + 1, np.int64)
        np.cumsum(~keep, out=gone[1:])
        ends = np.cumsum(lengths)
        lengths = lengths - (gone[ends] - gone[ends - lengths])
        changed = np.zeros(len(symbols), bool)
        changed[at] = True
        symbols, ranks, merged, changed = symbols[keep], ranks[keep], merged[keep], changed[keep]
        changed[:-1] |= changed[1:].copy()
        last = np.cumsum(lengths) - 1
        changed[last], ranks[last] = False, NONE
        at = np.flatnonzero(changed)
        slots = table.find(symbols[at], symbols[at + 1])
        ranks[at], merged[at] = table.ranks[slots], table.merged[slots]
    return counts


def _pair_ranks(
    symbols: np.ndarray, lengths: np.ndarray, table: PairTable
) -> tuple[np.ndarray, np.ndarray]:
    ranks, merged = np.full(len(symbols), NONE), np.zeros(len(symbols), np.int64)
    inner = np.ones(len(symbols), bool)
    inner[np.cumsum(lengths) - 1] = False
    at = np.flatnonzero(inner)
    slots = table.find(symbols[at], symbols[at + 1])
    ranks[at], merged[at] = table.ranks[slots], table.merged[slots]
    return ranks, merged


def without_special(
    data: np.ndarray, offsets: np.ndarray, special: Sequence[bytes]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts cut at special strings: bytes, piece offsets, each piece's text, special strings a text."""
    none = np.zeros(len(offsets) - 1, np.int64)
    whole = data.tobytes()
    if not special or not any(mark in whole for mark in special):
        return data, offsets, np.arange(len(none)), none
    pattern = re.compile(b"|".join(map(re.escape, sorted(special, key=len, reverse=True))))
    pieces, owner = [], []
    for at, (begin, end) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
        for found in pattern.finditer(whole, begin, end):
            pieces.append(whole[begin : found.start()])
            owner.append(at)
            none[at] += 1
            begin = found.end()
        pieces.append(whole[begin:end])
        owner.append(at)
    ends = np.concatenate([[0], np.cumsum([len(piece) for piece in pieces])])
    return np.frombuffer(b"".join(pieces), np.uint8), ends, np.array(owner), none


class Counter:
    """Counts tokens of groups of texts; remembers the counts of pre-tokens already merged."""

    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        none = np.zeros(0, np.int64)
        self.memo = Memo(np.zeros(0, np.uint64), none, np.zeros(0, np.uint8), none, none)

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        data, pieces, owner, counts = without_special(data, offsets, self.merges.special)
        starts = pretoken_starts(data, pieces)
        ends = np.append(starts[1:], len(data))
        hashes, first, which = distinct_slices(data, starts, ends)
        at, known = self.memo.places(hashes, data, starts[first], ends[first])
        tokens = np.zeros(len(hashes), np.int64)
        tokens[known] = self.memo.pool[self.memo.starts[at[known]]]
        if len(new := np.flatnonzero(~known)):
            lengths = (ends - starts)[first[new]]
            symbols = self.merges.byte_ids[taken(data, starts[first[new]], lengths)]
            tokens[new] = surviving(symbols, lengths, self.merges.pairs)
            self.memo.add(
                hashes[new], tokens[new], np.ones(len(new), np.int64), data, starts[first[new]], ends[first[new]]
            )
        sums = run_sums(tokens[which], np.searchsorted(starts, pieces))
        np.add.at(counts, owner, sums)
        return counts


def token_counts(
    docs: DataFrame,
    path: str,
    keys: Sequence[str] = ("doc_id",),
    text: str = "text",
    limit: int = 1024,
) -> DataFrame:
    """The key columns, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``)."""
    merges = docs.sparkSession.sparkContext.broadcast(read_merges(path))
    rows = docs.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    out = T.StructType([*docs.select(*keys).schema, *T.StructType.fromDDL(
        "n_bytes bigint, n_tokens bigint, over_limit boolean"
    )])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(merges.value)
        for group in groups(batches, "__text"):
            data, offsets = bytes_of(group.column("__text"))
            counts = counter.count(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [*(group.column(key) for key in keys), pa.array(np.diff(offsets), pa.int64()),
                 pa.array(counts, pa.int64()), pa.array(counts > limit)],
                names=[*keys, "n_bytes", "n_tokens", "over_limit"],
            )

    return rows.mapInArrow(task, out)
