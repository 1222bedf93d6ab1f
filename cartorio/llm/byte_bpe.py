"""Byte-level BPE encoding and decoding by a table of ranks (operator 8).

Pre-tokens are located by a scan over codepoint classes (``pretokens``), without regular expressions.
Each distinct slice is merged once per task, always the leftmost pair of lowest rank first, and kept;
the ids of a text are its slices' runs. The byte at which each token begins is kept beside the ids.

Defined results: a null or empty text has no tokens; repeated rows are encoded each for itself; a text
is never cut, whatever its length; an empty table gives an empty table. Only the named key columns and
the text are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio.llm.pairs import NONE, Memo, PairTable
from cartorio.llm.pretokens import pretoken_starts
from cartorio.llm.ragged import bytes_of, distinct_slices, groups, run_sums, slice_hashes, taken

#: Slices of more bytes are merged one by one with a heap instead of side by side.
LONG_SLICE = 64


@dataclass(frozen=True)
class Vocabulary:
    """The bytes of every id, and which pairs of ids merge to which."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    ids: np.ndarray
    byte_ids: np.ndarray
    pairs: PairTable

    def bytes_of_ids(self, ids: np.ndarray) -> np.ndarray:
        return taken(self.data, self.starts[ids], self.lengths[ids])


def read_ranks(path: str) -> Vocabulary:
    """A file of lines "base64 rank"; runs on the driver, the result is of fixed size."""
    ranks = {
        base64.b64decode(token): int(rank)
        for token, rank in map(bytes.split, Path(path).read_bytes().splitlines())
    }
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left, right] = rank, rank
    in_order = sorted((rank, token) for token, rank in ranks.items())
    ids = np.array([rank for rank, _ in in_order], np.int64)
    lengths, starts = np.zeros((2, ids[-1] + 1), np.int64)
    lengths[ids] = [len(token) for _, token in in_order]
    starts[ids] = np.cumsum(lengths[ids]) - lengths[ids]
    return Vocabulary(
        np.frombuffer(b"".join(token for _, token in in_order), np.uint8), starts, lengths, ids,
        np.array([ranks[bytes([b])] for b in range(256)], np.int64), PairTable(pairs),
    )


def _merge_one(symbols: list[int], table: PairTable) -> list[int]:
    """The pair merges of one long slice."""
    n = len(symbols)
    after, before, alive = [*range(1, n), -1], [*range(-1, n - 1)], [True] * n
    found: dict[tuple[int, int], tuple[int, int]] = {}

    def push(at: int) -> None:
        pair = symbols[at], symbols[after[at]]
        if pair not in found:
            slot = int(table.find(np.array(pair[:1]), np.array(pair[1:]))[0])
            found[pair] = int(table.ranks[slot]), int(table.merged[slot])
        rank, merged = found[pair]
        if rank < NONE:
            heapq.heappush(heap, (rank, at, *pair, merged))

    heap: list[tuple[int, int, int, int, int]] = []
    for at in range(n - 1):
        push(at)
    while heap:
        _, at, left, right, merged = heapq.heappop(heap)
        gone = after[at]
        if not alive[at] or gone < 0 or (symbols[at], symbols[gone]) != (left, right):
            continue
        symbols[at], alive[gone], after[at] = merged, False, after[gone]
        if after[at] >= 0:
            before[after[at]] = at
            push(at)
        if before[at] >= 0:
            push(before[at])
    return [symbol for symbol, kept in zip(symbols, alive) if kept]


def merge_slices(
    symbols: np.ndarray, lengths: np.ndarray, table: PairTable
) -> tuple[np.ndarray, np.ndarray]:
    """Pair merges of many slices side by side: in each round every slice merges the leftmost of its
    lowest-ranked pairs. Returns the remaining symbols and how many each slice has."""
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    owner = np.arange(len(lengths))
    big = np.flatnonzero(lengths > LONG_SLICE)
    starts = np.cumsum(lengths) - lengths
    for at in big.tolist():
        left = _merge_one(symbols[starts[at] : starts[at] + lengths[at]].tolist(), table)
        done.append((np.array([at]), np.array(left, np.int64), np.array([len(left)])))
    if len(big):
        small = np.setdiff1d(owner, big, assume_unique=True)
        symbols, owner = taken(symbols, starts[small], lengths[small]), small
        lengths = lengths[small]

    def ranks_at(at: np.ndarray) -> np.ndarray:
        slots = table.find(symbols[at], symbols[at + 1])
        merged[at] = table.merged[slots]
        return table.ranks[slots]

    merged = np.zeros(len(symbols), np.int64)
    ranks = np.full(len(symbols), NONE)
    inner = np.ones(len(symbols), bool)
    inner[np.cumsum(lengths) - 1] = False
    at = np.flatnonzero(inner)
    ranks[at] = ranks_at(at)
    while len(owner):
        starts = np.cumsum(lengths) - lengths
        best = np.minimum.reduceat(ranks << 32 | np.arange(len(ranks)), starts)
        over = best >> 32 >= NONE
        if over.any():
            kept = np.repeat(~over, lengths)
            done.append((owner[over], symbols[~kept], lengths[over]))
            shift = np.cumsum(np.where(over, lengths, 0))[~over]
            at = (best[~over] & 0xFFFFFFFF) - shift
            symbols, merged, ranks = symbols[kept], merged[kept], ranks[kept]
            owner, lengths = owner[~over], lengths[~over]
            starts = np.cumsum(lengths) - lengths
            if not len(owner):
                break
        else:
            at = best & 0xFFFFFFFF
        symbols[at] = merged[at]
        ranks[at] = NONE
        last_now = at + 1 == starts + lengths - 1  # the pair was the end of its slice
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        at = at - np.arange(len(at))
        symbols, merged, ranks = symbols[keep], merged[keep], ranks[keep]
        lengths = lengths - 1
        has_next, has_last = at[~last_now], at[at > np.cumsum(lengths) - lengths] - 1
        ranks[has_next] = ranks_at(has_next)
        ranks[has_last] = ranks_at(has_last)
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owners, runs, counts = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(owners, kind="stable")
    begins = np.cumsum(counts) - counts
    return taken(runs, begins[order], counts[order]), counts[order]


class Encoder:
    """Encodes groups of texts; keeps the merged slices of earlier groups."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary, v = vocabulary, vocabulary
        tokens = slice_hashes(v.data, v.starts[v.ids], v.starts[v.ids] + v.lengths[v.ids])
        # A slice that is a token itself is never merged.
        self.memo = Memo(tokens, v.ids, v.data, v.starts[v.ids], v.starts[v.ids] + v.lengths[v.ids])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each text has."""
        starts = pretoken_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        hashes, first, which = distinct_slices(data, starts, ends)
        at, known = self.memo.places(hashes, data, starts[first], ends[first])
        begins, counts, pool = self.memo.starts[at], self.memo.lengths[at], self.memo.pool
        if len(new := np.flatnonzero(~known)):
            length = (ends - starts)[first[new]]
            symbols = self.vocabulary.byte_ids[taken(data, starts[first[new]], length)]
            runs, counts[new] = merge_slices(symbols, length, self.vocabulary.pairs)
            begins[new] = len(pool) + np.cumsum(counts[new]) - counts[new]
            pool = np.concatenate([pool, runs])
            self.memo.add(hashes[new], runs, counts[new], data, starts[first[new]], ends[first[new]])
        begins, counts = begins[which], counts[which]
        return taken(pool, begins, counts), run_sums(counts, np.searchsorted(starts, offsets))


def encoded_groups(
    batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, text: str
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each group of rows with the ids of its texts and where each text's ids begin."""
    encoder = Encoder(vocabulary)
    for group in groups(batches, text):
        ids, counts = encoder.encode(*bytes_of(group.column(text)))
        yield group, ids, np.concatenate([[0], np.cumsum(counts)])


def encode(
    docs: DataFrame,
    path: str,
    keys: Sequence[str] = ("doc_id",),
    text: str = "text",
    derive: Callable[[Vocabulary, np.ndarray, np.ndarray], dict[str, pa.Array]] | None = None,
    fields: str = "",
) -> DataFrame:
    """The ids of every text and the byte at which each token begins.

    Returns the key columns, ``ids`` and ``token_begins`` (arrays of int). With ``derive``, what it
    makes of a group's ids, as columns ``fields``, takes the place of the two arrays, so that digests
    or counts needn't carry them out of the task.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    rows = docs.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    out = T.StructType([*docs.select(*keys).schema, *T.StructType.fromDDL(
        fields if derive else "ids array<int>, token_begins array<int>"
    )])
    make = derive or _arrays

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, ids, offsets in encoded_groups(batches, vocabulary.value, "__text"):
            made = make(vocabulary.value, ids, offsets)
            yield pa.RecordBatch.from_arrays(
                [*(group.column(key) for key in keys), *made.values()], names=[*keys, *made]
            )

    return rows.mapInArrow(task, out)


def _arrays(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
    lengths = vocabulary.lengths[ids]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    begins = ends[:-1] - np.repeat(ends[offsets[:-1]], np.diff(offsets))
    at = pa.array(offsets, pa.int32())
    return {
        "ids": pa.ListArray.from_arrays(at, pa.array(ids, pa.int32())),
        "token_begins": pa.ListArray.from_arrays(at, pa.array(begins, pa.int32())),
    }


def decode(
    encoded: DataFrame, path: str, keys: Sequence[str] = ("doc_id",), ids: str = "ids"
) -> DataFrame:
    """The bytes that the ids stand for: the key columns and ``decoded`` (binary; null: empty)."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))
    none = F.array().cast("array<int>")
    rows = encoded.select(*keys, F.coalesce(F.col(ids), none).alias("__ids"))
    out = T.StructType([*encoded.select(*keys).schema, T.StructField("decoded", T.BinaryType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("__ids")
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            offsets = column.offsets.to_numpy().astype(np.int64)
            whole = decoded_texts(vocabulary.value, flat, offsets - offsets[0])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(key) for key in keys), pa.array(whole, pa.binary())],
                names=[*keys, "decoded"],
            )

    return rows.mapInArrow(task, out)


def decoded_texts(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    whole = vocabulary.bytes_of_ids(ids).tobytes()
    ends = np.concatenate([[0], np.cumsum(vocabulary.lengths[ids])])[offsets].tolist()
    return [whole[begin:end] for begin, end in zip(ends, ends[1:])]
