"""Texts of an Arrow batch as flat arrays: slices of bytes, their hashes, and ragged gathers.

Nothing here knows Spark; the operators call it inside their tasks, one small group of rows at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once inside a task; one longer text is a group of its own.
GROUP_BYTES = 2 << 20

#: Two primes below 2**31 and a base for each; a slice is a polynomial modulo either. (Modulo a power of
#: two some long slices share their hash for every base.)
_MODULI = ((2**31 - 1, 1_103_515_247), (2**31 - 19, 1_664_525_039))
_powers = [np.ones(1, np.uint64) for _ in range(4)]
#: Bytes whose sums are taken at once: so many products of a byte and a power stay within 64 bits.
_STRETCH = 1 << 22


def groups(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = GROUP_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in runs of about ``limit`` bytes of ``column``."""
    for batch in batches:
        ends = np.cumsum(lengths_of(batch.column(column)))
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def lengths_of(array: pa.Array) -> np.ndarray:
    return np.diff(bytes_of(array)[1])


def bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each begins and the last ends.

    A null has no bytes.
    """
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) else b"")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def texts(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Text column of flat bytes."""
    return pa.Array.from_buffers(
        pa.large_string(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data.tobytes())],
    ).cast(pa.string())


def _powers_up_to(n: int) -> list[np.ndarray]:
    """Powers of each base and of its inverse."""
    while len(_powers[0]) < n:
        for which, (prime, base) in enumerate(_MODULI):
            for at, factor in ((2 * which, base), (2 * which + 1, pow(base, -1, prime))):
                old = _powers[at]
                step = np.uint64(pow(factor, len(old), prime))
                _powers[at] = np.concatenate([old, old * step % np.uint64(prime)])
    return [power[:n] for power in _powers]


def mixed(values: np.ndarray) -> np.ndarray:
    """64 well spread bits from 64 bits; different stays different."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(32)
    return values


def prefix_sums(data: np.ndarray) -> list[np.ndarray]:
    """For each modulus the polynomial of the bytes before every place; serves any slices of the data."""
    powers = _powers_up_to(len(data) + 1)
    values = data.astype(np.uint64) + np.uint64(1)
    out = []
    for which, (prime, _) in enumerate(_MODULI):
        modulus = np.uint64(prime)
        sums = np.zeros(len(data) + 1, np.uint64)
        for at in range(0, len(data), _STRETCH):
            part = values[at : at + _STRETCH]
            part = part * powers[2 * which][at : at + len(part)]
            sums[at + 1 : at + 1 + len(part)] = (sums[at] + np.cumsum(part)) % modulus
        out.append(sums)
    return out


def slice_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: list[np.ndarray] | None = None
) -> np.ndarray:
    """A 64-bit hash of the bytes of every slice; the same bytes hash alike in any batch and task.

    ``sums``: the data's ``prefix_sums``, if they are at hand.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers = _powers_up_to(len(data) + 1)
    out = np.zeros(len(starts), np.uint64)
    for which, ((prime, _), held) in enumerate(zip(_MODULI, sums or prefix_sums(data))):
        modulus = np.uint64(prime)
        found = (held[ends] + modulus - held[starts]) % modulus * powers[2 * which + 1][starts] % modulus
        out = out << np.uint64(32) | found
    return mixed(out + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def distinct_slices(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of slices the hash of each different one, one place of it, and which each slice is.

    Exact: slices are told apart by hash, and then their bytes are compared. Two of one hash are both
    given, under that hash.
    """
    hashes, first, which = np.unique(slice_hashes(data, starts, ends), return_index=True, return_inverse=True)
    other = np.flatnonzero(~same_slices(data, starts, ends, data, starts[first[which]], ends[first[which]]))
    if not len(other):
        return hashes, first, which
    more: dict[tuple[int, bytes], int] = {}
    added = []
    for at in other.tolist():
        key = int(which[at]), data[starts[at] : ends[at]].tobytes()
        if key not in more:
            more[key] = len(hashes) + len(added)
            added.append(at)
        which[at] = more[key]
    first = np.append(first, added)
    return slice_hashes(data, starts[first], ends[first]), first, which


def same_slices(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
    other: np.ndarray, other_starts: np.ndarray, other_ends: np.ndarray,
) -> np.ndarray:
    """Whether each slice holds the same bytes as its counterpart."""
    lengths = ends - starts
    same = lengths == other_ends - other_starts
    rows = np.flatnonzero(same & (lengths > 0) & ~((data is other) & (starts == other_starts)))
    if len(rows):
        run = lengths[rows]
        apart = taken(data, starts[rows], run) != taken(other, other_starts[rows], run)
        same[rows] = ~np.logical_or.reduceat(apart, np.cumsum(run) - run)
    return same


def within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... inside each run of the given length."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) - np.repeat(ends - lengths, lengths)


def taken(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``values[start : start + length]``, one after the other."""
    return values[np.repeat(starts, lengths) + within(lengths)]


def run_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each run between two offsets; 0 for empty runs."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]
