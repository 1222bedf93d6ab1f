"""Word shingles of whole texts, and their MinHash signatures, as flat arrays.

Words are runs of anything but ASCII white space in the lower-cased text. A text of fewer words than a
shingle has is one shingle; one without words has none.
"""

from __future__ import annotations

import numpy as np

from cartorio.llm.ragged import mixed, slice_hashes


def shingles_of(
    data: np.ndarray, offsets: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text, as 64-bit hashes in ascending order, and their bounds."""
    n = len(offsets) - 1
    ink = np.ones(len(data) + 2, bool)
    ink[[0, -1]] = False
    ink[1:-1] = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    opens = np.zeros(len(data) + 1, bool)
    opens[offsets] = True
    starts = np.flatnonzero(ink[1:-1] & (~ink[:-2] | opens[:-1]))
    ends = np.flatnonzero(ink[1:-1] & (~ink[2:] | opens[1:])) + 1
    words = slice_hashes(data, starts, ends)
    bounds = np.searchsorted(starts, offsets)
    counts = np.diff(bounds)

    few = (counts > 0) & (counts < width)
    made = np.maximum(counts - width + 1, 0) + few
    owner = np.repeat(np.arange(n), made)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(made) - made, made) + bounds[owner]
    length = np.where(few, counts, width)[owner]
    hashes = np.zeros(len(owner), np.uint64)
    padded = np.append(words, np.zeros(width, np.uint64))
    for place in range(width):
        there = place < length
        hashes = np.where(there, mixed(hashes + padded[first + place] + np.uint64(place + 1)), hashes)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.searchsorted(owner, np.arange(n + 1))


def _multipliers(n: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signatures(hashes: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """``n`` min-hashes of 32 bits of every set that isn't empty; zeros for the empty ones."""
    out = np.zeros((len(bounds) - 1, n), ">u4")
    filled = np.flatnonzero(np.diff(bounds))
    if len(filled):
        for place, factor in enumerate(_multipliers(n)):
            lowest = np.minimum.reduceat(hashes * factor, bounds[filled])
            out[filled, place] = (lowest >> np.uint64(32)).astype(np.uint32)
    return out


def set_keys(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """16 bytes that tell sets apart; the same set has the same ones. Empty sets: zeros."""
    out = np.zeros((len(bounds) - 1, 2), np.uint64)
    filled = np.flatnonzero(np.diff(bounds))
    if len(filled):
        out[filled, 0] = np.add.reduceat(mixed(hashes), bounds[filled])
        out[filled, 1] = np.add.reduceat(mixed(hashes * np.uint64(0xC2B2AE3D27D4EB4F)), bounds[filled])
    return out
