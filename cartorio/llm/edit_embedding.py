"""Fingerprints by randomised edit embedding (operator 4).

A text is read by a walk: step ``j`` puts out the character under the pointer and moves the pointer on
or leaves it, as a coin of ``j`` and the character says. All texts share the coins, so after an
insertion or deletion two walks soon run in step again, and edit distance becomes Hamming distance
between the outputs. Of the steps a shared sample is kept, the thinner the longer the text; thinner
samples are part of denser ones, so any two fingerprints compare. Bands of steps drawn from the whole
sample find candidates, the likeness of whole fingerprints verifies them.

Defined results: a null or empty text has the fingerprint of the empty text, which is fully like itself
and not at all like others; equal texts have equal fingerprints, whatever batch or task they are in;
whole texts are walked; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio.llm.components import components
from cartorio.llm.ngram_join import _forest, _judged_here, _pieces
from cartorio.llm.ragged import bytes_of, groups, mixed
from cartorio.sources.scratch import fresh_folder

#: Sampled steps of a text: from so many to twice as many, for texts that are long enough.
SAMPLE = 128
#: The walk looks up every so many steps whether a text has ended; its length counts in these.
STRIDE = 64
#: Bands of a level, and steps of a band.
BANDS, BAND_STEPS = 26, 8
#: Texts nearly alike are at most so many times as long as each other, as far as their walks tell.
STRETCH = 1.5
#: Fingerprints of a bucket that are compared in one piece.
BLOCK = 400
END = 64  # the code after the last character; its pointer stays
#: The letter of each code in a fingerprint, and of the end.
_LETTERS = np.append(np.arange(48, 48 + END), ord("-")).astype(np.uint8)
_ENDED = _LETTERS[END]


def _random(begin: int, n: int, salt: int) -> np.ndarray:
    return mixed(mixed(np.arange(begin, begin + n, dtype=np.uint64)) + np.uint64(salt))


@cache
def _coins(block: int) -> np.ndarray:
    """Move or stay, by step of the block and code; the code after the end stays."""
    words = _random(block * STRIDE, STRIDE, 1)
    coins = (words[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    return np.hstack([coins, np.zeros((STRIDE, 1), np.uint64)]).astype(np.uint8)


@cache
def _levels(block: int) -> np.ndarray:
    """Up to which level each step of the block is sampled: level l keeps one step in 2**l."""
    zeros = np.full(STRIDE, 64, np.int64)
    words = _random(block * STRIDE, STRIDE, 2)
    some = words > 0
    zeros[some] = 63 - np.floor(np.log2(words[some].astype(np.float64))).astype(np.int64)
    return np.maximum(zeros, 0)


_steps: dict[int, np.ndarray] = {}


def sampled_steps(level: int, blocks: int) -> np.ndarray:
    """The sampled steps of a level within so many blocks."""
    known, upto = _steps.get(level, np.zeros(0, np.int64)), _steps.get(~level, np.zeros(1, np.int64))[0]
    if upto < blocks:
        more = [b * STRIDE + np.flatnonzero(_levels(b) >= level) for b in range(int(upto), blocks)]
        known = np.concatenate([known, *more])
        _steps[level], _steps[~level] = known, np.array([blocks])
    return known[: np.searchsorted(known, blocks * STRIDE)]


def level_of(length: np.ndarray) -> np.ndarray:
    """A walk takes about two steps a character."""
    return np.floor(np.log2(np.maximum(2 * length / SAMPLE, 1))).astype(np.int64)


def codes_of(points: np.ndarray) -> np.ndarray:
    """Six bits of a hash of each codepoint."""
    return (mixed(points.astype(np.uint64) + np.uint64(0x51ED270B)) >> np.uint64(58)).astype(np.uint8)


@cache
def _all_codes() -> np.ndarray:
    return codes_of(np.arange(0x110000))


def codes_in(text: str) -> np.ndarray:
    return _all_codes().take(np.frombuffer(text.encode("utf-32-le"), np.uint32))


def walk(codes: np.ndarray, lengths: np.ndarray) -> list[str]:
    """Fingerprints of texts given as codes, each ended by ``END``; ``lengths`` without that."""
    n = len(lengths)
    order = np.argsort(-lengths, kind="stable")
    ends = np.cumsum(lengths + 1) - 1
    at, end = (ends - lengths)[order], ends[order]
    levels = level_of(lengths[order])
    ids, blocks = order, np.zeros(n, np.int64)
    kept_ids, kept_codes = [], []
    block = 0
    while len(at):
        coins, sampled = _coins(block), _levels(block)
        least = levels[-1]
        for step in range(STRIDE):
            here = codes.take(at)
            if sampled[step] >= least:
                first = np.searchsorted(-levels, -sampled[step])
                kept_ids.append(ids[first:])
                kept_codes.append(here[first:])
            at += coins[step].take(here)
        block += 1
        over = at == end
        if over.any():
            blocks[ids[over]] = block
            at, end, levels, ids = at[~over], end[~over], levels[~over], ids[~over]
    all_ids = np.concatenate([*kept_ids, np.zeros(0, np.int64)])
    symbols = np.concatenate([*kept_codes, np.zeros(0, np.uint8)])
    by_text = np.argsort(all_ids, kind="stable")
    whole = _LETTERS[symbols[by_text]].tobytes().decode("ascii")
    cuts = np.searchsorted(all_ids[by_text], np.arange(n + 1)).tolist()
    heads = zip(blocks.tolist(), level_of(lengths).tolist())
    return [f"{b:x}.{level:x}.{whole[x:y]}" for (b, level), x, y in zip(heads, cuts, cuts[1:])]


def _parts(fingerprint: str) -> tuple[int, int, np.ndarray]:
    blocks, level, symbols = fingerprint.split(".")
    return int(blocks, 16), int(level, 16), np.frombuffer(symbols.encode(), np.uint8)


def _at_level(blocks: int, level: int, symbols: np.ndarray, wanted: int, upto: int) -> np.ndarray:
    """The symbols at the steps of a thinner level, with ends up to so many blocks."""
    if (wanted, upto) == (level, blocks):
        return symbols
    out = np.full(len(sampled_steps(wanted, upto)), _ENDED, np.uint8)
    if wanted == level:
        out[: len(symbols)] = symbols
        return out
    own = sampled_steps(wanted, blocks)
    out[: len(own)] = symbols[np.searchsorted(sampled_steps(level, blocks), own)]
    return out


def likeness(one: str, other: str) -> float:
    """The part of the sampled steps, up to the end of the longer walk, that put out the same."""
    if one == other:
        return 1.0
    a, b = _parts(one), _parts(other)
    level, upto = max(a[1], b[1]), max(a[0], b[0])
    first, second = (_at_level(*x, level, upto) for x in (a, b))
    counted = (first != _ENDED) | (second != _ENDED)
    return float((first == second)[counted].mean()) if counted.any() else 0.0


@cache
def _drawn(level: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the first ``count`` sampled steps of a level those of each band, by place, and a number of each band.

    Every place of a band draws the step of smallest hash, so texts of other lengths draw the same
    step as often as it lies within both.
    """
    blocks = 1
    while len(sampled_steps(level, blocks)) < count:
        blocks *= 2
    steps = sampled_steps(level, blocks)[:count].astype(np.uint64)
    salts = _random(0, BANDS * BAND_STEPS, 3 + level)
    drawn = mixed(mixed(steps)[None, :] + salts[:, None]).argmin(1).reshape(BANDS, BAND_STEPS)
    numbers = mixed(np.arange(BANDS, dtype=np.uint64) + np.uint64(BANDS * level))
    for place in range(BAND_STEPS):
        numbers = mixed(numbers + steps[drawn[:, place]])
    return drawn, numbers


_FACTORS = _random(0, BAND_STEPS, 2**20) | np.uint64(1)


def placed_bands(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """The key of the band at each of ``2 * BANDS`` places, and whether there is one.

    Keys are hashes of the symbols at shared steps, of the text's level and, if a text nearly alike may
    be of the next level, of that. Bands of even levels come first, so a band that two texts share has
    the same place in both. The steps of a band are drawn independently from the whole walk: texts of
    likeness s share a band of a level with probability s**BAND_STEPS, some band (s = 0.8) with 0.992.
    """
    blocks, level, symbols = _parts(fingerprint)
    keys, there = np.zeros(2 * BANDS, np.int64), np.zeros(2 * BANDS, bool)
    inked = int((symbols != _ENDED).sum())  # about 2 * length / 2**level; ends come last
    for at in (level, level + 1):
        if at > level and inked * STRETCH < 2 * SAMPLE:
            continue
        read = _at_level(blocks, level, symbols, at, blocks)
        count = int((read != _ENDED).sum())
        if count:
            drawn, numbers = _drawn(at, count)
            found = (read[drawn].astype(np.uint64) * _FACTORS).sum(1, dtype=np.uint64) + numbers
        else:
            found = np.arange(BANDS, dtype=np.uint64) + np.uint64(BANDS * at)
        place = slice(BANDS * (at % 2), BANDS * (at % 2 + 1))
        keys[place], there[place] = mixed(found).view(np.int64), True
    return keys, there


def bands(fingerprint: str) -> list[int]:
    """The keys of the bands of a text."""
    keys, there = placed_bands(fingerprint)
    return keys[there].tolist()


def flat_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts the code of every codepoint, where each text's begin, and every first byte."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return _all_codes().take(points), np.searchsorted(at, offsets), np.append(at, len(data))


def ended(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of codes with an end after each."""
    out = np.full(int(lengths.sum()) + len(lengths), END, np.uint8)
    at = 0
    for start, length in zip(starts.tolist(), lengths.tolist()):  # a place for every code would take eight times as much
        out[at : at + length] = codes[start : start + length]
        at += length + 1
    return out


def fingerprinted(
    docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """The key columns, ``fingerprint`` and its ``bands`` (array of long)."""
    rows = docs.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    out = T.StructType([
        *docs.select(*keys).schema, T.StructField("fingerprint", T.StringType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "__text"):
            codes, starts, _ = flat_codes(*bytes_of(group.column("__text")))
            lengths = np.diff(starts)
            found = walk(ended(codes, starts[:-1], lengths), lengths)
            yield pa.RecordBatch.from_arrays(
                [*(group.column(key) for key in keys), pa.array(found, pa.string()),
                 pa.array([bands(f) for f in found], pa.list_(pa.int64()))], names=out.names,
            )

    return rows.mapInArrow(task, out)


def likeness_of(one: str | Column, other: str | Column) -> Column:
    """The likeness of two columns of fingerprints."""

    @F.pandas_udf("double")
    def compared(first, second):
        import pandas as pd

        return pd.Series([likeness(a, b) for a, b in zip(first, second)], dtype="float64")

    return compared(one, other)


def near_documents(
    docs: DataFrame, least: float = 0.8, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, ``fingerprint``, ``group_key``: the smallest key of the texts that are linked, and ``n_links``."""
    folder = fresh_folder(docs.sparkSession, "fingerprints")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    marked = written(fingerprinted(rows, ["key"], "text").drop("bands"), folder, "marked")
    found = linked(marked, least, folder)
    return marked.withColumn("class", class_of("fingerprint")).join(found, "class").select(
        "key", "fingerprint", "group_key", "n_links"
    )


def class_of(fingerprint: str) -> Column:
    return F.unhex(F.md5(fingerprint))


def linked(marked: DataFrame, least: float, folder: str, key: str = "key") -> DataFrame:
    """Of every ``class_of`` a fingerprint: ``group_key``, the smallest key of the texts linked to it, directly or by
    others, and ``n_links``, the number of other rows like it. ``marked`` is a written table.

    Equal fingerprints are compared once. All pairs of fingerprints that share a band are judged, in the
    first band they share and nowhere else; crowded buckets are cut into blocks, and every pair of
    blocks is a piece of work of its own. Tasks return counts and spanning forests, never pairs.
    """
    marks = written(
        marked.groupBy("fingerprint").agg(F.min(key).alias("key"), F.count("*").alias("copies"))
        .withColumn("id", F.xxhash64("fingerprint")), folder, "marks",
    )
    # Most buckets hold one text. They are told by a short part of their key, counted before the shuffle
    # as far as they meet in a task; what then is left (a few of two buckets among them) is looked at whole.
    entries = marks.select("id", "fingerprint").mapInArrow(_entries, "id bigint, bucket bigint")
    bits = min(62, max(32, int(2 * BANDS * marks.count()).bit_length() + 8))
    short = F.shiftright("bucket", 64 - bits).alias("short")
    many = entries.groupBy(short).agg(F.count("*").alias("held")).filter("held > 1").select("short")
    shared = written(
        entries.withColumn("short", short).join(many, "short", "left_semi").select("id", "bucket"), folder, "shared"
    )
    crowded = shared.groupBy("bucket").agg(F.count("*").alias("held")).filter("held > 1")
    blocks = F.ceil(F.col("held") / BLOCK)
    block = F.pmod("id", blocks).cast("int")
    members = shared.join(crowded, "bucket").select(
        "id", "bucket", block.alias("block"),
        F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))).alias("other"),
    ).withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other")
    members = members.join(marks.select("id", "fingerprint", "copies"), "id").drop("id")
    work = ("bucket", "low", "high")
    links = written(
        members.repartition(*work).sortWithinPartitions(*work).mapInArrow(
            lambda batches: _links(_with_bands(batches), least), "class binary, links bigint, other binary"
        ), folder, "links",
    )
    counted = links.filter("other is null").groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(links.filter("other is not null").select("class", "other"), "class", "other", folder)
    known = (
        marks.select(class_of("fingerprint").alias("class"), "key", "copies").join(counted, "class", "left")
        .join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    known = written(known, folder, "known")
    # Texts without a link are their own group. Written, so that adaptive execution may split large groups.
    heads = written(
        known.filter("links is not null").groupBy("root").agg(F.min("key").alias("group_key")), folder, "heads"
    )
    return known.join(heads, "root", "left").select(
        "class", F.coalesce("group_key", "key").alias("group_key"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each band of each fingerprint."""
    for batch in batches:
        found = [np.array(bands(mark), np.int64) for mark in batch.column("fingerprint").to_pylist()]
        if found:
            ids = np.repeat(batch.column("id").to_numpy(), [len(keys) for keys in found])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(found))], names=["id", "bucket"])


def _with_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members with all their bands (``trees``), the place of the one they share, and their class. That is
    worked out again here, which costs less than to shuffle it."""
    known: dict[str, tuple[np.ndarray, bytes]] = {}
    for batch in batches:
        trees, classes = [], []
        for mark in batch.column("fingerprint").to_pylist():
            if mark not in known:
                if len(known) > 10_000:
                    known.clear()
                keys, there = placed_bands(mark)
                name = hashlib.md5(mark.encode()).digest()
                alone = mixed(np.frombuffer(name, np.uint64)[0] + np.arange(len(keys), dtype=np.uint64))
                known[mark] = np.where(there, keys, alone.view(np.int64)), name  # no band: like no other's
            keys, name = known[mark]
            trees.append(keys)
            classes.append(name)
        if not trees:
            continue
        held = np.stack(trees)
        bucket = batch.column("bucket").to_numpy()
        tree = (held == bucket[:, None]).argmax(1)
        offsets = np.arange(len(held) + 1, dtype=np.int32) * held.shape[1]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("bucket", "low", "high", "block", "copies", "fingerprint")),
             pa.array(tree.astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(held.ravel())),
             pa.array(classes, pa.binary())],
            names=["bucket", "low", "high", "block", "copies", "fingerprint", "tree", "trees", "class"],
        )


def _links(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Of each piece how many rows each fingerprint is like (no other), and its forest (no links)."""
    for table in _pieces(batches, 4_000):
        marks, names = table["fingerprint"].to_pylist(), table["class"].to_pylist()
        copies = table["copies"].to_numpy()
        out: tuple[list[bytes], list[int], list[bytes | None]] = ([], [], [])
        for piece in _judged_here(table):
            rows = piece.rows.tolist()
            pairs = _alike([marks[row] for row in rows], piece.asked, least)
            if not len(pairs):
                continue
            links = np.zeros(len(rows), np.int64)
            np.add.at(links, pairs[:, 0], copies[piece.rows][pairs[:, 1]])
            np.add.at(links, pairs[:, 1], copies[piece.rows][pairs[:, 0]])
            for place in np.flatnonzero(links).tolist():
                out[0].append(names[rows[place]])
                out[1].append(int(links[place]))
                out[2].append(None)
            for place, root in _forest(pairs, len(rows)):
                out[0].append(names[rows[place]])
                out[1].append(0)
                out[2].append(names[rows[root]])
        if out[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())],
                names=["class", "links", "other"],
            )


def _alike(marks: list[str], asked: np.ndarray, least: float) -> np.ndarray:
    """The asked pairs whose likeness is enough, at the thinner level of the two as in ``likeness``."""
    if len(marks) == 2:
        return np.array([[0, 1]] if likeness(*marks) >= least else [], int).reshape(-1, 2)
    parts = [_parts(mark) for mark in marks]
    levels = np.array([level for _, level, _ in parts])
    upto = max(blocks for blocks, _, _ in parts)
    found = []
    for at in np.unique(levels).tolist():
        rows = np.flatnonzero(levels <= at)
        symbols = np.stack([_at_level(*parts[row], at, upto) for row in rows.tolist()])
        inked = symbols != _ENDED
        counts = inked.sum(1)  # ends come last
        for place, row in enumerate(rows.tolist()):
            others = np.flatnonzero(asked[row, rows] & (np.maximum(levels[row], levels[rows]) == at))
            if len(others):
                same = ((symbols[others] == symbols[place]) & inked[place]).sum(1)
                good = others[same / np.maximum(np.maximum(counts[others], counts[place]), 1) >= least]
                found.append(np.column_stack([np.full(len(good), row), rows[good]]))
    return np.concatenate([*found, np.zeros((0, 2), int)]).astype(int)
