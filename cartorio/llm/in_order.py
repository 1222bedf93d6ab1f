"""Rows dealt into runs of neighbouring keys, without a sort of the whole table in one place.

A bounded sample of keys gives the limits of the runs; they decide only which rows share a task. Each
run gets its rows and, at its end, the first row of the run that follows (the last run that of the
first), so that whoever reads a run in order meets every row's successor. Texts travel compressed.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.llm.sampling import hash_sample

#: Bytes of text aimed at for a run, runs at most, and keys in the sample for each limit.
RUN_BYTES, RUNS, SAMPLED = 4 << 20, 20_000, 10

ORDER = ("none", "down", "mark")
DEALT = "run int, none boolean, down bigint, mark bigint, extra boolean, key bigint, packed binary"


def descending_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (``DEALT``) by descending key, null keys last, rows of one key by a hash of the text.

    Partitions hold whole runs, sorted by run and order; ``extra`` marks the row that only follows.
    """
    rows = docs.select(
        F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).select(
        F.col("key").isNull().alias("none"), F.coalesce(F.bitwise_not("key"), F.lit(0)).alias("down"),
        F.xxhash64("text").alias("mark"), "key", "text",
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    runs = int(min(max(total // RUN_BYTES, 1), RUNS))
    sample = hash_sample(rows.select(*ORDER), SAMPLED * runs, *ORDER).collect() if runs > 1 else []
    keys = sorted(tuple(row) for row in sample)
    limits = sorted({keys[len(keys) * at // runs] for at in range(1, runs)}) if keys else []

    def run_of(batch: pa.RecordBatch) -> list[int]:
        return [bisect_right(limits, row) for row in _orders(batch)]

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[bool, int, int]] = {}
        for batch in batches:
            for run, row in zip(run_of(batch), _orders(batch)):
                if run not in found or row < found[run]:
                    found[run] = row
        columns = zip(*((run, *row) for run, row in found.items())) if found else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.bool_(), pa.int64(), pa.int64()))],
            names=["run", *ORDER],
        )

    # One row a run: at most RUNS of them.
    heads = (
        rows.select(*ORDER).mapInArrow(least, "run int, none boolean, down bigint, mark bigint")
        .groupBy("run").agg(F.min(F.struct(*ORDER)).alias("head")).collect()
    )
    firsts = sorted((row.run, tuple(row.head)) for row in heads)
    follows = {head: firsts[at - 1][0] for at, (_, head) in enumerate(firsts)}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            runs_, extra, place = [], [], []
            for at, (run, row) in enumerate(zip(run_of(batch), _orders(batch))):
                for to, only in ((run, False), (follows.get(row), True)):
                    if to is not None:
                        runs_.append(to)
                        extra.append(only)
                        place.append(at)
            packed = pa.array([packer.compress(t.encode()) for t in batch.column("text").to_pylist()], pa.binary())
            take = pa.array(place, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(runs_, pa.int32()), *(batch.column(c).take(take) for c in ORDER),
                 pa.array(extra), batch.column("key").take(take), packed.take(take)],
                names=["run", *ORDER, "extra", "key", "packed"],
            )

    return rows.mapInArrow(dealt, DEALT).repartition("run").sortWithinPartitions("run", "extra", *ORDER)


def _orders(batch: pa.RecordBatch) -> Iterator[tuple[bool, int, int]]:
    return zip(*(batch.column(c).to_pylist() for c in ORDER))


def successors(
    batches: Iterator[pa.RecordBatch], limit: int
) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """Of consecutive rows their keys, and their texts with one more: the successor of the last row.

    At most about ``limit`` bytes of text come at once, and never rows of two runs.
    """
    unpacker = zstandard.ZstdDecompressor()
    keys: list[int | None] = []
    texts: list[bytes] = []
    size, done = 0, None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("run", "extra", "key", "packed"))
        for run, extra, key, packed in zip(*columns):
            if extra and run == done:  # a row that is there several times follows but once
                continue
            texts.append(unpacker.decompress(packed))
            size += len(texts[-1])
            if extra:
                yield keys, texts
                keys, texts, size, done = [], [], 0, run
                continue
            if size >= limit and keys:
                yield keys, texts
                keys, texts, size = [], texts[-1:], len(texts[-1])
            keys.append(key)
