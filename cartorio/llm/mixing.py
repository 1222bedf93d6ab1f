"""Mixing sources to target weights by balanced sampling (operator 5).

Every document is expected ``target / source_size`` times. The whole part is taken for sure; the rest is
an inclusion probability, rounded to 0 or 1 by the cube method: probabilities move along directions of
the constraints' null space, so that the sums of words and of documents stay as they are, until no
direction is left. A source's documents are dealt by hash into blocks of bounded size; a block leaves at
most two undecided documents, which meet again in later, ever smaller rounds. In a source's last round
a handful is landed together, so that its words miss the target least.

All chance comes from hashes of the row, so reruns agree, however the table is split.

Defined results: a null or empty text has size 0 and may be taken any number of its 0 words; a null
source is a source of its own, the last; repeated rows are documents each for itself; an empty table
gives an empty table. Only the named columns are read, whatever else the table holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio.sources.scratch import fresh_folder

# Fixed value: a word is a run of anything but the ASCII white space characters.
WORDS = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixSettings:
    """Weights go round over the sources in code point order; ``block`` bounds the rows of a group."""

    weights: tuple[float, ...] = (5, 2, 1)
    share: float = 1.0
    most: float = 3.0
    block: int = 4096
    seed: int = 0


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """Per ``source``: ``source_size``, ``documents`` and ``target``, one row a source.

    The target is ``level * weight`` or ``most`` times the source's size if that is less; the level at
    which the targets add up to the share of all words is the highest of those found by supposing that
    the sources stop in order of size per weight.
    """
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("documents")
    )
    # From here on a row is a source: the windows hold counts, never documents.
    order = W.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(settings.weights)
    weights = F.array(*(F.lit(float(w)) for w in settings.weights))
    limit = settings.most * F.col("source_size")
    stopped = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, from_here = stopped.rowsBetween(W.unboundedPreceding, -1), stopped.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy()
    level = (
        settings.share * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    ) / F.sum("weight").over(from_here)
    return (
        totals.withColumn("weight", F.element_at(weights, (place + 1).cast("int")))
        .withColumn("limit", limit).withColumn("level", level)
        .withColumn("target", F.least("limit", F.max("level").over(everything) * F.col("weight")))
        .select("source", "source_size", "documents", "target")
    )


def balance(
    chances: np.ndarray, sizes: np.ndarray, draws: np.ndarray, land: bool
) -> np.ndarray:
    """Rounds inclusion probabilities, in order, keeping their sums by document and by word.

    At most two stay undecided. To land, a few units are held back and rounded with them at the end, in
    the way that misses the sums least. ``draws`` holds two numbers in [0, 1) a unit.
    """
    out = chances.astype(float).copy()
    open_: list[int] = []
    tiny = 1e-9
    undecided = np.flatnonzero((out > 0) & (out < 1))
    held = undecided[np.argsort(draws[undecided, 1], kind="stable")[:LANDING]] if land else undecided[:0]

    def move(units: list[int], direction: list[float], draw: float) -> None:
        up = down = np.inf
        for unit, slope in zip(units, direction):
            if slope > 0:
                up, down = min(up, (1 - out[unit]) / slope), min(down, out[unit] / slope)
            elif slope < 0:
                up, down = min(up, out[unit] / -slope), min(down, (1 - out[unit]) / -slope)
        step = up if draw * (up + down) < down else -down
        for unit, slope in zip(units, direction):
            value = out[unit] + step * slope
            out[unit] = 0.0 if value < tiny else 1.0 if value > 1 - tiny else value

    for unit in undecided[~np.isin(undecided, held)].tolist():
        open_.append(unit)
        if len(open_) == 3:
            a, b, c = (float(sizes[u]) for u in open_)
            direction = [b - c, c - a, a - b]
            largest = max(map(abs, direction))
            # All of one size: two of them are moved against each other.
            move(open_, [d / largest for d in direction] if largest else [1, -1, 0], draws[unit, 0])
            open_ = [unit for unit in open_ if 0 < out[unit] < 1]
    if land:
        rest = np.concatenate([np.array(open_, int), held])
        out[rest] = _landed(out[rest], sizes[rest].astype(float))
    return out


#: So many units are held back for landing; with the two left over, 2**16 ways to round are tried.
LANDING = 14


def _landed(chances: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The rounding that keeps the sum of words best; the number of documents counts a twentieth."""
    ways = (np.arange(1 << len(chances))[:, None] >> np.arange(len(chances))) & 1
    words = np.abs(ways @ sizes - chances @ sizes)
    documents = np.abs(ways.sum(1) - chances.sum())
    weight = 0.05 * (sizes.mean() if len(sizes) else 0)
    return ways[np.argmin(words + weight * documents)].astype(float)


def _draws(marks: np.ndarray, seed: str) -> np.ndarray:
    """Two numbers in [0, 1) of every mark."""
    made = [hashlib.blake2b(b"%d %s" % (m, seed.encode()), digest_size=16).digest() for m in marks.tolist()]
    return np.frombuffer(b"".join(made), np.uint64).reshape(-1, 2).astype(float) / 2.0**64


def mixed(
    docs: DataFrame,
    settings: MixSettings = MixSettings(),
    keys: Sequence[str] = ("doc_id",),
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The key columns, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` of every row."""
    spark = docs.sparkSession
    names = [f"__key{place}" for place in range(len(keys))]
    mark = F.xxhash64(*(F.col(key) for key in keys), F.col(text), F.col(source))
    units = docs.select(
        *(F.col(key).alias(name) for key, name in zip(keys, names)),
        F.col(source).alias("source"), size_of(F.col(text)).alias("size"), mark.alias("mark"),
    )
    folder = fresh_folder(spark, "mix")
    units.write.parquet(f"{folder}/units")  # the texts are read once
    units = spark.read.schema(units.schema).parquet(f"{folder}/units")
    units = _told_apart(units, folder)
    source_targets(units, settings).write.parquet(f"{folder}/sources")
    sources = spark.read.parquet(f"{folder}/sources")

    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    hot = sources.withColumnRenamed("source", "__source")
    rows = units.join(hot, F.col("source").eqNullSafe(F.col("__source"))).select(
        *names, "size", "source_size", "target", "mark",
        # The place of a source among all is its group; nulls group like any other value.
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("group"),
        F.floor(expected).cast("bigint").alias("sure"),
        (expected - F.floor(expected)).alias("chance"),
        F.col("documents"),
    )
    most = sources.agg(F.max("documents")).first()[0] or 0
    rows, done, turn = rows.withColumn("blocks", F.ceil(F.col("documents") / settings.block)), [], 0
    while True:
        last = most <= settings.block
        salt = F.xxhash64("mark", F.lit(settings.seed), F.lit(turn))
        dealt = rows.withColumn("part", F.pmod(salt, F.greatest("blocks", F.lit(1))))
        path = f"{folder}/round{turn}"
        _rounded(dealt, settings, turn, last).write.parquet(path)
        table = spark.read.schema(dealt.schema).parquet(path)
        undecided = (F.col("chance") > 0) & (F.col("chance") < 1)
        done.append(table.filter(~undecided))
        if last:
            break
        # A block leaves at most two, so the number of blocks to come follows from the one before.
        most = 2 * -(-most // settings.block)
        rows = table.filter(undecided).drop("part").withColumn(
            "blocks", F.ceil(2 * F.col("blocks") / settings.block)
        )
        turn += 1
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    copies = F.col("sure") + F.col("chance").cast("bigint")
    return whole.select(
        *(F.col(name).alias(key) for key, name in zip(keys, names)), "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )


#: Rows alike in all that counts here, from which on they are told apart by a number.
ALIKE = 64


def _told_apart(units: DataFrame, folder: str) -> DataFrame:
    """Units of which many alike have marks of their own, so that they are dealt among blocks like others.

    They are counted and made again from their count, numbered: whichever of them has a number, what comes
    out is the same rows.
    """
    names = units.columns
    path = f"{folder}/alike"
    units.groupBy(*names).agg(F.count("*").alias("held")).filter(F.col("held") > ALIKE).write.parquet(path)
    alike = units.sparkSession.read.parquet(path)
    if alike.isEmpty():
        return units
    many = alike.select(*(F.col(f"`{name}`").alias(f"__{place}") for place, name in enumerate(names)))
    same = reduce(and_, (F.col(f"`{name}`").eqNullSafe(F.col(f"__{place}")) for place, name in enumerate(names)))
    portions = F.sequence(F.lit(0), F.floor((F.col("held") - 1) / 1000))
    made = (
        alike.withColumn("portion", F.explode(portions)).repartition("mark", "portion")
        .withColumn("number", F.explode(F.sequence(
            1000 * F.col("portion"), F.least(1000 * F.col("portion") + 999, F.col("held") - 1)
        ))).withColumn("mark", F.xxhash64("mark", "number")).select(*names)
    )
    path = f"{folder}/apart"
    units.join(many, same, "left_anti").unionByName(made).write.parquet(path)
    return units.sparkSession.read.schema(units.schema).parquet(path)


def _rounded(rows: DataFrame, settings: MixSettings, turn: int, last: bool) -> DataFrame:
    seed = f"{settings.seed} {turn}"

    def block(table: pa.Table) -> pa.Table:
        sizes, marks = table["size"].to_numpy(), table["mark"].to_numpy()
        chances = table["chance"].to_numpy()
        draws = _draws(marks, seed)
        # Large ones first: what stays undecided is small. Equal rows are as good as each other.
        order = np.lexsort((marks, draws[:, 0], -sizes))
        found = np.empty(len(chances))
        found[order] = balance(chances[order], sizes[order], draws[order], last)
        return table.set_column(
            table.schema.get_field_index("chance"), table.schema.field("chance"), pa.array(found)
        )

    return rows.groupBy("group", "part").applyInArrow(block, rows.schema)


def repeated(
    docs: DataFrame,
    settings: MixSettings = MixSettings(),
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as it is taken, with all its columns."""
    names = docs.columns
    marked = docs.select(
        F.xxhash64(*(F.col(f"`{name}`") for name in names)).alias("__mark"),
        F.struct(*(F.col(f"`{name}`") for name in names)).alias("__row"),
    )
    plain = marked.select("__mark", F.col(f"__row.{text}").alias("text"), F.col(f"__row.{source}").alias("source"))
    counts = mixed(plain, settings, ["__mark"]).groupBy("__mark").agg(
        F.sum("copies").alias("__copies"), F.count("*").alias("__rows")
    ).filter("__copies > 0")
    found = marked.join(counts, "__mark")
    single = found.filter("__rows = 1").select(
        "__row", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))).alias("__n")
    )
    # Rows that are alike throughout: one stands for all, repeated in portions of a thousand.
    alike = (
        found.filter("__rows > 1").dropDuplicates(["__mark"])
        .select("__mark", "__row", "__copies", F.explode(
            F.sequence(F.lit(0), ((F.col("__copies") - 1) / 1000).cast("bigint"))
        ).alias("__portion"))
        .repartition("__mark", "__portion")
        .select("__row", F.explode(F.sequence(
            F.lit(1), F.least(F.lit(1000), F.col("__copies") - 1000 * F.col("__portion")).cast("int")
        )).alias("__n"))
    )
    return single.unionByName(alike).select("__row.*")
