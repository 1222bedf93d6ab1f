"""Hard negatives by exact integer scores in a residue number system (operator 12).

Components are scaled to integers. Scores come from matrix products modulo several small primes: every
residue matrix is multiplied in float32, where sums of so few and so small products are exact, and the
signed score is put together from its residues by Chinese remaindering in mixed radix. How many primes
are needed follows from the longest vector (no score exceeds its squared length).

Anchors and rows meet on a grid: blocks of anchors by blocks of rows, every block pair a piece of work.
A piece holds its anchors and streams its rows in tiles, keeping only the best of each anchor, so a
task's memory depends on the block size alone. The first pass finds the positives of each anchor, the
second its negatives inside the window that each positive opens; both merge the pieces' bests by rank.

Defined results: rows with a null id, label or vector, or with a null or non-finite component take no
part; of several rows of one id the one of smallest (label, vector) does; a shorter vector counts as
ended by zeros; equal scores are ordered by id; an anchor without another row of its label, and a
positive whose window holds nothing, give no row; an empty table gives an empty table. Only the three
named columns are read. Scores beyond 60 bits don't fit the result and are refused by ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartorio.sources.scratch import fresh_folder

#: Components of one float32 product, and the bits up to which float32 counts exactly.
CHUNK, EXACT = 256, 24
#: Anchors and rows of a piece, and rows scored at once inside it.
BLOCK, TILE = 8192, 256
MOST_BITS = 60


@dataclass(frozen=True)
class MiningSettings:
    """The window in tenths of the positive's score: ``low * positive <= 10 * negative <= high * positive``."""

    scale: int = 256
    positives: int = 5
    negatives: int = 10
    low: int = 3
    high: int = 9
    block: int = BLOCK


# --- residues -------------------------------------------------------------------------------------


def primes_for(bound: float) -> list[int]:
    """The largest primes whose residues multiply exactly, as many as tell -bound from bound."""
    half = int(2 ** ((EXACT - np.log2(CHUNK)) / 2))
    found: list[int] = []
    product = 1
    for number in range(2 * half + 1, 2, -1):
        if product > 2 * bound + 1:
            break
        if all(number % divisor for divisor in range(2, int(number**0.5) + 1)):
            found.append(number)
            product *= number
    return found


def residues(whole: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Of integers (as doubles) the residues of smallest size, one matrix a prime."""
    out = []
    for prime in primes:
        rest = np.mod(whole, prime)  # exact: the rest of a division always fits
        out.append((rest - prime * (rest > prime // 2)).astype(np.float32))
    return out


def _centred(values: np.ndarray, prime: int) -> np.ndarray:
    rest = values % prime
    return rest - prime * (rest > prime // 2)


def exact_scores(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """All inner products of the rows of two integer matrices given by their residues."""
    width = min(left[0].shape[1], right[0].shape[1])
    value: np.ndarray | None = None
    radix = 1
    for prime, a, b in zip(primes, left, right):
        rest = np.zeros((len(a), len(b)), np.int64)
        for at in range(0, width, CHUNK):
            rest += (a[:, at : at + CHUNK] @ b[:, at : at + CHUNK].T).astype(np.int64)
        if value is None:
            value = _centred(rest, prime)
        else:
            digit = _centred(_centred(rest - value, prime) * pow(radix, -1, prime), prime)
            # The last product may run over 64 bits; the sum is the score and doesn't.
            value += digit * np.array(radix % (1 << 64), np.uint64).astype(np.int64)
        radix *= prime
    return value if value is not None else np.zeros((len(left), len(right)), np.int64)


# --- the best of each anchor ----------------------------------------------------------------------


class Best:
    """The ``k`` first of every slot by falling score and rising id, of all that was offered."""

    def __init__(self, slots: int, k: int) -> None:
        self.k = k
        self.least = np.full(slots, np.iinfo(np.int64).min)
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def offer(self, scores: np.ndarray, ids: np.ndarray, wanted: np.ndarray) -> None:
        lowest = np.iinfo(np.int64).min
        least = self.least
        if scores.shape[1] > self.k:
            open_ = np.where(wanted, scores, lowest)
            at = scores.shape[1] - self.k
            least = np.maximum(least, np.partition(open_, at, axis=1)[:, at])
        slot, column = np.nonzero(wanted & (scores >= least[:, None]))
        if not len(slot):
            return
        slot = np.concatenate([self.slot, slot])
        score = np.concatenate([self.score, scores[slot[len(self.slot) :], column]])
        id_ = np.concatenate([self.id, ids[column]])
        order = np.lexsort((id_, -score, slot))
        slot, score, id_ = slot[order], score[order], id_[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        kept = rank < self.k
        self.slot, self.score, self.id = slot[kept], score[kept], id_[kept]
        full = rank == self.k - 1
        self.least[slot[full]] = score[full]


def _matrix(column: pa.ListArray, scale: int) -> np.ndarray:
    """Scaled components as integers in doubles; short vectors end in zeros."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))))
    place = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], lengths)
    out[np.repeat(np.arange(len(lengths)), lengths), place] = np.floor(scale * flat)
    return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Rows sorted by piece and kind, cut where either changes; whether a new piece begins."""
    last = None
    for batch in batches:
        keys = np.column_stack([batch.column(c).to_numpy() for c in ("a", "r", "kind")])
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for begin, end in zip([0, *cuts], [*cuts, len(keys)]):
            if end > begin:
                piece = tuple(keys[begin, :2])
                yield piece != last, batch.slice(begin, end - begin)
                last = piece


_GRID = "a int, r int, kind int, vec_id bigint, label bigint, vector array<double>, wanted array<struct<id:bigint,score:bigint>>"
_POSITIVE = "anchor_id bigint, positive_id bigint, positive_score bigint"
_NEGATIVE = f"{_POSITIVE}, negative_id bigint, negative_score bigint"


def _judge(
    batches: Iterator[pa.RecordBatch], settings: MiningSettings, primes: list[int], negatives: bool
) -> Iterator[pa.RecordBatch]:
    waiting: list[pa.RecordBatch] = []
    piece: _Positives | _Negatives | None = None
    for fresh, rows in _pieces(batches):
        if fresh:
            if piece:
                yield piece.result()
            waiting, piece = [], None
        if rows.column("kind")[0].as_py() == 0:
            waiting.append(rows)
            continue
        if not waiting:  # rows without an anchor
            continue
        if piece is None:
            piece = (_Negatives if negatives else _Positives)(pa.Table.from_batches(waiting), settings, primes)
        for at in range(0, rows.num_rows, TILE):
            piece.offer(rows.slice(at, TILE))
    if piece:
        yield piece.result()


class _Piece:
    def __init__(self, anchors: pa.Table, settings: MiningSettings, primes: list[int]) -> None:
        self.settings, self.primes = settings, primes
        self.ids, self.labels = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
        self.left = residues(_matrix(anchors["vector"].combine_chunks(), settings.scale), primes)

    def _scored(self, rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        right = residues(_matrix(rows.column("vector"), self.settings.scale), self.primes)
        same = self.labels[:, None] == rows.column("label").to_numpy()
        return exact_scores(self.left, right, self.primes), rows.column("vec_id").to_numpy(), same


class _Positives(_Piece):
    def __init__(self, *given) -> None:
        super().__init__(*given)
        self.best = Best(len(self.ids), self.settings.positives)

    def offer(self, rows: pa.RecordBatch) -> None:
        scores, ids, same = self._scored(rows)
        self.best.offer(scores, ids, same & (self.ids[:, None] != ids))

    def result(self) -> pa.RecordBatch:
        best = self.best
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[best.slot]), pa.array(best.id), pa.array(best.score)],
            names=["anchor_id", "positive_id", "positive_score"],
        )


class _Negatives(_Piece):
    """One window for each positive of an anchor; those an anchor lacks are empty."""

    def __init__(self, anchors: pa.Table, *given) -> None:
        super().__init__(anchors, *given)
        wanted, k = anchors["wanted"].to_pylist(), self.settings.positives
        self.windows = []
        for place in range(k):
            there = [found[place] if place < len(found) else None for found in wanted]
            low, high = self.settings.low, self.settings.high
            self.windows.append((
                np.array([x["id"] if x else -1 for x in there], np.int64),
                np.array([x["score"] if x else 0 for x in there], np.int64),
                np.array([-(-low * x["score"] // 10) if x else 1 for x in there], np.int64),
                np.array([high * x["score"] // 10 if x else 0 for x in there], np.int64),
                Best(len(there), self.settings.negatives),
            ))

    def offer(self, rows: pa.RecordBatch) -> None:
        scores, ids, same = self._scored(rows)
        for _, _, least, most, best in self.windows:
            best.offer(scores, ids, ~same & (scores >= least[:, None]) & (scores <= most[:, None]))

    def result(self) -> pa.RecordBatch:
        columns = [
            (self.ids[best.slot], ids[best.slot], scores[best.slot], best.id, best.score)
            for ids, scores, _, _, best in self.windows
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in zip(*columns)],
            names=[field.split()[0] for field in _NEGATIVE.split(", ")],
        )


# --- the whole ------------------------------------------------------------------------------------


def usable(vectors: DataFrame, label: Column, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id``, ``label``, ``vector`` of the rows that take part, one an id."""
    finite = F.forall(vector, lambda x: F.abs(x) < F.lit(float("inf")))
    rows = vectors.filter(F.col(key).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.col(key).cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select(
        "vec_id", "row.label", "row.vector"
    )


def mined(rows: DataFrame, is_anchor: Column, settings: MiningSettings = MiningSettings()) -> DataFrame:
    """Hard negatives of the anchors among ``usable`` rows: ``anchor_id``, ``positive_id``, ``rank``,
    ``negative_id``, ``positive_score``, ``negative_score``."""
    folder = fresh_folder(rows.sparkSession, "negatives")
    rows = _written(rows, folder, "rows")
    # A scaled component is at most one larger than before it was rounded down.
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + (F.abs(settings.scale * x) + 1) ** 2)
    totals = rows.agg(
        F.count("*").alias("rows"), F.count_if(is_anchor).alias("anchors"), F.max(square).alias("bound")
    ).first()
    bound = totals.bound or 0.0
    if bound >= 2.0**MOST_BITS:
        raise ValueError(f"scores of up to {bound:.3g} don't fit a long with room to compare")
    primes = primes_for(bound * (1 + 1e-9))
    blocks = [max(1, -(-n // settings.block)) for n in (totals.anchors, totals.rows)]
    anchors = rows.filter(is_anchor)

    first = _on_grid(anchors.withColumn("wanted", F.lit(None)), rows, blocks).mapInArrow(
        lambda batches: _judge(batches, settings, primes, False), _POSITIVE
    )
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    positives = (
        first.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= settings.positives)
        .groupBy("anchor_id")
        .agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("wanted"))
    )
    asking = _written(
        anchors.join(positives, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id"), folder, "asking"
    )
    second = _on_grid(asking, rows, blocks).mapInArrow(
        lambda batches: _judge(batches, settings, primes, True), _NEGATIVE
    )
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (
        second.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= settings.negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def _on_grid(anchors: DataFrame, rows: DataFrame, blocks: list[int]) -> DataFrame:
    """Every anchor in each block of rows, every row in each block of anchors; anchors come first."""

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    whole = ("vec_id", "label", "vector")
    none = F.lit(None).cast("array<struct<id:bigint,score:bigint>>")
    left = anchors.select(
        block(blocks[0]).alias("a"), each(blocks[1]).alias("r"), F.lit(0).alias("kind"), *whole,
        F.coalesce("wanted", none).alias("wanted"),
    )
    right = rows.select(
        each(blocks[0]).alias("a"), block(blocks[1]).alias("r"), F.lit(1).alias("kind"), *whole,
        none.alias("wanted"),
    )
    return left.unionAll(right).repartition("a", "r").sortWithinPartitions("a", "r", "kind")


def _written(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")
