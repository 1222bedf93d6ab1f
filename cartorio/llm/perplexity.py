"""Perplexity of texts under a modified Kneser-Ney model of their own corpus (operator 13).

The model is over runs of four characters. Spark counts the runs; discounts, continuation counts, back-off
weights and interpolated probabilities are DataFrame expressions over the counts. A corpus is cut in two
folds by the hash of the text, and every text is scored by the model of the other fold: its own runs never
speak for it, nor do its exact copies.

The model is a table that grows with the corpus, so it is never broadcast. Texts are dealt into blocks;
each block asks for the runs it holds, once each, the runs are joined to the model, and what is found comes
back to the block as arrays sorted by the run's 64-bit hash, in which the block's texts are looked up.

A character is the lower 16 bits of its code point, ASCII letters folded, digits as one, white space as
one blank; characters beyond the basic plane share 4,096 places of the private area. Four of them make
the 64 bits of a run. Nulls before a text's first character mark its beginning.

Defined results: a null or empty text has no perplexity; whole texts are scored; equal texts score alike;
rows that are alike count and are scored each for itself; an empty table gives an empty table. A fold
without texts leaves its model empty: the other fold's texts then have a perplexity of 1 (log 0).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio.llm.ragged import bytes_of, groups

ORDER, BITS = 4, 16
FOLDS = 2
#: Bytes of text of a block, and distinct runs that a counting task holds before it passes them on.
BLOCK_BYTES, HELD = 32 << 20, 1 << 22
#: Rows alike in everything that are dealt as they are.
COPIES = 64
#: Discounts of runs seen once, twice, more often, where the counts of counts give none.
DISCOUNTS = (0.5, 1.0, 1.5)

_COUNTS = "fold int, gram bigint, n bigint"
_ASKED = "block bigint, fold int, size int, gram bigint"


def _low(size: int) -> int:
    return (1 << BITS * size) - 1


# --- runs of characters ---------------------------------------------------------------------------


def symbols_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all texts as 16-bit symbols, and where each text's begin."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
    bounds = np.searchsorted(at, offsets)
    points[points > 0xFFFF] = 0xE000 | points[points > 0xFFFF] & 0xFFF
    points[points == 0] = 0xFFFD
    points[(points >= ord("A")) & (points <= ord("Z"))] += 32
    points[(points >= ord("0")) & (points <= ord("9"))] = ord("0")
    blank = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D)) | (points == 0xA0)
    points[blank] = 0x20
    again = blank.copy()
    again[1:] &= blank[:-1]
    again[:1] = False
    again[bounds[:-1][bounds[:-1] < len(points)]] = False  # the first of a text stays
    kept = np.concatenate([[0], np.cumsum(~again)])
    return points[~again], kept[bounds]


def runs_of(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The run that ends at each character, as the bits of an int64; nulls stand before a text."""
    place = np.arange(len(symbols)) - np.repeat(bounds[:-1], np.diff(bounds))
    gram = symbols.copy()
    for back in range(1, ORDER):
        there = np.flatnonzero(place >= back)
        gram[there] |= symbols[there - back] << (BITS * back)
    return gram


def _folded(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    fold = batch.column("fold").to_numpy()
    for number in range(FOLDS):
        if (rows := np.flatnonzero(fold == number)).size:
            yield number, batch.take(pa.array(rows))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(FOLDS)]

    def merged(fold: int) -> tuple[np.ndarray, np.ndarray]:
        grams = np.concatenate([g for g, _ in held[fold]] or [np.zeros(0, np.int64)])
        counts = np.concatenate([n for _, n in held[fold]] or [np.zeros(0, np.int64)])
        order = np.argsort(grams, kind="stable")
        grams, counts = grams[order], counts[order]
        first = np.flatnonzero(np.diff(grams, prepend=grams[:1] - 1)) if len(grams) else np.zeros(0, int)
        return grams[first], np.add.reduceat(counts, first) if len(first) else counts

    def passed(fold: int) -> Iterator[pa.RecordBatch]:
        grams, counts = merged(fold)
        held[fold] = []
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(grams), fold, np.int32)), pa.array(grams), pa.array(counts)],
            names=["fold", "gram", "n"],
        )

    for group in groups(batches, "text"):
        for fold, rows in _folded(group):
            held[fold].append(np.unique(runs_of(*symbols_of(*bytes_of(rows.column("text")))), return_counts=True))
            if sum(len(g) for g, _ in held[fold]) > HELD:
                held[fold] = [merged(fold)]
                if len(held[fold][0][0]) > HELD // 2:
                    yield from passed(fold)
    for fold in range(FOLDS):
        yield from passed(fold)


def counts_of(docs: DataFrame) -> DataFrame:
    """How often each run is seen in each fold of ``fold``, ``text``."""
    return docs.select("fold", "text").mapInArrow(_counted, _COUNTS).groupBy("fold", "gram").agg(F.sum("n").alias("n"))


# --- the model ------------------------------------------------------------------------------------


def discounts_of(ones: int, twos: int, threes: int, fours: int) -> tuple[float, ...]:
    """The three discounts of modified Kneser-Ney from the numbers of runs seen once to four times."""
    found = list(DISCOUNTS)
    if ones and twos:
        share = ones / (ones + 2 * twos)
        for place, (low, high) in enumerate(((ones, twos), (twos, threes), (threes, fours))):
            if low and high:
                value = place + 1 - (place + 2) * share * high / low
                found[place] = value if 0 < value < place + 1 else DISCOUNTS[place]
    return tuple(found)


def model_of(counts: DataFrame, write: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``fold``, ``size``, ``gram``, ``logp`` (null: only a context) and ``back`` (the log of what a
    context leaves to shorter runs; null: nothing is known after it). Size 0 is any unknown character.

    ``write`` puts a table on disk and reads it back.
    """
    of_size = {ORDER: write(counts, "counts4")}
    for size in range(ORDER - 1, 0, -1):
        longer = of_size[size + 1]
        of_size[size] = write(
            longer.groupBy("fold", F.col("gram").bitwiseAND(_low(size)).alias("gram")).agg(F.count("*").alias("n")),
            f"counts{size}",
        )
    seen = reduce(DataFrame.unionAll, [
        table.groupBy("fold", F.lit(size).alias("size")).agg(*(
            F.count_if(F.col("n") == times).alias(f"n{times}") for times in range(1, 5)
        )) for size, table in of_size.items()
    ]).collect()  # a row a fold and size
    taken = {(row["fold"], row["size"]): discounts_of(*(row[f"n{t}"] for t in range(1, 5))) for row in seen}

    known = []
    lower: DataFrame | None = None
    for size in range(1, ORDER + 1):
        context = F.shiftright("gram", BITS).bitwiseAND(_low(size - 1))
        rows = of_size[size].withColumn("context", context if size > 1 else F.lit(0).cast("bigint"))
        cut = _by_fold(lambda fold: [
            F.lit(x) for x in taken.get((fold, size), DISCOUNTS)
        ], lambda levels: F.element_at(F.array(*levels), F.least("n", F.lit(3)).cast("int")))
        # A context is followed by at most as many characters as there are.
        same = Window.partitionBy("fold", "context")
        rows = rows.withColumn("cut", cut).withColumns({
            "all": F.sum("n").over(same), "left": F.sum("cut").over(same), "next": F.count("*").over(same),
        })
        share = F.col("left") / F.col("all")
        own = (F.col("n") - F.col("cut")) / F.col("all")
        after = rows.groupBy("fold", F.col("context").alias("gram")).agg(F.log(F.first(share)).alias("back"))
        if size == 1:
            made = rows.select("fold", "gram", (own + share / (F.col("next") + 1)).alias("p"))
            rest = rows.groupBy("fold").agg(F.first(share / (F.col("next") + 1)).alias("p")).select(
                "fold", F.lit(0).alias("size"), F.lit(0).cast("bigint").alias("gram"),
                F.log("p").cast("float").alias("logp"), F.lit(None).cast("float").alias("back"),
            )
            known.append(rest)
        else:
            shorter = lower.select("fold", F.col("gram").alias("tail"), F.col("p").alias("lower"))
            made = rows.withColumn("tail", F.col("gram").bitwiseAND(_low(size - 1))).join(
                shorter, ["fold", "tail"]
            ).select("fold", "gram", (own + share * F.col("lower")).alias("p"))
            contexts = write(after, f"back{size}")
            known[-1] = _with_back(lower, contexts, size - 1)
        lower = write(made, f"known{size}")
        known.append(_with_back(lower, None, size))
    return reduce(DataFrame.unionAll, known)


def _by_fold(values: Callable[[int], list[Column]], pick: Callable[[list[Column]], Column]) -> Column:
    column = pick(values(0))
    for fold in range(1, FOLDS):
        column = F.when(F.col("fold") == fold, pick(values(fold))).otherwise(column)
    return column


def _with_back(known: DataFrame, contexts: DataFrame | None, size: int) -> DataFrame:
    rows = known.join(contexts, ["fold", "gram"], "full") if contexts else known.withColumn("back", F.lit(None))
    return rows.select(
        "fold", F.lit(size).alias("size"), "gram", F.log("p").cast("float").alias("logp"),
        F.col("back").cast("float").alias("back"),
    )


# --- blocks ---------------------------------------------------------------------------------------


def blocked(
    docs: DataFrame, text: str, columns: Sequence[str], write: Callable[[DataFrame, str], DataFrame],
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``columns``, ``text`` (never null), ``fold``, ``block`` and ``copies``, dealt so that a task holds
    whole blocks.

    A block is a hash of the whole row, so rows alike in everything would crowd one: of those that are
    there more than ``COPIES`` times one stands for all.
    """
    rows = docs.select(*columns, F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = rows.withColumns({"mark": F.xxhash64(*columns, "text"), "copies": F.lit(1).cast("bigint")})
    alike = write(
        rows.groupBy("mark").agg(F.count("*").alias("held")).filter(F.col("held") > COPIES).select("mark"), "alike"
    )
    if not alike.isEmpty():
        many = rows.join(alike, "mark", "left_semi").groupBy("mark", *columns, "text").agg(F.sum("copies").alias("copies"))
        rows = rows.join(alike, "mark", "left_anti").unionByName(many)
    return rows.select(
        *columns, "text", "copies", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold"),
        F.pmod("mark", F.lit(max(1, -(-total // block_bytes)))).alias("block"),
    ).repartition("block")


def _asked(table: pa.Table) -> pa.Table:
    """What the texts of a block look up in the other fold's model."""
    block = table.column("block")[0].as_py()
    found: list[list[np.ndarray]] = [[] for _ in range(FOLDS)]
    for group in groups(table.select(["fold", "text"]).to_batches(), "text"):
        for fold, rows in _folded(group):
            found[fold].append(np.unique(runs_of(*symbols_of(*bytes_of(rows.column("text"))))))
    folds, sizes, grams = [], [], []
    for fold, parts in enumerate(found):
        if not parts:
            continue
        whole = np.unique(np.concatenate(parts))
        for size in range(ORDER, -1, -1):
            ends = np.unique(whole & np.int64(_low(size))) if size < ORDER else whole
            if 0 < size < ORDER:  # and the contexts that begin a text
                ends = np.unique(np.append(ends, 0))
            folds.append(np.full(len(ends), (fold + 1) % FOLDS, np.int32))
            sizes.append(np.full(len(ends), size, np.int32))
            grams.append(ends)
    columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (folds, sizes, grams)]
    return pa.table({
        "block": pa.array(np.full(len(columns[2]), block, np.int64)), "fold": pa.array(columns[0], pa.int32()),
        "size": pa.array(columns[1], pa.int32()), "gram": pa.array(columns[2], pa.int64()),
    })


class Shelf:
    """What a block knows of one fold's model: for each length the runs in order, and their values."""

    def __init__(self, table: pa.Table, fold: int) -> None:
        sizes, folds = table["size"].to_numpy(), table["fold"].to_numpy()
        self.grams, self.logp, self.back = {}, {}, {}
        for size in range(ORDER + 1):
            rows = np.flatnonzero((sizes == size) & (folds == fold))
            grams = table["gram"].to_numpy()[rows]
            order = np.argsort(grams)
            self.grams[size] = grams[order]
            self.logp[size] = table["logp"].to_numpy()[rows][order].astype(np.float64)
            self.back[size] = np.nan_to_num(table["back"].to_numpy()[rows][order].astype(np.float64))

    def _find(self, size: int, grams: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The values of runs; not a number where there is none."""
        held = self.grams[size]
        at = np.searchsorted(held, grams)
        there = at < len(held)
        there[there] = held[at[there]] == grams[there]
        out = np.full(len(grams), np.nan)
        out[there] = values[at[there]]
        return out

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        """Of the last character of each run of full length, after those before it."""
        out = self._find(ORDER, grams, self.logp[ORDER])
        open_ = np.flatnonzero(np.isnan(out))
        owed = np.zeros(len(open_))
        for size in range(ORDER - 1, -1, -1):
            if not len(open_):
                break
            if size:
                # The context of a longer run; a signed shift would draw the sign in.
                context = (grams[open_] >> BITS) & _low(size)
                owed += np.nan_to_num(self._find(size, context, self.back[size]))
            found = self._find(size, grams[open_] & np.int64(_low(size)), self.logp[size])
            if size == 0:
                found = np.nan_to_num(found)
            there = ~np.isnan(found)
            out[open_[there]] = owed[there] + found[there]
            open_, owed = open_[~there], owed[~there]
        return out


def log_perplexities(data: np.ndarray, offsets: np.ndarray, shelf: Shelf) -> tuple[np.ndarray, np.ndarray]:
    """The mean of -log p over the characters of each text (not a number for texts without any), and how
    many those are."""
    symbols, bounds = symbols_of(data, offsets)
    out = np.full(len(bounds) - 1, np.nan)
    filled = np.flatnonzero(np.diff(bounds))
    if len(filled):
        grams, which = np.unique(runs_of(symbols, bounds), return_inverse=True)
        each = -shelf.log_probabilities(grams)[which]
        out[filled] = np.add.reduceat(each, bounds[filled]) / np.diff(bounds)[filled]
    return out, np.diff(bounds)


Figures = Callable[[np.ndarray, np.ndarray], dict[str, np.ndarray]]


def scored(
    docs: DataFrame, keys: Sequence[str], write: Callable[[DataFrame, str], DataFrame], text: str = "text",
    figures: Figures | None = None, fields: str = "", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The key columns, ``log_perplexity``, ``n_scored`` (characters) and what ``figures`` makes of the bytes and bounds of a group
    of texts (arrays for the columns ``fields``). Extra columns aren't read."""
    # Keys travel under names of their own, which no column of the plan can clash with.
    named = docs.select(*(F.col(key).alias(f"key{i}") for i, key in enumerate(keys)), F.col(text).alias("words"))
    inner = [f"key{i}" for i in range(len(keys))]
    rows = blocked(named, "words", inner, write, block_bytes)
    model = model_of(counts_of(rows_of(named)), write)
    model = write(model, "model")
    asked = rows.groupBy("block").applyInArrow(_asked, _ASKED)
    answers = asked.join(model, ["fold", "size", "gram"]).select("block", "fold", "size", "gram", "logp", "back")
    out = T.StructType([
        *named.select(*inner).schema, T.StructField("copies", T.LongType()),
        T.StructField("log_perplexity", T.DoubleType()), T.StructField("n_scored", T.LongType()), *(T.StructType.fromDDL(fields) if fields else []),
    ])

    def judged(texts: pa.Table, shelves: pa.Table) -> pa.Table:
        known = [Shelf(shelves, (fold + 1) % FOLDS) for fold in range(FOLDS)]
        made = []
        for group in groups(texts.select([*inner, "copies", "fold", "text"]).to_batches(), "text"):
            for fold, part in _folded(group):
                data, offsets = bytes_of(part.column("text"))
                found, many = log_perplexities(data, offsets, known[fold])
                more = figures(data, offsets) if figures else {}
                made.append(pa.RecordBatch.from_arrays(
                    [*(part.column(key) for key in (*inner, "copies")), pa.array(found, mask=np.isnan(found)), pa.array(many),
                     *(pa.array(column) for column in more.values())],
                    names=[*inner, "copies", "log_perplexity", "n_scored", *more],
                ))
        return pa.Table.from_batches(made)

    found = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(judged, out)
    rest = [name for name in out.names if name not in (*inner, "copies")]
    return found.select(
        *(F.col(mine).alias(key) for mine, key in zip(inner, keys)), *rest,
        F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def rows_of(named: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("words"), F.lit(""))
    return named.select(F.pmod(F.xxhash64(text), F.lit(FOLDS)).cast("int").alias("fold"), text.alias("text"))


# --- quartiles ------------------------------------------------------------------------------------


def quartiles(rows: DataFrame, value: str, by: str, steps: int = 1000) -> DataFrame:
    """``by``, ``q1``, ``q2``, ``q3``: the quartiles of a value in each group, null a group like others.
    They are read off counts of steps of 1/``steps``, so they are the same however the rows lie."""
    counts = rows.filter(F.col(value).isNotNull()).groupBy(by, F.floor(F.col(value) * steps).alias("step")).agg(
        F.count("*").alias("n")
    )
    up = Window.partitionBy(by).orderBy("step")
    counts = counts.withColumns({"upto": F.sum("n").over(up), "all": F.sum("n").over(Window.partitionBy(by))})
    return counts.groupBy(by).agg(*(
        ((F.min(F.when(4 * F.col("upto") >= quarter * F.col("all"), F.col("step"))) + 0.5) / steps).alias(f"q{quarter}")
        for quarter in (1, 2, 3)
    ))
