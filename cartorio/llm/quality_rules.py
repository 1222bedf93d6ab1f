"""Quality rules: plain figures of each text, and bands of perplexity by language (operator 13).

A text fails at once if it is short or mostly made of words in runs that it repeats; of the others those
are kept whose log perplexity (``perplexity``) departs from the median of their language no further up or
down than the language's band. The shorter a text, the more its perplexity varies by chance, so a
departure counts in full only for long ones. A null language is a language of its own. A text with a null language, a null id or rows alike are judged like any other.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.llm.perplexity import BLOCK_BYTES, quartiles, scored
from cartorio.llm.ragged import mixed, prefix_sums, run_sums, slice_hashes
from cartorio.sources.scratch import fresh_folder

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
FIGURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


@dataclass(frozen=True)
class QualitySettings:
    """``reach``: quartile distances that a departure may lie outside its language's quartiles; ``least``:
    the smallest such distance, in units of log perplexity; ``steady``: a text of so many characters counts
    with the root of a half of its departure."""

    words: int = 20
    repeated_percent: int = 30
    reach: float = 3.0
    least: float = 0.01
    steady: int = 1000
    block_bytes: int = BLOCK_BYTES


def _again(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of items by owner and hash: whether an earlier one is alike, and whether a later one is."""
    order = np.lexsort((np.arange(len(hashes)), hashes, owner))
    same = (np.diff(owner[order]) == 0) & (hashes[order][1:] == hashes[order][:-1])
    earlier, later = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    earlier[order[1:]] = same
    later[order[:-1]] = same
    return earlier, later


def figures(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The figures of every text, from the bytes of all."""
    n = len(offsets) - 1
    ink = np.zeros(len(data) + 2, bool)
    ink[1:-1] = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    opens = np.zeros(len(data) + 1, bool)
    opens[offsets] = True
    starts = np.flatnonzero(ink[1:-1] & (~ink[:-2] | opens[:-1]))
    ends = np.flatnonzero(ink[1:-1] & (~ink[2:] | opens[1:])) + 1
    bounds = np.searchsorted(starts, offsets)

    # Lines: cut after every line feed and where a text begins.
    feeds = np.flatnonzero(data == 0x0A)
    line_starts = np.sort(np.concatenate([offsets[:-1], feeds + 1]))
    line_owner = np.searchsorted(offsets, line_starts, side="right") - 1
    line_ends = np.concatenate([line_starts[1:], [len(data)]]) if len(line_starts) else line_starts
    line_ends = line_ends - (np.append(data, 0)[line_ends - 1] == 0x0A)
    inked = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    inked &= line_ends > line_starts
    line_starts, line_ends, line_owner = line_starts[inked], line_ends[inked], line_owner[inked]
    sums = prefix_sums(data)
    earlier, _ = _again(line_owner, slice_hashes(data, line_starts, line_ends, sums))

    # Words that lie in a run of so many words which the text holds again.
    words = slice_hashes(data, starts, ends, sums)
    made = np.maximum(np.diff(bounds) - WINDOW + 1, 0)
    owner = np.repeat(np.arange(n), made)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(made) - made, made) + bounds[owner]
    hashes = np.zeros(len(owner), np.uint64)
    for place in range(WINDOW):
        hashes = mixed(hashes + words[first + place] + np.uint64(place + 1))
    before, after = _again(owner, hashes)
    cover = np.zeros(len(words) + WINDOW + 1, np.int64)
    found = first[before | after]
    np.add.at(cover, found, 1)
    np.add.at(cover, found + WINDOW, -1)
    covered = np.cumsum(cover)[: len(words)] > 0
    return {
        "n_words": np.diff(bounds),
        "word_chars": run_sums(ink[1:-1] & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": run_sums(np.isin(data, np.frombuffer(SYMBOLS, np.uint8)), offsets),
        "n_dup_lines": np.bincount(line_owner[earlier], minlength=n).astype(np.int64),
        "n_repeat_words": run_sums(covered, bounds),
    }


def judged(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    settings: QualitySettings = QualitySettings(),
) -> DataFrame:
    """``key``, the figures, ``base_failed``, ``kept``, ``log_perplexity``, and the band it was held to."""
    folder = fresh_folder(docs.sparkSession, "quality")

    def write(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    named = docs.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    failed = (F.col("n_words") < settings.words) | (
        100 * F.col("n_repeat_words") > settings.repeated_percent * F.col("n_words")
    )
    found = write(
        scored(named, ["key", "lang"], write, figures=figures, fields=FIGURES, block_bytes=settings.block_bytes)
        .withColumn("base_failed", failed), "scored",
    )
    plain = found.filter("not base_failed")
    middle = write(quartiles(plain, "log_perplexity", "lang").select(F.col("lang").alias("of"), "q2"), "medians")
    weight = F.sqrt(F.col("n_scored") / (F.col("n_scored") + settings.steady))
    found = found.join(middle, F.col("lang").eqNullSafe(F.col("of")), "left").withColumn(
        "departure", (F.col("log_perplexity") - F.col("q2")) * weight
    ).drop("of", "q2")
    spread = quartiles(found.filter("not base_failed"), "departure", "lang")
    room = settings.reach * F.greatest(F.col("q3") - F.col("q1"), F.lit(settings.least))
    bands = write(
        spread.select(F.col("lang").alias("of"), (F.col("q1") - room).alias("low"), (F.col("q3") + room).alias("high")), "bands"
    )
    within = F.col("departure").between(F.col("low"), F.col("high"))
    return found.join(bands, F.col("lang").eqNullSafe(F.col("of")), "left").select(
        F.col("key").alias(key), *(field.split()[0] for field in FIGURES.split(", ")), "base_failed",
        (~F.col("base_failed") & F.coalesce(within, F.lit(False))).alias("kept"),
        "log_perplexity", "departure", "low", "high",
    )
