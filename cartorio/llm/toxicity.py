"""Toxicity by a chain of linear classifiers (operator 9).

The categories are predicted in order. Each one's logistic regression sees which of the selected words
and word beginnings (stems with any ending) a text holds, and the probabilities of the categories before
it; in training those are out-of-fold predictions, made by models that haven't seen the text or a copy of
it. Words are selected by their association with a category (likelihood ratio), so that a long text isn't
condemned by chance words.

Training uses at most ``sample`` labelled documents (those of smallest hash of the id: the same ones in
any run); that bounds the one task that fits the models and what is broadcast. Scoring reads all texts.

Defined results: a null or empty text holds no word and gets the base rates; a label row with a null
category isn't learned from; of a repeated label the highest counts, of repeated documents one is
learned from and each is scored; without labels, or with one class only, the probability is the base
rate (0 without labels); an empty table gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio.llm.pretokens import LETTER, codepoints
from cartorio.llm.ragged import bytes_of, groups, prefix_sums, slice_hashes
from cartorio.llm.sampling import hash_sample


@dataclass(frozen=True)
class ChainSettings:
    """``sample`` bounds the labelled documents; ``words`` the selected words of a category."""

    sample: int = 10_000
    words: int = 160
    association: float = 15.0
    folds: int = 5
    ridge: float = 0.1
    threshold: float = 0.5


@dataclass(frozen=True)
class Link:
    """One category's model: base log-odds, weights of words and of earlier probabilities."""

    base: float
    words: np.ndarray
    earlier: np.ndarray


@dataclass(frozen=True)
class Chain:
    """``keys``: the hashes of all selected words, sorted."""

    keys: np.ndarray
    links: tuple[Link, ...]

    def probabilities(self, texts: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        """For ``n`` texts of which text ``texts[i]`` holds selected word ``words[i]``, once each."""
        out = np.zeros((n, len(self.links)))
        for place, link in enumerate(self.links):
            odds = np.full(n, link.base) + out[:, :place] @ link.earlier
            np.add.at(odds, texts, link.words[words])
            out[:, place] = _logistic(odds)
        return out


def _logistic(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


#: Letters of the word beginnings that are features beside whole words.
STEMS = (4, 5, 6)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word (run of letters) and word beginning of all texts, and the text it is in."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at, _, kinds, opens = codepoints(data, offsets)
    letter = np.concatenate([[False], kinds == LETTER, [False]])
    joined = np.concatenate([[False], ~opens[1:-1], [False]])  # to the codepoint before
    first = np.flatnonzero(letter[1:-1] & ~(letter[:-2] & joined[:-1]))
    last = np.flatnonzero(letter[1:-1] & ~(letter[2:] & joined[1:])) + 1
    at = np.append(at, len(data))
    text = np.searchsorted(offsets, at[first], side="right") - 1
    sums = prefix_sums(data)
    found = [(slice_hashes(data, at[first], at[last], sums), text)]
    for letters in STEMS:
        longer = last - first > letters
        begin = first[longer]
        found.append((slice_hashes(data, at[begin], at[begin + letters], sums), text[longer]))
    hashes, owner = (np.concatenate(part) for part in zip(*found))
    return hashes, owner


def _distinct(texts: np.ndarray, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique(texts * n + words)
    return keys // n, keys % n


def association(held: np.ndarray, in_positive: np.ndarray, positive: int, n: int) -> np.ndarray:
    """Likelihood ratio statistic of a word against a category: ``held`` of ``n`` texts hold it,
    ``in_positive`` of the ``positive`` ones."""

    def part(seen: np.ndarray, rows: np.ndarray, columns: float) -> np.ndarray:
        expected = rows * columns / n
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)

    negative, absent = n - positive, n - held
    return 2 * (
        part(in_positive, held, positive) + part(held - in_positive, held, negative)
        + part(positive - in_positive, absent, positive)
        + part(negative - (held - in_positive), absent, negative)
    )


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Base and weights of a ridge logistic regression, by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    weights = np.zeros(x.shape[1])
    weights[0] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    for _ in range(30):
        p = _logistic(x @ weights)
        slope = x.T @ (p - y) + penalty * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        weights -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return weights


def fit_chain(
    words: list[np.ndarray], marks: np.ndarray, folds: np.ndarray, settings: ChainSettings
) -> Chain:
    """``words``: the distinct word hashes of each text; ``marks``: 0 or 1 by text and category."""
    n, categories = marks.shape
    if not n or not any(len(w) for w in words):
        none = Link(-50.0, np.zeros(0), np.zeros(0))
        links = [Link(none.base, none.words, np.zeros(place)) for place in range(categories)]
        return Chain(np.zeros(0, np.uint64), tuple(links))
    texts = np.repeat(np.arange(n), [len(w) for w in words])
    every, which = np.unique(np.concatenate(words), return_inverse=True)

    def selected(rows: np.ndarray) -> np.ndarray:
        """The words that some of the texts tell to be tied to a category."""
        some = rows[texts]
        held = np.bincount(which[some], minlength=len(every))
        out = np.zeros(len(every), bool)
        for mark in marks.T:
            there = np.bincount(which[some], weights=mark[texts[some]], minlength=len(every))
            strength = association(held, there, int(mark[rows].sum()), int(rows.sum()))
            strongest = np.argsort(-strength, kind="stable")[: settings.words]
            out[strongest[strength[strongest] >= settings.association]] = True
        return out

    def features_of(words: np.ndarray) -> np.ndarray:
        x = np.zeros((n, int(words.sum())))
        chosen = words[which]
        x[texts[chosen], (np.cumsum(words) - 1)[which[chosen]]] = 1
        return x

    kept = selected(np.ones(n, bool))
    x = features_of(kept)
    links, earlier = [], np.zeros((n, 0))
    for mark in marks.T:
        features = np.hstack([x, earlier])
        weights = fit_logistic(features, mark, settings.ridge)
        links.append(Link(weights[0], weights[1 : 1 + x.shape[1]], weights[1 + x.shape[1] :]))
        earlier = np.hstack([earlier, _unseen(mark, folds, selected, features_of, earlier, settings)[:, None]])
    return Chain(every[kept], tuple(links))


def _unseen(
    mark: np.ndarray, folds: np.ndarray, selected: Callable[[np.ndarray], np.ndarray],
    features_of: Callable[[np.ndarray], np.ndarray], earlier: np.ndarray, settings: ChainSettings,
) -> np.ndarray:
    """What is predicted of each fold by the others, which also choose the words it is predicted from."""
    out = np.zeros(len(mark))
    for fold in np.unique(folds):
        held = folds == fold
        if held.all():  # one fold only: nothing is left to learn from
            out[held] = mark.mean()
            continue
        features = np.hstack([features_of(selected(~held)), earlier])
        part = fit_logistic(features[~held], mark[~held], settings.ridge)
        out[held] = _logistic(part[0] + features[held] @ part[1:])
    return out


def _lowered(text: str) -> Column:
    return F.lower(F.coalesce(F.col(text), F.lit(""))).alias("__text")


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    settings: ChainSettings = ChainSettings(),
    key: str = "doc_id",
    text: str = "text",
) -> Chain:
    """The chain for the label columns ``categories`` (0 or 1), in that order."""
    marks = [f"__mark{place}" for place in range(len(categories))]
    known = hash_sample(
        labels.select(F.col(key).alias("__key"), *(F.col(c).cast("int").alias(m) for c, m in zip(categories, marks)))
        .dropna().groupBy("__key").agg(*(F.max(m).alias(m) for m in marks)),
        settings.sample, "__key",
    )
    rows = docs.select(F.col(key).alias("__key"), _lowered(text)).join(F.broadcast(known), "__key")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "__text"):
            words, owner = words_of(*bytes_of(group.column("__text")))
            order = np.argsort(owner, kind="stable")
            words, cuts = words[order], np.searchsorted(owner[order], np.arange(group.num_rows + 1))
            sets = [np.unique(words[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [group.column("__key"), *(group.column(m) for m in marks), pa.array(sets, pa.binary())],
                names=["__key", *marks, "words"],
            )

    schema = T.StructType([*known.schema, T.StructField("words", T.BinaryType())])
    # Of several documents of one key the one of smallest word set, by hash and then by itself.
    first = F.min(F.struct(F.xxhash64("words").alias("hash"), "words", *marks)).alias("first")
    sample = (
        rows.select("__key", *marks, "__text").mapInArrow(hashed, schema)
        .groupBy("__key").agg(first).select("__key", *(f"first.{m}" for m in marks), "first.words")
    )

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(
            list(batches), pa.schema([*((m, pa.int32()) for m in marks), ("words", pa.binary())])
        )
        sets = [np.frombuffer(words, np.uint64) for words in found["words"].to_pylist()]
        values = np.array([found[m].to_numpy() for m in marks], float).reshape(len(marks), -1).T
        # Copies hold the same words, so they fall into the same fold.
        with np.errstate(over="ignore"):
            folds = np.array([int(words.sum() % np.uint64(settings.folds)) for words in sets], int)
            marks_of = np.array([int(words.sum() >> np.uint64(1)) for words in sets], np.int64)
        order = np.argsort(marks_of, kind="stable")  # in any order they arrive: the same sums
        chain = fit_chain([sets[i] for i in order], values[order], folds[order], settings)
        yield pa.RecordBatch.from_pydict({
            "keys": [chain.keys.tobytes()],
            "links": [[[link.base, *link.words, *link.earlier] for link in chain.links]],
        })

    row = sample.select(*marks, "words").coalesce(1).mapInArrow(
        fitted, "keys binary, links array<array<double>>"
    ).first()
    keys = np.frombuffer(row.keys, np.uint64)
    return Chain(keys, tuple(
        Link(link[0], np.array(link[1 : 1 + len(keys)]), np.array(link[1 + len(keys) :]))
        for link in row.links
    ))


def scored(
    docs: DataFrame,
    chain: Chain,
    categories: Sequence[str],
    text: str = "text",
    keep: Sequence[str] | None = None,
    into: str = "probabilities",
) -> DataFrame:
    """The columns ``keep`` (all but one of the new name) and a struct ``into`` of the probabilities."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(chain)
    inner = T.StructType([T.StructField(c, T.DoubleType()) for c in categories])
    names = [name for name in docs.columns if name != into] if keep is None else keep
    whole = F.struct(*(F.col(f"`{name}`") for name in names)).alias("__row")
    rows = docs.select(whole, _lowered(text))
    schema = T.StructType([rows.schema["__row"], T.StructField(into, inner)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for group in groups(batches, "__text"):
            words, owner = words_of(*bytes_of(group.column("__text")))
            if len(model.keys):
                maybe = np.zeros(1 << 16, bool)
                maybe[model.keys & np.uint64(0xFFFF)] = True
                some = maybe[words & np.uint64(0xFFFF)]
                words, owner = words[some], owner[some]
                at = np.searchsorted(model.keys, words) % len(model.keys)
                hit = model.keys[at] == words
                pairs = _distinct(owner[hit], at[hit], len(model.keys))
            else:
                pairs = np.zeros(0, np.int64), np.zeros(0, np.int64)
            found = model.probabilities(*pairs, group.num_rows)
            yield pa.RecordBatch.from_arrays(
                [group.column("__row"), pa.StructArray.from_arrays(
                    [pa.array(column) for column in found.T], names=list(categories)
                )], names=["__row", into],
            )

    return rows.mapInArrow(task, schema).select("__row.*", into)


def judged(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    judged_by: str,
    settings: ChainSettings = ChainSettings(),
    text: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``scored`` by a chain trained here, and ``rejected``: the category ``judged_by`` is likely."""
    chain = train(docs, labels, categories, settings, text=text)
    return scored(docs, chain, categories, text, keep).withColumn(
        "rejected", F.col(f"probabilities.{judged_by}") >= settings.threshold
    )
