from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartorio.llm import corpus_queries, toxicity
from cartorio.llm.toxicity import ChainSettings, fit_chain, fit_logistic, judged, scored, train, words_of


def _corpus(spark, n=600):
    rng = random.Random(2)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    rows, marks = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 400))]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["Scum", "loser,", f"grubbel{rng.choice(plain)}"])
        rows.append((i, " ".join(words), "extra"))
        if i % 2 == 0:
            marks.append((i, int(i % 3 == 0), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, probabilities string")
    return docs, spark.createDataFrame(marks, "doc_id bigint, other int, toxic int")


def test_held_out_documents(spark):
    docs, labels = _corpus(spark)
    rows = judged(docs, labels, ["other", "toxic"], "toxic", keep=["doc_id"]).collect()
    unseen = [r for r in rows if r.doc_id % 2]
    assert sum(r.rejected == (r.doc_id % 5 == 0) for r in unseen) >= 0.97 * len(unseen)
    assert not any(r.rejected for r in unseen if r.doc_id % 5)


def test_edges(spark):
    docs, labels = _corpus(spark, 200)
    more = spark.createDataFrame(
        [(1000, None, "e"), (1001, "", "e"), (None, "SCUM", "e"), (0, "repeated id", "e"), (1002, "w " * 100_000 + "scum", "e")],
        docs.schema,
    )
    odd = spark.createDataFrame([(1000, None, 1), (2, 0, 0), (7777, 1, 1)], labels.schema)
    chain = train(docs.union(more), labels.union(odd), ["other", "toxic"])
    found = scored(docs.union(more), chain, ["other", "toxic"])
    assert found.columns == ["doc_id", "text", "probabilities"]
    rows = found.collect()
    assert len(rows) == 205
    by_id = {r.doc_id: r.probabilities for r in rows}
    assert by_id[1000] == by_id[1001] and by_id[1000].toxic < 0.5
    again = scored(docs.union(more).repartition(3), chain, ["other", "toxic"])
    assert sorted(map(repr, again.collect())) == sorted(map(repr, rows))


def test_training_does_not_depend_on_partitions(spark):
    docs, labels = _corpus(spark, 300)
    first = train(docs, labels, ["other", "toxic"])
    second = train(docs.repartition(5, "text"), labels.repartition(3), ["other", "toxic"])
    assert (first.keys == second.keys).all()
    for a, b in zip(first.links, second.links):
        np.testing.assert_allclose(a.words, b.words, atol=1e-5)


@pytest.mark.parametrize("rows", [[], [(1, 0)], [(1, 1), (2, 1)]])
def test_labels_that_teach_nothing(spark, rows):
    docs = spark.createDataFrame([(1, "a b"), (2, "c d"), (3, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame(rows, "doc_id bigint, toxic int")
    found = judged(docs, labels, ["toxic"], "toxic").collect()
    assert [r.rejected for r in found] == [len(rows) == 2] * 3
    assert judged(docs.limit(0), labels, ["toxic"], "toxic").collect() == []


def test_sample_is_bounded(spark):
    docs, labels = _corpus(spark, 300)
    chain = train(docs, labels, ["toxic"], ChainSettings(sample=1))
    assert len(chain.keys) == 0


def test_words_and_stems():
    texts = ["Ab' éfghijk", "", "x1abcd"]
    parts = [t.encode() for t in texts]
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    _, owner = words_of(np.frombuffer(b"".join(parts), np.uint8), ends)
    assert sorted(owner.tolist()) == [0] * 5 + [2] * 2  # Ab, éfghijk and three stems; x, abcd


def test_logistic_finds_the_slope():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 + 2 * x[:, 0])))).astype(float)
    weights = fit_logistic(x, y, 1.0)
    np.testing.assert_allclose(weights, [0.5, 2, 0], atol=0.25)


def test_later_links_use_out_of_fold_predictions():
    """The first category is noise on words unique to a text: fitted in sample it would look certain."""
    rng = np.random.default_rng(1)
    words = [np.array([i + 10, 5 if i % 2 else 6], np.uint64) for i in range(400)]
    marks = np.column_stack([rng.integers(0, 2, 400), np.arange(400) % 2]).astype(float)
    chain = fit_chain(words, marks, np.arange(400) % 5, ChainSettings(association=0.0))
    assert abs(chain.links[1].earlier[0]) < 1.0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = corpus_queries.op9_toxicity(spark, folder)
    assert rows.columns == ["doc_id", "p_poor", "p_toxic", "is_toxic"]
    assert rows.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    found = rows.filter("is_toxic").select("doc_id").collect()
    assert not any(labels.get(r.doc_id) == 0 for r in found)
    assert rows.select(F.max("p_toxic")).first()[0] <= 1


def _auc(scores, marks):
    order = np.argsort(np.argsort(scores))
    positive = marks == 1
    n, m = positive.sum(), (~positive).sum()
    return (order[positive].sum() - n * (n - 1) / 2) / (n * m)


def test_predictions_out_of_fold_know_nothing_of_the_fold(monkeypatch):
    """Labels at random, a wide vocabulary, words chosen lightly: nothing can be told."""
    rng = np.random.default_rng(7)
    n = 600
    words = [np.unique(rng.integers(0, 5000, 120).astype(np.uint64)) for _ in range(n)]
    marks = rng.integers(0, 2, (n, 1)).astype(float)
    seen = []
    whole = toxicity._unseen
    monkeypatch.setattr(toxicity, "_unseen", lambda *given: seen.append(whole(*given)) or seen[-1])
    chain = toxicity.fit_chain(words, marks, rng.integers(0, 5, n), toxicity.ChainSettings(association=5))
    assert len(chain.keys) > 20 and abs(_auc(seen[0], marks[:, 0]) - 0.5) < 0.08


def test_a_fit_of_repeated_keys_is_repeatable(spark):
    rows = [(i % 20, f"wort{i % 7} gut schlecht{i % 3} " * 5) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id bigint, toxic int")
    chains = [
        toxicity.train(docs.repartition(parts, *by), labels, ["toxic"])
        for parts, by in ((1, []), (5, ["text"]), (3, []))
    ]
    for chain in chains[1:]:
        assert (chain.keys == chains[0].keys).all()
        assert (chain.links[0].words == chains[0].links[0].words).all() and chain.links[0].base == chains[0].links[0].base
