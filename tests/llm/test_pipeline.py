from __future__ import annotations

import re
from collections import Counter

import pytest
import public_tokenizers as P
from pyspark.sql import functions as F

import corpus_pipeline
from cartorio.llm import byte_bpe, ngram_join, toxicity
from cartorio.llm.pii import pseudonymised
from cartorio.llm.corpus_queries import CATEGORIES, PSEUDONYM_KEY, labels

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after every stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], FOLDER).write.parquet(f"{folder}/{number}")
        out.append(spark.read.parquet(f"{folder}/{number}"))
    return out


def test_columns(stages):
    for docs in stages[1:-1]:
        assert docs.columns == stages[0].columns
    assert stages[-1].columns == ["doc_id", "lang", "source", "ids", "token_begins"]


def test_toxic_documents_go(spark, stages):
    docs, kept = stages[:2]
    chain = toxicity.train(docs, labels(spark, FOLDER), CATEGORIES)
    found = toxicity.scored(docs, chain, CATEGORIES, keep=["doc_id"]).collect()
    want = {r.doc_id for r in found if r.probabilities.toxic < 0.5}
    assert {r.doc_id for r in kept.collect()} == want and len(want) > 0.8 * len(found)


def test_one_of_each_group_stays(spark, stages):
    docs, kept = stages[1:3]
    sets = {}
    for row in docs.collect():
        words = (row.text or "").lower().split()
        sets[row.doc_id] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}
    left = {r.doc_id for r in kept.collect()}

    def near(a, b):
        both = len(sets[a] & sets[b])
        return both / (len(sets[a]) + len(sets[b]) - both) >= 0.8

    assert not any(near(a, b) for a in left for b in left if a < b)
    linked = {a for a in sets for b in sets if a != b and near(a, b)}
    assert set(sets) - left <= linked
    assert len(left) == ngram_join.similar(docs).select("group_key").distinct().count()


def test_pseudonyms_and_length(stages):
    before = {r.doc_id: r for r in stages[2].collect()}
    after = {r.doc_id: r for r in stages[3].collect()}
    assert before.keys() == after.keys()
    for key, row in after.items():
        assert row.text == pseudonymised(before[key].text, PSEUDONYM_KEY)[0] and row.n_chars == len(row.text)
    assert any(before[key].text != after[key].text for key in after)


def test_mixture(stages):
    docs, mixture = stages[3:5]
    rows = {r.doc_id: tuple(r) for r in docs.collect()}
    taken = Counter(tuple(r) for r in mixture.collect())
    assert all(rows[row[0]] == row and n <= 3 for row, n in taken.items())
    size = Counter()
    for row in rows.values():
        size[row[3]] += len(re.findall(r"\S+", row[1]))
    total = sum(size.values())
    assert abs(sum(len(re.findall(r"\S+", row[1])) * n for row, n in taken.items()) - total) < 0.1 * total


def test_tokens(spark, stages):
    mixture, encoded = stages[4:6]
    decoded = byte_bpe.decode(encoded, P.path("byte_bpe_50k.tiktoken"))
    got = Counter((r.doc_id, bytes(r.decoded).decode()) for r in decoded.collect())
    assert got == Counter((r.doc_id, r.text) for r in mixture.select("doc_id", "text").collect())


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == stages[-1].columns
    sums = [F.count("*"), F.sum(F.xxhash64("doc_id", "ids") % 1000003)]
    assert got.agg(*sums).first() == stages[-1].agg(*sums).first()


def test_odd_rows_pass_all_stages(spark):
    """Null and empty fields, repeated rows and columns named like the operators' own."""
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "a b c", "en", None, 5),
            (3, "w " * 50_000, "en", "s", 100_000), (4, "plain words of some length here", "de", "t", 31)]
    odd = ["size", "key", "group", "mark", "class", "ids", "probabilities", "rejected", "__toxicity"]
    docs = spark.createDataFrame(
        [(*row, *("x" for _ in odd)) for row in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{n}` string" for n in odd),
    )
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, FOLDER)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == docs.columns, name
            assert stage(spark, docs.limit(0), FOLDER).collect() == [], name
            docs = spark.createDataFrame(made.collect(), docs.schema)
            assert docs.count() > 0
    assert made.count() == docs.count()


def test_a_column_named_like_the_probabilities_stays(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wide = docs.withColumn("toxicity", F.lit("mine")).withColumn("Toxicity_", F.lit("too")).withColumn("__toxicity", F.lit("also"))
    found = pipeline.without_toxic(spark, wide, "/root/testdata/sf0.001")
    assert found.columns == wide.columns
    assert found.select("toxicity", "Toxicity_", "__toxicity").distinct().collect() == [("mine", "too", "also")]
