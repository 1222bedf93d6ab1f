from __future__ import annotations

import re

import numpy as np
import pytest

from cartorio.llm import corpus_queries, mixing
from cartorio.llm.mixing import MixSettings, balance, mixed, repeated


def _level(sizes, settings):
    """Targets by sharing out what is above the limit again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weights = {s: settings.weights[i % len(settings.weights)] for i, s in enumerate(order)}
    targets, total, free = dict.fromkeys(order, 0.0), settings.share * sum(sizes.values()), set(order)
    while free:
        share = {s: total * weights[s] / sum(weights[f] for f in free) for s in free}
        over = {s for s in free if share[s] > settings.most * sizes[s] + 1e-9}
        for s in over or free:
            targets[s] = settings.most * sizes[s] if s in over else share[s]
            total -= targets[s] if s in over else 0
        if not over:
            break
        free -= over
    return targets


def _words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_query_against_plain_targets(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    sizes = {}
    for doc in docs.values():
        sizes[doc.source] = sizes.get(doc.source, 0) + _words(doc.text)
    targets = _level(sizes, MixSettings())
    rows = corpus_queries.op5_source_mix(spark, folder).collect()
    assert len(rows) == len(docs)
    taken = dict.fromkeys(sizes, 0)
    for row in rows:
        source = docs[row.doc_id].source
        assert row["size"] == _words(docs[row.doc_id].text) and row.source_size == sizes[source]
        assert row.target == pytest.approx(targets[source])
        assert row.taken <= 3 * row["size"]
        taken[source] += row.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(0.005 * target, 60), source
    again = corpus_queries.op5_source_mix(spark, folder).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_hot_and_tiny_sources_in_small_blocks(spark, setting):
    """A third of all rows in one source, null source, and a source that reaches its limit."""
    rows = [(i, "w " * (1 + i % 17), "hot" if i % 3 == 0 else f"s{i % 5}", i) for i in range(3000)]
    rows += [(9001, "one two", None, 1), (9002, None, None, 1), (9003, "", "empty", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, target int")
    settings = MixSettings(block=64)
    found = mixed(docs, settings)
    assert found.columns == ["doc_id", "size", "source_size", "target", "copies", "taken"]
    got = found.collect()
    assert len(got) == len(rows)
    by_id = {r[0]: r for r in rows}
    sizes = {}
    for _, text, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + _words(text)
    targets = _level(sizes, settings)
    taken = dict.fromkeys(sizes, 0)
    for row in got:
        taken[by_id[row.doc_id][2]] += row.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 20, (source, target, taken[source])
    setting("spark.sql.shuffle.partitions", "7")  # dealt otherwise, the same result
    again = mixed(docs.repartition(5), settings).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_repeated_rows_and_copies(spark):
    rows = [(1, "a b c", "x")] * 40 + [(i, "d e", "x") for i in range(2, 40)] + [(50, "f " * 200, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    copies = mixed(docs).collect()
    mixture = repeated(docs)
    assert mixture.columns == docs.columns
    got = sorted(map(tuple, mixture.collect()))
    texts = {r[0]: r for r in rows}
    want = sorted(texts[c.doc_id] for c in copies for _ in range(c.copies))
    assert len(got) == len(want)
    assert abs(sum(_words(r[1]) for r in got) - sum(_words(r[1]) for r in want)) <= 20


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert mixed(docs).collect() == [] and repeated(docs).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_flight_keeps_both_sums(seed):
    rng = np.random.default_rng(seed)
    chances, sizes = rng.random(300), rng.integers(0, 50, 300)
    draws = rng.random((300, 2))
    out = balance(chances, sizes, draws, land=False)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(chances.sum()) and out @ sizes == pytest.approx(chances @ sizes)
    landed = balance(chances, sizes, draws, land=True)
    assert set(landed) <= {0.0, 1.0} and abs(landed @ sizes - chances @ sizes) < 5
    assert (balance(np.full(5, 0.4), np.zeros(5), draws[:5], True) >= 0).all()


def test_chances_hold_on_average():
    rng = np.random.default_rng(7)
    chances, sizes = np.full(60, 0.3), rng.integers(1, 30, 60)
    mean = np.mean([balance(chances, sizes, rng.random((60, 2)), True) for _ in range(400)], axis=0)
    assert abs(mean.mean() - 0.3) < 0.02 and abs(mean - 0.3).max() < 0.2


def test_rows_alike_are_dealt_like_others(spark, monkeypatch):
    """One row twenty thousand times, and rows of no id and no text: groups stay near the block's size."""
    rows = [(1, "ja nein", "a")] * 20_000 + [(None, None, "b")] * 5_000 + [(i, "doch " * (i % 9), "b") for i in range(2, 3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    settings = mixing.MixSettings(block=1000)
    seen = []
    rounded = mixing._rounded

    def watched(dealt, given, turn, last):
        if turn == 0:
            seen.extend(row["count"] for row in dealt.groupBy("group", "part").count().collect())
        return rounded(dealt, given, turn, last)

    monkeypatch.setattr(mixing, "_rounded", watched)
    found = mixing.mixed(docs, settings)
    assert found.count() == len(rows) and max(seen) < 1300
    sums = found.groupBy("source_size", "target").sum("taken").collect()
    assert all(abs(r["sum(taken)"] - r.target) <= 20 for r in sums)
    again = mixing.mixed(docs.repartition(7), settings)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(found) == key(again)
