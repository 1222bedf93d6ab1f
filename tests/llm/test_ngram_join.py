from __future__ import annotations

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from cartorio.llm import corpus_queries, ngram_join
from cartorio.llm.components import components
from cartorio.llm.ngram_join import JoinSettings, _Forest, deduplicated, similar
from cartorio.sources.scratch import fresh_folder


def _sets(texts):
    def cut(text):
        words = (text or "").lower().split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())

    return [cut(text) for text in texts]


def _brute(ids, texts, threshold=0.8):
    """Links and group of every row, from all pairs."""
    sets, links, head = _sets(texts), [0] * len(ids), list(range(len(ids)))

    def root(i):
        while head[i] != i:
            i = head[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and both / (len(a) + len(sets[j]) - both) >= threshold:
                links[i] += 1
                links[j] += 1
                head[root(i)] = root(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(root(i), []).append(ids[i])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(((ids[i], least[root(i)], links[i]) for i in range(len(ids))), key=repr)


def _near_copies(rng, n, length=60):
    base = [f"w{rng.randrange(500)}" for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            words[rng.randrange(length)] = f"x{rng.randrange(9999)}"
        out.append(" ".join(words))
    return out


def _texts():
    rng = random.Random(4)
    texts = [None, "", "  \n", "one", "one", "One", "two words", "a b c d", "a b c d e", "A  b\nc d e"]
    texts += _near_copies(rng, 70) + _near_copies(rng, 9) + _near_copies(rng, 4, 400) + ["z " * 30_000]
    texts += [" ".join(f"w{rng.randrange(500)}" for _ in range(rng.randrange(1, 80))) for _ in range(60)]
    return texts


@pytest.mark.parametrize("block", [1000, 16])
def test_against_all_pairs(spark, block):
    texts = _texts()
    ids = list(range(100, 100 + len(texts)))
    rows = [(i, t, 1, 2) for i, t in zip(ids, texts)]
    rows += [rows[40], (None, texts[41], 1, 2), (None, "lonely text without any copy", 1, 2), (40, texts[42], 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, class int, n_links int")
    found = similar(docs, JoinSettings(block=block, recall=0.9999, trees=20))
    assert found.columns == ["key", "class_key", "group_key", "n_links"]
    got = sorted(((r.key, r.group_key, r.n_links) for r in found.collect()), key=repr)
    assert got == _brute([r[0] for r in rows], [r[1] for r in rows])


def test_one_stays_of_each_group(spark):
    texts = _texts()
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    rows += [rows[30], (30, "another text under the same number of its own", "s"), (None, texts[31], "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = deduplicated(docs)
    assert kept.columns == docs.columns
    groups = {(g if t and t.split() else (i, t)) for i, g, t in _grouped(rows)}
    assert kept.count() == len(groups)


def _grouped(rows):
    sets = _sets([r[1] for r in rows])
    head = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both / (len(sets[i]) + len(sets[j]) - both) >= 0.8:
                a, b = head[i], head[j]
                head = [min(a, b) if h in (a, b) else h for h in head]
    return [(r[0], h, r[1]) for r, h in zip(rows, head)]


def test_query_against_all_pairs(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = corpus_queries.op7_ngram_join(spark, folder).collect()
    got = sorted(((r.doc_id, r.group_id, r.n_links) for r in rows), key=repr)
    assert got == _brute([d.doc_id for d in docs], [d.text for d in docs])


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_same_as_sql(spark, folder):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    query = duck.sql(corpus_queries.SQL["op7_ngram_join"])
    ours = corpus_queries.op7_ngram_join(spark, folder)
    assert ours.columns == query.columns
    assert sorted(map(tuple, ours.collect())) == sorted(query.fetchall())


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert similar(docs).collect() == [] and deduplicated(docs).collect() == []


def test_prefix_is_the_longest_that_reaches_the_recall():
    settings = JoinSettings()
    assert settings.recall_at(settings.prefix) >= settings.recall > settings.recall_at(settings.prefix + 1)
    assert JoinSettings(trees=1, recall=1.0).prefix == 1


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 9, 10, 17, 40, 99])
def test_depths_follow_from_what_a_set_can_share(size):
    settings = JoinSettings()
    reach = [
        common / (size + other - common) for other in range(1, 3 * size + 3) for common in range(min(size, other) + 1)
    ]
    least = min((x for x in reach if settings.threshold <= x < 1), default=1.0)
    assert settings.lowest_similarity(size) == least
    depth = settings.depths(size + 1)[size]
    assert settings.prefix <= depth <= settings.longest
    assert depth == settings.longest or 1 - (1 - least ** (depth + 1)) ** settings.trees < settings.recall
    assert 1 - (1 - least**depth) ** settings.trees >= settings.recall


def test_tries_share_what_signatures_share():
    rng = np.random.default_rng(3)
    settings = JoinSettings(trees=3, longest=5)
    signatures = rng.integers(0, 3, (40, 3, 5)).astype(">u4")
    signatures[7] = signatures[30]
    table = pa.table({
        "signature": pa.array([x.tobytes() for x in signatures], pa.binary()),
        "size": pa.array(rng.integers(1, 60, 40), pa.int32()),
    })
    forest = _Forest(table, settings, settings.depths(30))
    rows = rng.permutation(40)[:25]
    for tree in range(3):
        shared = forest.shared(rows, tree)
        for i, a in enumerate(rows):
            for j, b in enumerate(rows):
                same = signatures[a, tree] == signatures[b, tree]
                want = 5 if same.all() else int(same.argmin())
                assert shared[i, j] == want
                assert forest(rows, tree)[i, j] == (want >= max(forest.depth[a], forest.depth[b]))


def test_a_row_many_thousand_times(spark):
    """One row repeated, beside a text nearly like it: one set of each class goes to a piece."""
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words))] * 6000 + [(2, " ".join(words + ["x"])), (3, "a b c d e f g")]
    found = similar(spark.createDataFrame(rows, "doc_id bigint, text string")).distinct().collect()
    assert {tuple(r) for r in found} == {(1, 1, 1, 6000), (2, 2, 1, 6000), (3, 3, 3, 0)}


def test_a_crowded_subtree(spark):
    """Many texts that differ little: each pair is judged once, whatever the blocks."""
    words = [f"w{i}" for i in range(400)]
    rows = [(n, " ".join([f"v{n}", *words])) for n in range(900)]
    found = similar(spark.createDataFrame(rows, "doc_id bigint, text string"), JoinSettings(block=100)).collect()
    assert {(r.group_key, r.n_links) for r in found} == {(0, 899)}


def test_measured_recall(spark):
    """Pairs just over the threshold, found with at least the target probability."""
    rng = random.Random(11)
    rows = []
    for pair in range(300):
        words = [f"p{pair}w{k}" for k in range(104)]
        other = [*words[:93], *(f"q{pair}w{k}" for k in range(11))]  # 89 of 111 shingles: 0.80
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(other))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    linked = similar(docs).filter("n_links = 1").count()
    assert linked >= 0.98 * len(rows)
    assert rng


def test_long_chains_are_one_component(spark):
    edges = [(b"%03d" % i, b"%03d" % (i + 1)) for i in range(120)] + [(b"a", b"b"), (b"c", None), (b"d", b"d")]
    table = spark.createDataFrame([(bytearray(a), bytearray(b) if b else None) for a, b in edges], "x binary, y binary")
    found = {bytes(r.node): bytes(r.root) for r in components(table, "x", "y", fresh_folder(spark, "cc")).collect()}
    assert found == {**{b"%03d" % i: b"000" for i in range(1, 121)}, b"b": b"a"}


def test_pieces_larger_than_a_batch_stay_whole(spark):
    """Many sets that share most shingles, judged by dense bits in more than one stretch."""
    rng = np.random.default_rng(3)
    common = np.arange(900, dtype=np.uint64)
    sets = [np.unique(np.concatenate([common, rng.integers(1000, 90_000, 150).astype(np.uint64)])) for _ in range(60)]
    asked = np.triu(np.ones((60, 60), bool), 1)
    got = {tuple(p) for p in ngram_join._linked(sets, asked, 0.8).tolist()}
    want = {
        (i, j) for i in range(60) for j in range(i + 1, 60)
        if len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j])) >= 0.8
    }
    assert got == want
