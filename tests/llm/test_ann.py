from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartorio.llm.ann import SearchSettings, cluster, nearest
from cartorio.llm.ann_queries import op2_ann_search

SCHEMA = "vec_id bigint, embedding array<float>, score string"


def _table(spark, vectors, first=0):
    return spark.createDataFrame(
        [(first + i, [float(np.float32(x)) for x in v], "x") for i, v in enumerate(vectors)], SCHEMA
    )


def _brute(rows, queries, k):
    ids = np.array([r[0] for r in rows])
    vectors = np.array([r[1] for r in rows], np.float64)
    out = {}
    for q, vector in queries:
        scores = np.zeros(len(rows))
        for column in range(vectors.shape[1]):
            scores += vectors[:, column] * np.float64(vector[column])
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(scores[i])) for i in order]
    return out


def _found(df):
    out = {}
    for row in df.orderBy("query_id", "rank").collect():
        out.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row.rank == len(out[row.query_id])
    return out


@pytest.mark.parametrize("scale", [False, True])
def test_recall_and_exact_scores(spark, scale):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 24)) + 2 * rng.normal(size=(12, 24))[rng.integers(0, 12, 3000)]
    if scale:
        vectors *= rng.uniform(0.2, 3, size=(3000, 1))  # norms differ: not the cosine
    table = _table(spark, vectors)
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = _found(nearest(table, SearchSettings(sample=1000, block=100), F.col("vec_id") % 25 == 0))
    want = _brute(rows, [r for r in rows if r[0] % 25 == 0], 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    scores = {q: dict(_brute(rows, [(q, dict(rows)[q])], 3000)[q]) for q in list(want)[:5]}
    for q, all_scores in scores.items():
        assert all(all_scores[i] == score for i, score in got[q])


def test_unusable_vectors_and_ties(spark):
    rng = np.random.default_rng(2)
    good = [[1.0, 0.0, 0.0]] * 30 + rng.normal(size=(10, 3)).tolist()
    table = _table(spark, good)
    nan, inf = float("nan"), float("inf")
    odd = spark.createDataFrame([
        (100, None, "n"), (101, [0.0, 0.0, 0.0], "z"), (102, [1.0, None, 0.0], "c"), (103, [nan, 1.0, 0.0], "i"),
        (104, [1.0, inf, 0.0], "i"), (105, [1.0, 0.0], "l"), (106, [], "e"), (None, [9.0, 9.0, 9.0], "k"),
        (3, [5.0, 5.0, 5.0], "repeated id"),
    ], SCHEMA)
    whole = table.unionByName(odd)
    rows = [(r.vec_id, r.embedding) for r in table.collect()] + [(3, [5.0, 5.0, 5.0])]
    got = _found(nearest(whole, SearchSettings(k=5), F.col("vec_id").isin(0, 35, 100, 105)))
    want = _brute(rows, [(0, good[0]), (35, np.float32(good[35]))], 5)
    assert got.keys() == {0, 35}
    assert got[0] == want[0] and got[35] == want[35]


def test_fewer_candidates_than_asked(spark):
    got = _found(nearest(_table(spark, [[1.0, 0.5], [0.5, 1.0], [-1.0, 0.2]], first=20), is_query=F.col("vec_id") == 20))
    assert [i for i, _ in got[20]] == [21, 22]
    assert nearest(_table(spark, [[1.0, 0.5]])).collect() == []
    none = nearest(spark.createDataFrame([], SCHEMA))
    assert none.columns == ["query_id", "rank", "vec_id", "score"] and none.collect() == []


@pytest.mark.parametrize("times", [1, 2, 25])
def test_repeated_query_rows(spark, times):
    """Every copy of a query row has all its neighbours, also that of the same vector and another id."""
    vectors = np.random.default_rng(4).normal(size=(80, 8))
    vectors[79] = vectors[5]
    once = _table(spark, vectors)
    table = once.unionAll(once.filter("vec_id = 5").crossJoin(spark.range(times - 1)).drop("id")) if times > 1 else once
    rows = [(r.vec_id, r.embedding) for r in once.collect()]
    want = _brute(rows, [rows[5]], 20)[5]
    exact = SearchSettings(lists=1, slack=100.0)
    got = nearest(table, exact, F.col("vec_id") == 5).collect()
    assert len(got) == 20 * times
    for rank, (found, score) in enumerate(want, 1):
        assert [(r.vec_id, r.score) for r in got if r.rank == rank] == [(found, score)] * times


def test_hot_vector(spark):
    """A third of all rows near one vector, lists cut into small blocks."""
    rng = np.random.default_rng(3)
    hot = rng.normal(size=16)
    vectors = np.vstack([hot + 0.01 * rng.normal(size=(600, 16)), rng.normal(size=(1200, 16))])
    table = _table(spark, vectors)
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = _found(nearest(table, SearchSettings(block=50, sample=500), F.col("vec_id") % 30 == 0))
    want = _brute(rows, [r for r in rows if r[0] % 30 == 0], 20)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want) and all(len(v) == 20 for v in got.values())


def test_clusters_are_never_empty_handed():
    points = np.repeat(np.eye(3), 10, axis=0)
    found = cluster(points, 5, np.random.default_rng(0))
    assert found.shape == (5, 3) and np.isfinite(found).all()


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = _found(op2_ann_search(spark, folder))
    want = _brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert got.keys() == want.keys() and hits >= 0.9 * 20 * len(want)
