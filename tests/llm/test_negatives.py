from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartorio.llm.negatives import MiningSettings, exact_scores, mined, primes_for, residues, usable

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, rank int"


def _table(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 0) for i, v, label in rows], SCHEMA)


def _brute(rows, scale=256):
    best = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        v = [float(np.float32(x)) for x in v]
        if i not in best or (label, v) < best[i]:
            best[i] = label, v
    whole = {i: (label, [int(np.floor(scale * x)) for x in v]) for i, (label, v) in best.items()}
    out = []
    for a in (i for i in whole if i % 100 == 0):
        scores = {i: sum(x * y for x, y in zip(whole[a][1], v)) for i, (_, v) in whole.items() if i != a}
        order = sorted(scores, key=lambda i: (-scores[i], i))
        for p in [i for i in order if whole[i][0] == whole[a][0]][:5]:
            window = [n for n in order if whole[n][0] != whole[a][0]
                      and 30 * scores[p] <= 100 * scores[n] <= 90 * scores[p]]
            out += [(a, p, rank, n, scores[p], scores[n]) for rank, n in enumerate(window[:10], 1)]
    return sorted(out)


def _mined(table, **settings):
    found = mined(usable(table, F.col("label")), F.col("vec_id") % 100 == 0, MiningSettings(**settings))
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("width,size", [(3, 1e3), (300, 1e5), (700, 40.0)])
def test_scores_are_exact(width, size):
    rng = np.random.default_rng(width)
    left, right = (np.floor(rng.uniform(-size, size, (n, width))) for n in (7, 9))
    bound = max(float((x**2).sum(1).max()) for x in (left, right))
    primes = primes_for(bound)
    assert np.prod([float(p) for p in primes]) > 2 * bound
    want = [[sum(int(x) * int(y) for x, y in zip(a, b)) for b in right] for a in left]
    assert exact_scores(residues(left, primes), residues(right, primes), primes).tolist() == want


def test_scores_up_to_the_bound():
    big = np.full((1, 4), 2.0**28)
    primes = primes_for(float((big**2).sum()))
    assert exact_scores(residues(big, primes), residues(-big, primes), primes).tolist() == [[-(2**58)]]


@pytest.mark.parametrize("block", [8192, 150])
def test_against_brute_force(spark, block):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(4, 12))
    rows = [(i, (0.3 * (centres[(label := int(rng.integers(0, 4)))] + rng.normal(size=12))).tolist(), label)
            for i in range(900)]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    assert _mined(_table(spark, rows), block=block) == _brute(rows) != []


def test_unusable_repeated_and_tied_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 0.5, 0.25], i % 2) for i in range(40)]  # all alike: ties everywhere
    rows += [(100 + i, [float(np.float32(x)) for x in rng.normal(size=3)], i % 3) for i in range(60)]
    rows += [(i, [0.5, 0.25, 0.125], 2) for i in range(300, 340)]
    rows += [(0, [1.0, 0.5, 0.25], 0)] * 3 + [(100, [9.0, 9.0, 9.0], 5), (None, [1.0, 1.0, 1.0], 0)]
    rows += [(200, None, 1), (500, [1.0, None, 1.0], 1), (600, [float("nan"), 1.0, 1.0], 1),
             (700, [float("inf"), 1.0, 1.0], 1), (800, [1.0, 1.0, 1.0], None), (900, [], 1), (901, [2.0], 1)]
    assert _mined(_table(spark, rows), block=32) == _brute(rows) != []


def test_an_anchor_alone_an_empty_table_and_too_large_scores(spark):
    assert _mined(_table(spark, [(0, [1.0], 0), (1, [1.0], 1)])) == []
    assert _mined(_table(spark, [])) == []
    with pytest.raises(ValueError, match="don't fit"):
        _mined(_table(spark, [(0, [1e30], 0)]))


def test_pieces_stay_within_their_blocks(spark):
    from cartorio.llm.negatives import _on_grid

    rows = usable(_table(spark, [(i, [1.0], 0) for i in range(2000)]), F.col("label"))
    grid = _on_grid(rows.withColumn("wanted", F.lit(None)), rows, [4, 8])
    held = grid.groupBy("a", "r", "kind").count().collect()
    assert len(held) == 64 and max(row["count"] for row in held) < 2 * 2000 / 4
