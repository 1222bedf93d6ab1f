"""Profiles of columns, merged and whole."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from cartorio.operators.profiles import DISTINCT_ERROR, RANK_ERROR, column_profile, described, merged
from cartorio.plans import monthly
from cartorio.plans.queries import column_profile as profile_query, exact_counts
from support import plan_of, raw_rows, sound


def _rows(spark, n=60_000):
    return spark.range(n).select(
        F.col("id").alias("every"), (F.col("id") % 17).cast("int").alias("few"),
        F.when(F.col("id") % 3 == 0, F.repeat(F.lit("x"), (F.col("id") % 100).cast("int"))).alias("text"),
        F.lit(None).cast("string").alias("none"), F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id")).alias("hot"),
    ).repartition(6)


def _ranks(rows, column, value):
    """The lowest and the highest rank (as a share) that a value has."""
    total = rows.filter(F.col(column).isNotNull())
    n = total.count()
    return total.filter(F.col(column) < value).count() / n, total.filter(F.col(column) <= value).count() / n


def test_errors_are_as_stated(spark):
    rows = _rows(spark)
    found = {r.column: r for r in described(column_profile(rows)).collect()}
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in rows.columns]).first()
    for name in rows.columns:
        assert abs(found[name].n_distinct - exact[name]) <= DISTINCT_ERROR * exact[name]
        assert found[name].rows == 60_000 and found[name].filled == rows.filter(f"{name} IS NOT NULL").count()
    lengths = rows.withColumn("text", F.length("text"))
    for name in ("every", "few", "text", "hot"):
        for share, value in ((0.25, found[name].q1), (0.5, found[name].median), (0.75, found[name].q3)):
            low, high = _ranks(lengths, name, value)
            assert low - RANK_ERROR <= share <= high + RANK_ERROR
    assert found["none"].median is None and found["none"].n_distinct == 0 and found["none"].null_rate == 1.0


def test_merged_parts_equal_one_pass_within_the_error(spark):
    rows = _rows(spark)
    whole = {r.column: r for r in described(column_profile(rows)).collect()}
    parts = [column_profile(rows.filter(f"every % 4 = {part}")) for part in range(4)]
    union = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
    put = {r.column: r for r in described(merged(union)).collect()}
    for name, row in whole.items():
        assert (put[name].rows, put[name].filled, put[name].null_rate) == (row.rows, row.filled, row.null_rate)
        assert put[name].n_distinct == pytest.approx(row.n_distinct, rel=2 * DISTINCT_ERROR, abs=0.5)
    low, high = _ranks(rows, "every", put["every"].median)
    assert low - 2 * RANK_ERROR <= 0.5 <= high + 2 * RANK_ERROR


def test_nothing_to_profile(spark):
    found = described(merged(column_profile(_rows(spark).limit(0)))).collect()
    assert len(found) == 5
    assert all((r.rows, r.filled, r.null_rate, r.n_distinct, r.median) == (0, 0, 0.0, 0, None) for r in found)


def test_months_together(spark, tmp_path):
    layers = monthly.Layers(str(tmp_path / "lake"))
    with pytest.raises(monthly.StaleMonth):
        monthly.profile_bronze(spark, layers, "2026-01")
    for month, first in (("2026-01", 0), ("2026-02", 20)):
        monthly.publish_bronze(raw_rows(spark, *(sound(n) for n in range(first, first + 30))), layers, month)
        monthly.profile_bronze(spark, layers, month)
    both = {r.column: r for r in monthly.profiles(spark, layers, ["2026-01", "2026-02"]).collect()}
    assert (both["cnpj_basico"].rows, both["cnpj_basico"].n_distinct) == (60, 50)
    assert both["fax"].null_rate == 1.0 and both["municipio"].n_distinct == 1


def test_exact_percentiles_are_not_kept_for_every_value(spark):
    # Before, every distinct value of a column had percentiles of its own, and all rows were sorted by it.
    plan = plan_of(profile_query(spark, "/root/testdata/sf0.001"))
    kept = re.findall(r"(?:ObjectHash|Sort)Aggregate\n(?:.+\n)*?Keys.*?: \[(.*)\]\n(?:.*percentile.*)", plan)
    assert kept and not any(kept)
    found = {r["of"]: r for r in exact_counts(_rows(spark, 600)).collect()}
    assert {name: r.exact for name, r in found.items()} == {"every": 600, "few": 17, "text": 100, "none": 0, "hot": 201}
    assert (found["none"].low, found["hot"].low) == (None, 7.0) and found["every"].low == pytest.approx(0.4867 * 599)
