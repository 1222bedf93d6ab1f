from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from cartorio.operators import measures
from cartorio.operators.report import compare, console_text, printable, summary
from support import gold_rows, plan_of, silver_rows


def test_counts(spark):
    silver = silver_rows(
        spark, {}, {}, {"establishment_type": "Filial"}, {"registration_status": "UNKNOWN"}
    )
    counts = measures.type_status_counts(silver)
    assert {tuple(r) for r in counts.collect()} == {
        ("Matriz", "ATIVA", 2), ("Filial", "ATIVA", 1), ("Matriz", "UNKNOWN", 1),
    }
    assert tuple(measures.grand_total(counts).first()) == (4, 3)
    assert tuple(measures.grand_total(counts.limit(0)).first()) == (None, 0)


def test_counts_shuffle_partial_counts_only(spark):
    plan = plan_of(measures.type_status_counts(silver_rows(spark, {})), "simple")
    assert plan.count("Exchange") == 1
    assert plan.count("HashAggregate") == 2


def test_distinct_labels(spark):
    silver = silver_rows(spark, {}, {"registration_status": None})
    assert {tuple(r) for r in measures.distinct_labels(silver).collect()} == {
        ("establishment_type", "Matriz"), ("registration_status", "ATIVA"),
        ("registration_status", None),
    }


def test_null_rates(spark):
    rows = spark.createDataFrame(
        [(1, None, "x"), (2, None, None), (3, 1, "x"), (4, 1, "x")],
        "_id int, total int, column string",
    )
    assert {tuple(r) for r in measures.null_rates(rows).collect()} == {
        ("_id", 0.0), ("total", 0.5), ("column", 0.25),
    }
    assert {r.null_rate for r in measures.null_rates(rows.limit(0)).collect()} == {0.0}


def test_null_rates_are_one_pass(spark, tmp_path):
    spark.range(5).selectExpr("id AS a", "id AS b", "id AS c").write.parquet(str(tmp_path / "t"))
    plan = plan_of(measures.null_rates(spark.read.parquet(str(tmp_path / "t"))), "simple")
    assert plan.count("FileScan") == 1


def test_quality_metrics(spark):
    silver = silver_rows(
        spark, *[{}] * 8, {"establishment_type": "Filial", "registration_status": "NULA"},
        {"establishment_type": None, "registration_status": None},
    )
    row = measures.quality_metrics(silver).first()
    assert (row.total_records, row.active_count) == (10, 8)
    assert (row.matriz_count, row.filial_count) == (8, 1)
    assert row.filial_matriz_ratio == 0.125
    assert {tuple(cell) for cell in measures.quality_distributions(silver).collect()} == {
        ("status", "ATIVA", 8), ("status", "NULA", 1), ("status", None, 1),
        ("type", "Matriz", 8), ("type", "Filial", 1), ("type", None, 1),
    }


def test_quality_metrics_of_nothing(spark):
    nothing = silver_rows(spark, {}).limit(0)
    assert tuple(measures.quality_metrics(nothing).first()) == (0, 0, 0, 0.0, 0)
    assert measures.quality_distributions(nothing).collect() == []


def test_any_number_of_labels(spark):
    silver = spark.range(10_050).selectExpr(
        "'Matriz' establishment_type", "CAST(id AS STRING) registration_status"
    )
    assert measures.quality_metrics(silver).first().total_records == 10_050
    assert measures.quality_distributions(silver).count() == 10_051
    gold = measures.type_status_counts(silver)
    assert summary(gold).first().total_active == 0
    months = gold.selectExpr("'2026-02' dt_ingestion", "*").unionByName(
        gold.selectExpr("'2026-01' dt_ingestion", "*")
    )
    assert compare(months, "2026-02", "2026-01").first().variance == 0.0


GOLD = (("Matriz", "ATIVA", 293), ("Filial", "ATIVA", 70), ("Matriz", "NULA", 35))


def test_summary(spark):
    row = summary(gold_rows(spark, *GOLD)).first()
    assert (row.matriz_active, row.filial_active, row.total_active) == (293, 70, 363)
    assert row.ratio_filial_matriz == 0.24 and row.ratio_expected


def test_summary_judges_the_rounded_ratio(spark):
    row = summary(gold_rows(spark, ("Matriz", "ATIVA", 1000), ("Filial", "ATIVA", 6))).first()
    assert row.ratio_filial_matriz == 0.01 and row.ratio_expected
    tie = summary(gold_rows(spark, ("Matriz", "ATIVA", 8), ("Filial", "ATIVA", 1))).first()
    assert tie.ratio_filial_matriz == 0.12


def test_summary_without_headquarters(spark):
    row = summary(gold_rows(spark, ("Filial", "ATIVA", 4))).first()
    assert (row.matriz_active, row.total_active, row.ratio_filial_matriz) == (0, 4, 0.0)
    assert not row.ratio_expected


def test_total_active_leaves_out_other_types(spark):
    row = summary(gold_rows(spark, ("UNKNOWN", "ATIVA", 5), ("Matriz", "ATIVA", 1))).first()
    assert row.total_active == 1


def test_printable(spark):
    gold = gold_rows(spark, *GOLD).selectExpr("*", "timestamp'2026-01-15 03:04:05' ts_aggregation")
    assert {r.ts_aggregation for r in printable(gold).collect()} == {"2026-01-15T03:04:05"}


def snapshots(spark, current: int, previous: int):
    return gold_rows(spark, ("Matriz", "ATIVA", current), month="2026-02").unionByName(
        gold_rows(spark, ("Matriz", "ATIVA", previous), ("Matriz", "NULA", 7), month="2026-01")
    )


@pytest.mark.parametrize("current, previous, variance, pct, within", [
    (326, 363, -0.1019, -10.19, False),
    (110, 100, 0.1, 10.0, True),
    (90, 100, -0.1, -10.0, True),
    (111, 100, 0.11, 11.0, False),
    (5, 0, 0.0, 0.0, True),
])
def test_compare(spark, current, previous, variance, pct, within):
    row = compare(snapshots(spark, current, previous), "2026-02", "2026-01").first()
    assert (row.current_total, row.previous_total) == (current, previous)
    assert (row.variance, row.variance_pct, row.within_threshold) == (variance, pct, within)
    assert (row.current_matriz_active, row.previous_matriz_active) == (current, previous)


def test_compare_needs_both_months(spark):
    with pytest.raises(PySparkException, match="nothing to compare"):
        compare(snapshots(spark, 1, 1), "2026-02", "2025-12").select("variance").collect()


def test_console_text(spark):
    row = summary(gold_rows(spark, ("Matriz", "ATIVA", 2_500_000), ("Filial", "ATIVA", 85_000)))
    text = console_text("2026-01", row.first())
    for part in ("2026-01", "2,500,000", "85,000", "2,585,000", "0.03"):
        assert part in text


labels = st.sampled_from(["ATIVA", "NULA", "UNKNOWN", None])
kinds = st.sampled_from(["Matriz", "Filial", None])


@given(st.lists(st.tuples(kinds, labels), min_size=1, max_size=30))
@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
def test_counts_add_up(spark, pairs):
    silver = silver_rows(
        spark, *[{"establishment_type": k, "registration_status": s} for k, s in pairs]
    )
    counts = measures.type_status_counts(silver).collect()
    assert sum(r["count"] for r in counts) == len(pairs)
    assert {(r.establishment_type, r.registration_status): r["count"] for r in counts} == {
        pair: pairs.count(pair) for pair in pairs
    }
