from __future__ import annotations

import pytest

from cartorio.fixed import Rules
from cartorio.operators import checks
from support import gold_rows, plan_of, raw_rows, silver_rows, sound

SMALL = Rules(min_bronze_rows=2, min_silver_rows=1, max_silver_rows=100)
FEW = Rules(min_silver_rows=1, max_silver_rows=1000, min_ratio=0.0)


def test_input_checks(spark):
    rows = raw_rows(spark, sound(1), sound(2))
    row = checks.input_checks(rows, SMALL).first()
    assert row.has_minimum_records and row.has_required_fields
    # Fields that are never filled: the worst of all columns is judged.
    assert row.worst_null_rate == 1.0 and not row.all_checks_passed
    named = checks.input_checks(rows, SMALL, columns=["municipio", "cnpj_basico"]).first()
    assert named.worst_null_rate == 0.0 and named.all_checks_passed
    assert checks.input_checks(rows, SMALL, columns=["municipio"]).first().all_checks_passed
    assert not checks.input_checks(rows).first().has_minimum_records
    lacking = checks.input_checks(rows.drop("municipio"), SMALL, columns=["cnpj_basico"]).first()
    assert not lacking.has_required_fields and not lacking.all_checks_passed


def test_input_checks_of_nothing(spark):
    row = checks.input_checks(raw_rows(spark, sound(1)).limit(0), SMALL).first()
    assert row.worst_null_rate == 0.0 and row.null_rate_acceptable
    assert not row.has_minimum_records


def test_null_rate_limit_is_inclusive(spark):
    rows = raw_rows(spark, *[sound(n, municipio=None if n == 0 else "7107") for n in range(20)])
    assert checks.input_checks(rows, SMALL, columns=["municipio"]).first().null_rate_acceptable


def test_id_checks(spark):
    row = checks.id_checks(raw_rows(spark, sound(1), sound(2, cnpj_dv=None))).first()
    assert row.null_cnpj_dv == 1 and not row.has_cnpj_dv and row.has_cnpj_basico
    assert not row.all_checks_passed


def business(spark, *rows, rules=FEW):
    return checks.business_checks(silver_rows(spark, *rows), rules).first()


def test_sound_business(spark):
    row = business(spark, {}, {"establishment_type": "Filial"})
    assert row.all_checks_passed and row.filial_matriz_ratio == 1.0


@pytest.mark.parametrize("values, check", [
    ({"municipio": "7108"}, "only_sao_paulo"),
    ({"establishment_type": "UNKNOWN"}, "valid_types"),
    ({"establishment_type": None}, "valid_types"),
    ({"registration_status": "UNKNOWN"}, "valid_statuses"),
    ({"registration_status": None}, "valid_statuses"),
    ({"cnpj_completo": "0" * 13}, "valid_cnpj_format"),
])
def test_one_bad_row_fails_one_check(spark, values, check):
    row = business(spark, {}, values)
    verdicts = {name: row[name] for name in row.asDict() if isinstance(row[name], bool)}
    assert [name for name, good in verdicts.items() if not good] == [check, checks.PASSED]


@pytest.mark.parametrize("values", [
    {"municipio": None}, {"cnpj_completo": None}, {"cnpj_completo": "x" * 14},
])
def test_nulls_and_letters_that_pass(spark, values):
    assert business(spark, {}, values).all_checks_passed


def test_exact_ratio_is_judged(spark):
    rows = [{}] * 1000 + [{"establishment_type": "Filial"}] * 6
    row = business(spark, *rows, rules=Rules(min_silver_rows=1))
    assert row.filial_matriz_ratio == 0.006 and not row.ratio_in_range


def test_business_of_nothing(spark):
    row = checks.business_checks(silver_rows(spark, {}).limit(0)).first()
    assert row.only_sao_paulo and row.valid_types and row.valid_statuses and row.valid_cnpj_format
    assert not row.record_count_in_range and not row.ratio_in_range


@pytest.mark.parametrize("count, good", [(1, False), (2, True), (3, True), (4, False)])
def test_volume_limits_are_inclusive(spark, count, good):
    rules = Rules(min_silver_rows=2, max_silver_rows=3)
    assert business(spark, *[{}] * count, rules=rules).record_count_in_range is good


def test_business_is_one_pass(spark, tmp_path):
    silver_rows(spark, {}).write.parquet(str(tmp_path / "s"))
    plan = plan_of(checks.business_checks(spark.read.parquet(str(tmp_path / "s"))), "simple")
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


ACTIVE = ("Matriz", "ATIVA", 3)


def output(spark, gold, silver_count=3, previous=None):
    silver = silver_rows(spark, *[{}] * 3).limit(silver_count)
    return checks.output_checks(silver, gold, previous).first()


def test_output_without_previous(spark):
    row = output(spark, gold_rows(spark, ACTIVE))
    assert row.all_checks_passed and row.stable_vs_previous


def test_output_mismatch(spark):
    assert not output(spark, gold_rows(spark, ACTIVE), silver_count=2).sum_matches_silver


def test_output_of_nothing(spark):
    row = output(spark, gold_rows(spark, ACTIVE).limit(0), silver_count=0)
    assert row.gold_sum is None and not row.sum_matches_silver
    assert row.no_null_keys and not row.has_active_records


@pytest.mark.parametrize("group", [(None, "ATIVA", 1), ("Matriz", None, 1)])
def test_null_keys(spark, group):
    assert not output(spark, gold_rows(spark, ("Matriz", "ATIVA", 2), group)).no_null_keys


@pytest.mark.parametrize("before, stable", [
    ([("Matriz", "ATIVA", 3)], True),
    ([("Matriz", "ATIVA", 2)], False),
    ([("Matriz", "ATIVA", 0)], True),
    ([("Matriz", "NULA", 9)], True),
])
def test_stability(spark, before, stable):
    row = output(spark, gold_rows(spark, ACTIVE), previous=gold_rows(spark, *before))
    assert row.stable_vs_previous is stable and row.all_checks_passed is stable


def test_stability_limit_is_inclusive(spark):
    gold = gold_rows(spark, ("Matriz", "ATIVA", 110))
    row = output(spark, gold, previous=gold_rows(spark, ("Matriz", "ATIVA", 100)))
    assert row.stable_vs_previous


def test_gate(spark):
    good = spark.createDataFrame([(True,)], f"{checks.PASSED} boolean")
    bad = spark.createDataFrame([(False,)], f"{checks.PASSED} boolean")
    assert checks.run_gate(good, good).first().all_passed
    for pair in ((good, bad), (bad, good), (bad, bad)):
        assert not checks.run_gate(*pair).first().all_passed
    with pytest.raises(checks.CheckFailed, match="the month"):
        checks.require(bad, "the month")
    checks.require(good, "the month")


def test_no_cross_joins(spark):
    silver, gold = silver_rows(spark, {}), gold_rows(spark, ACTIVE)
    for df in (checks.output_checks(silver, gold, gold), checks.reconcile(silver, gold)):
        assert "Join" not in plan_of(df, "simple") and "CartesianProduct" not in plan_of(df)


def test_reconcile(spark):
    silver = silver_rows(spark, {}, {}, {})
    assert checks.reconcile(silver, gold_rows(spark, ACTIVE)).first().matches
    assert not checks.reconcile(silver, gold_rows(spark, ("Matriz", "ATIVA", 2))).first().matches
    assert not checks.reconcile(silver, gold_rows(spark, ACTIVE).limit(0)).first().matches
