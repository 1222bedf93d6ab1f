from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartorio.fixed import STATUS_LABELS, TYPE_LABELS
from cartorio.functions.columns import half_even, iso_timestamp, label_of, ratio, registry_id
from cartorio.functions.predicates import check_month, check_snapshot, names_month, names_snapshot


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("code, label", [
    (1, "NULA"), (2, "ATIVA"), (3, "SUSPENSA"), (4, "INAPTA"), (8, "BAIXADA"), (9, "UNKNOWN"),
    (None, "UNKNOWN"),
])
def test_status_labels(spark, code, label):
    assert one(spark, label_of(F.lit(code).cast("int"), STATUS_LABELS)) == label


@pytest.mark.parametrize("code, label", [(1, "Matriz"), (2, "Filial"), (3, "UNKNOWN")])
def test_type_labels(spark, code, label):
    assert one(spark, label_of(F.lit(code), TYPE_LABELS)) == label


def test_id_needs_all_parts(spark):
    rows = spark.createDataFrame(
        [("00000001", "0001", "55"), ("00000001", "0001", None)],
        "cnpj_basico string, cnpj_ordem string, cnpj_dv string",
    )
    assert [r[0] for r in rows.select(registry_id()).collect()] == ["00000001000155", None]


@pytest.mark.parametrize("value, places, expected", [
    (0.125, 2, 0.12), (0.375, 2, 0.38), (0.2389, 2, 0.24), (0.006, 2, 0.01), (2.5, 0, 2.0),
    (-0.1019, 4, -0.1019),
])
def test_rounding_is_half_even(spark, value, places, expected):
    assert one(spark, half_even(F.lit(value), places)) == expected


def test_ratio_without_whole(spark):
    assert one(spark, ratio(F.lit(3), F.lit(0))) == 0.0
    assert one(spark, ratio(F.lit(3), F.lit(None).cast("bigint"))) == 0.0
    assert one(spark, ratio(F.lit(1), F.lit(8))) == 0.125


def test_iso_timestamp(spark):
    assert one(spark, iso_timestamp(F.lit("2026-01-15 03:04:05.678").cast("timestamp"))) == (
        "2026-01-15T03:04:05"
    )


@pytest.mark.parametrize("text", ["2026-01", "2026-12", "2026-01-15"])
def test_snapshot_names(text):
    assert check_snapshot(text) == text


@pytest.mark.parametrize("text", ["", "2026", "2026-13", "2026-02-30", "01-2026", "../2026-01"])
def test_bad_snapshot_names(text):
    with pytest.raises(ValueError):
        check_snapshot(text)


@given(st.text(max_size=12))
@settings(deadline=None)
def test_snapshot_names_are_folder_names(text):
    try:
        check_snapshot(text)
    except ValueError:
        return
    assert all(sign.isdigit() or sign == "-" for sign in text)


def test_run_month_is_a_month():
    assert check_month("2026-01") == "2026-01"
    for text in ("2026-1", "2026-01-15", "2026-00", "2026-13"):
        with pytest.raises(ValueError):
            check_month(text)


@pytest.mark.parametrize("check, names", [(check_snapshot, names_snapshot), (check_month, names_month)])
def test_names_of_a_whole_column(spark, check, names):
    given = [
        "2026-01", "2026-13", "2026-1", "2026-01-31", "2026-02-30", "2024-02-29", "2023-02-29", "2026/01", "", " 2026-01",
        "2026-01\n", "0000-01", "9999-12", "20260101", "2026-01-1", "2026-00", "2026-01-00", "abcd-01", "2026-01-01T00", None,
    ]

    def accepted(text):
        try:
            return check(text) == text
        except (ValueError, TypeError):
            return False

    rows = spark.createDataFrame([(text,) for text in given], "name string").select("name", names("name").alias("ok"))
    assert {row.name: row.ok for row in rows.collect()} == {text: accepted(text) for text in given}
