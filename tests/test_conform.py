from __future__ import annotations

from pyspark.sql import functions as F

from cartorio.fixed import CURATED_INPUT, CURATED_OUTPUT
from cartorio.operators.conform import active_only, curated, labelled, stamped
from cartorio.operators.lookup import (
    cities_named,
    codes_listed_twice,
    in_named_city,
    unlisted_cities,
    with_city_name,
)
from cartorio.sources.layouts import check_names, describe, pick
from support import gold_rows, plan_of, raw_rows, sound

import pytest


def test_scope(spark):
    rows = raw_rows(
        spark,
        sound(1),
        sound(2, municipio="7108"),
        sound(3, municipio=None),
        sound(4, situacao_cadastral=None),
        sound(5, situacao_cadastral=9),
        sound(6, identificador_matriz_filial=3),
        sound(7, identificador_matriz_filial=None),
        sound(8, identificador_matriz_filial=2),
        sound(9, cnpj_dv=None),
    )
    kept = {r.cnpj_basico: r for r in curated(rows).collect()}
    assert set(kept) == {"00000001", "00000005", "00000008", "00000009"}
    assert kept["00000001"].cnpj_completo == "00000001000155"
    assert kept["00000005"].registration_status == "UNKNOWN"
    assert kept["00000008"].establishment_type == "Filial"
    assert kept["00000009"].cnpj_completo is None
    assert curated(rows).columns == list(CURATED_OUTPUT)


def test_labelling_loses_no_row(spark):
    rows = raw_rows(spark, sound(1, situacao_cadastral=None, identificador_matriz_filial=3))
    row = labelled(rows).first()
    assert (row.registration_status, row.establishment_type) == ("UNKNOWN", "UNKNOWN")


def test_stamp(spark):
    row = stamped(spark.range(1), "2026-01", "ts_ingestion").first()
    assert row.dt_ingestion == "2026-01" and row.ts_ingestion is not None


def test_active_only(spark):
    gold = gold_rows(spark, ("Matriz", "ATIVA", 3), ("Matriz", "NULA", 2), ("Filial", None, 1))
    assert [tuple(r) for r in active_only(gold).collect()] == [("Matriz", "ATIVA", 3)]


def test_pick_keeps_order_and_skips_unknown(spark, caplog):
    rows = raw_rows(spark, sound(1))
    assert pick(rows, ["uf", "nowhere", "cnpj_dv"]).columns == ["uf", "cnpj_dv"]
    assert "nowhere" in caplog.text
    assert pick(rows, None).columns == rows.columns


def test_schema_names(spark):
    names = raw_rows(spark, sound(1)).columns
    check_names([*names, "_corrupt_record"])
    check_names(reversed(names))
    with pytest.raises(ValueError, match="missing"):
        check_names(names[1:])
    with pytest.raises(ValueError, match="extra"):
        check_names([*names, "extra"])


def test_describe(spark):
    rows = describe(raw_rows(spark, sound(1), sound(2, uf="SP"))).collect()
    assert len(rows) == 30 and {r.rows for r in rows} == {2}
    by_name = {r.field: r for r in rows}
    assert [r.field for r in rows if r.required] == ["cnpj_basico", "cnpj_ordem", "cnpj_dv"]
    assert by_name["municipio"].critical and not by_name["municipio"].required
    assert by_name["uf"].filled == 1 and by_name["situacao_cadastral"].type == "int"


@pytest.fixture
def lookup(spark):
    return spark.createDataFrame(
        [("7107", "SAO PAULO"), ("7107", "SAO PAULO"), ("6001", "RIO DE JANEIRO"),
         ("1", "SANTA LUZIA"), ("2", "SANTA LUZIA")],
        "code string, name string",
    )


@pytest.fixture
def towns(spark):
    return raw_rows(
        spark, sound(1), sound(2), sound(3, municipio="1"), sound(4, municipio="2"),
        sound(5, municipio="9999"), sound(6, municipio="9999"), sound(7, municipio=None),
    ).select("cnpj_basico", "municipio")


def test_named_city(towns, lookup):
    # A code listed twice does not double rows of a semi join; a name may stand for two codes.
    assert in_named_city(towns, lookup, "SAO PAULO").count() == 2
    assert in_named_city(towns, lookup, "SANTA LUZIA").count() == 2
    assert in_named_city(towns, lookup, "NOWHERE").count() == 0
    assert [r.code for r in codes_listed_twice(lookup).collect()] == ["7107"]
    assert codes_listed_twice(lookup.distinct()).count() == 0
    named = with_city_name(towns, lookup.distinct())
    # Rows of unlisted and unknown cities stay.
    assert sorted(((r.cnpj_basico[-1], r.city_name) for r in named.collect())) == [
        ("1", "SAO PAULO"), ("2", "SAO PAULO"), ("3", "SANTA LUZIA"), ("4", "SANTA LUZIA"),
        ("5", None), ("6", None), ("7", None),
    ]


def test_unlisted(towns, lookup):
    rows = unlisted_cities(towns, lookup).collect()
    assert {(r.municipio, r["count"]) for r in rows} == {("9999", 2), (None, 1)}


def test_any_number_of_codes_of_a_name(spark, towns, lookup):
    assert sorted(r.municipio for r in cities_named(lookup, "SANTA LUZIA").collect()) == ["1", "2"]
    assert [r.municipio for r in cities_named(lookup, "SAO PAULO").collect()] == ["7107", "7107"]
    many = spark.range(3000).selectExpr("CAST(id AS STRING) code", "'A' name")
    assert in_named_city(towns, many, "A").count() == 2


def test_lookup_is_broadcast_by_size_only(towns, lookup, setting):
    joined = in_named_city(towns, lookup, "SAO PAULO")
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    big = in_named_city(towns, lookup, "SAO PAULO")
    assert "SortMergeJoin" in plan_of(big) and "Broadcast" not in plan_of(big)
    assert sorted(big.collect()) == sorted(joined.collect())


def test_curated_reads_ten_columns_and_pushes_the_scope(spark, tmp_path):
    raw_rows(spark, sound(1), sound(2, municipio="1")).write.parquet(str(tmp_path / "raw"))
    plan = plan_of(curated(spark.read.parquet(str(tmp_path / "raw"))))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    for part in ("EqualTo(municipio,7107)", "IsNotNull(situacao_cadastral)",
                 "In(identificador_matriz_filial, [1,2])"):
        assert part in pushed
    read = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert read.count(":") - 1 == len(CURATED_INPUT)
    assert "Exchange" not in plan


def test_filter_on_labels_would_not_be_pushed(spark, tmp_path):
    """Why the scope is written on the codes."""
    raw_rows(spark, sound(1)).write.parquet(str(tmp_path / "raw"))
    rows = labelled(spark.read.parquet(str(tmp_path / "raw")))
    plan = plan_of(rows.filter(F.col("registration_status") == "ATIVA"))
    assert "EqualTo" not in plan
