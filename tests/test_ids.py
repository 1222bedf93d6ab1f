"""Check digits, ids that occur twice, names as people write them, counts beside their past."""

from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from cartorio.operators.ids import SALTS, check_digits, doubled_ids, id_digit_checks, malformed, wrong_digits
from cartorio.operators.lookup import cities_named_like, in_city_named_like
from cartorio.operators.stability import stability_history
from cartorio.plans import monthly
from support import plan_of, raw_rows, sound


def _digits(stem):
    """By the published rule, a digit at a time."""
    for weights in ([5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2], [6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2]):
        rest = sum((ord(c) - 48) * w for c, w in zip(stem, weights)) % 11
        stem += str(0 if rest < 2 else 11 - rest)
    return stem[-2:]


def test_check_digits(spark):
    rng = random.Random(1)
    stems = ["".join(rng.choice("0123456789") for _ in range(12)) for _ in range(300)]
    stems += ["".join(rng.choice("0123456789ABCXYZ") for _ in range(12)) for _ in range(100)]
    stems += ["000000000000", "999999999999", "112223330001"]
    rows = spark.createDataFrame([(s,) for s in stems], "stem string").select("stem", check_digits(F.col("stem")).alias("d"))
    assert {r.stem: r.d for r in rows.collect()} == {s: _digits(s) for s in stems}
    assert _digits("112223330001") == "81" and _digits("12ABC34501DE") == "35"  # well-known examples


def test_ids_of_every_kind(spark):
    kinds = {
        "11222333000181": (False, False), "12ABC34501DE35": (False, False), "11222333000182": (False, True),
        "11222333000118": (False, True), "1122233300018": (True, False), "112223330001811": (True, False),
        "11222333000l81": (True, False), "112223330001AB": (True, False), "": (True, False), None: (None, None),
        "11222333000181\n": (True, False),
    }
    rows = spark.createDataFrame([(k,) for k in kinds], "cnpj_completo string")
    found = {r.cnpj_completo: (r.m, r.w) for r in rows.select("*", malformed().alias("m"), wrong_digits().alias("w")).collect()}
    assert found == kinds
    row = id_digit_checks(rows).first()
    assert (row.ids, row.null_ids, row.malformed_ids, row.wrong_digits) == (10, 1, 6, 2)
    assert row.bad_rate == 8 / 10 and not row.digits_acceptable and id_digit_checks(rows, most=0.85).first().digits_acceptable
    empty = id_digit_checks(rows.limit(0)).first()
    assert empty.ids == 0 and empty.bad_rate == 0.0 and empty.digits_acceptable


def test_doubled_ids(spark):
    ids = [f"{i:014d}" for i in range(500)] + ["twice"] * 2 + ["often"] * 7 + [None] * 5 + ["", ""]
    rows = spark.createDataFrame([(i,) for i in ids], "cnpj_completo string").repartition(5)
    assert {tuple(r) for r in doubled_ids(rows).collect()} == {("twice", 2), ("often", 7), ("", 2)}
    assert doubled_ids(rows.limit(0)).collect() == []


def test_ids_of_one_hash_are_not_doubled(spark, monkeypatch):
    monkeypatch.setattr("cartorio.operators.ids.F.xxhash64", lambda column: F.length(column).cast("bigint"))
    rows = spark.createDataFrame([("aa",), ("bb",), ("c",), ("dd",), ("dd",)], "cnpj_completo string")
    assert [tuple(r) for r in doubled_ids(rows).collect()] == [("dd", 2)]


def test_an_id_with_a_third_of_all_rows(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = spark.range(60_000).repartition(32).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("%014d", "id")).alias("cnpj_completo")
    )
    found = doubled_ids(rows)
    assert [tuple(r) for r in found.collect()] == [("hot", 20_000)]
    assert "salt#" in plan_of(found, "simple").split("LeftSemi")[1]
    dealt = rows.filter("cnpj_completo = 'hot'").groupBy((F.spark_partition_id() % SALTS).alias("salt")).count().collect()
    assert len(dealt) == SALTS and max(row["count"] for row in dealt) < 3 * 20_000 / SALTS


NAMES = [("1", "São Paulo"), ("2", "SAO  PAULO "), ("3", "Santa Bárbara d'Oeste"), ("4", "Sao Paulo do Potengi"), ("5", None),
         ("6", ""), ("7", "Itapé"), ("8", "Itape"), ("9", "Rio")]


def _lookup(spark, rows=NAMES):
    return spark.createDataFrame(rows, "code string, name string")


@pytest.mark.parametrize("asked,codes", [
    ("sao paulo", {"1", "2"}), (" SÃO   Paulo", {"1", "2"}), ("SANTA BARBARA D'OESTE", {"3"}), ("Paulo", set()), ("", {"6"}),
])
def test_names_as_people_write_them(spark, asked, codes):
    assert {r.municipio for r in cities_named_like(_lookup(spark), asked).collect()} == codes


def test_a_run_takes_the_name_that_is_meant(spark):
    def codes(name):
        return {r.municipio for r in monthly.named_cities(_lookup(spark), name).collect()}

    assert codes("Itape") == {"8"} and codes("RIO") == {"9"} and codes("São Paulo") == {"1"}
    with pytest.raises(ValueError, match="no city named 'ITAPE' in the lookup, but"):
        codes("ITAPE")
    with pytest.raises(ValueError, match="no city"):
        codes("Nowhere")


def test_filters_still_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    raw_rows(spark, *(sound(n, municipio=str(n % 3)) for n in range(9))).write.parquet(path)
    from cartorio.operators.conform import curated

    rows = in_city_named_like(spark.read.parquet(path), _lookup(spark), "sao paulo")
    plan = plan_of(curated(rows, None))
    assert "IsNotNull(situacao_cadastral)" in plan and "In(identificador_matriz_filial, [1,2])" in plan
    assert "collate" not in plan.lower().split("scan parquet")[0].split("filter")[0]
    assert {r.municipio for r in rows.collect()} == {"1", "2"}


# --- counts beside their past ---------------------------------------------------------------------

HISTORY = "dt_ingestion string, establishment_type string, registration_status string, count bigint"


def _history(spark, counts, **how):
    rows = [(month, "Matriz", "ATIVA", n) for month, n in counts]
    found = stability_history(spark.createDataFrame(rows, HISTORY), **how)
    return {r.dt_ingestion: r for r in found.collect()}


def test_first_months_and_a_fault(spark):
    counts = [(f"2025-{m:02d}", 1000 + 10 * (m % 3)) for m in range(1, 12)] + [("2025-12", 1500)]
    found = _history(spark, counts)
    assert [found[m].n_past for m, _ in counts] == list(range(12))
    assert all(found[m].stable for m, _ in counts[:-1]) and not found["2025-12"].stable
    past = [n for _, n in counts[:-1]]
    median = statistics.median(past)
    assert found["2025-12"].median == median
    assert found["2025-12"].deviation == statistics.median(abs(n - median) for n in past)
    assert found["2025-01"].median is None and found["2025-01"].gap_months == 0


def test_a_season_is_no_fault_where_two_months_would_say_so(spark):
    counts = [(f"2025-{m:02d}", [1000, 1100, 1200, 1300, 1200, 1100][m % 6]) for m in range(1, 13)]
    assert all(row.stable for row in _history(spark, counts, least=4).values())


def test_gaps_equal_values_and_nulls(spark):
    found = _history(spark, [("2024-11", 5), ("2025-01", 5), ("2025-02", 5), ("2025-03", None), ("2025-06-15", 5), ("2025-07", 9)])
    assert len(found) == 5 and found["2025-01"].gap_months == 1 and found["2025-06-15"].gap_months == 3
    assert found["2025-06-15"].stable and found["2025-06-15"].deviation == 0.0
    assert not found["2025-07"].stable  # nothing ever moved
    assert _history(spark, []) == {}


def test_only_the_last_months_count(spark):
    counts = [(f"{2020 + m // 12}-{m % 12 + 1:02d}", 100 if m < 30 else 200) for m in range(60)]
    found = _history(spark, counts)
    assert not found["2022-07"].stable and found["2024-12"].stable and found["2024-12"].median == 200.0
    assert max(row.n_past for row in found.values()) == 12
