"""Every registered query against its SQL counterpart in DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from cartorio.operators.conform import curated
from cartorio.operators.measures import type_status_counts
from cartorio.operators.report import compare
from cartorio.plans.oracle import oracle
from cartorio.plans.queries import registered
from cartorio.plans.registry import registry

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def test_every_query_has_its_sql():
    assert set(registered()) == set(oracle())
    assert registered().items() <= queries().items() and oracle().items() <= oracle_sql().items()


@pytest.mark.parametrize("name", registered())
def test_same_rows(spark, duck, name):
    ours = queries()[name](spark, SF)
    theirs = duck.sql(oracle_sql()[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    kinds = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
             "boolean": "BOOLEAN"}
    types = dict(zip(theirs.columns, map(str, theirs.types)))
    assert {name: kinds[kind] for name, kind in ours.dtypes} == types
    rows = [tuple(row) for row in ours.collect()]
    assert rows
    assert _table(ours.columns, rows) == _table(theirs.columns, theirs.fetchall())


def test_entry(spark):
    rows = {tuple(row)[:2]: row["count"] for row in entry(spark).collect()}
    assert len(rows) == 8 and sum(rows.values()) == 22
    assert rows["Matriz", "ATIVA"] == 9 and rows["Filial", "ATIVA"] == 2


def test_golden_snapshots(spark):
    """All rows, then those left when one record in thirteen is gone: just over ten percent less."""
    rows = registry(spark, SF)
    months = {"2026-01": F.lit(True), "2026-02": F.col("record_no") % 13 != 0}
    parts = [
        type_status_counts(curated(rows.filter(kept))).withColumn("dt_ingestion", F.lit(month))
        for month, kept in months.items()
    ]
    row = compare(parts[0].unionByName(parts[1]), "2026-02", "2026-01").first()
    assert (row.previous_total, row.current_total) == (363, 326)
    assert (row.current_matriz_active, row.current_filial_active) == (263, 63)
    assert (row.variance, row.variance_pct, row.within_threshold) == (-0.1019, -10.19, False)
    assert row.previous_ratio_filial_matriz == 0.24


def test_golden_numbers(spark):
    rows = queries()["gold_counts"](spark, SF).collect()
    found = {(r.establishment_type, r.registration_status): r["count"] for r in rows}
    expected = {
        "Matriz": (293, 142, 30, 35, 31, 31), "Filial": (70, 38, 6, 8, 5, 5),
    }
    statuses = ("ATIVA", "BAIXADA", "INAPTA", "NULA", "SUSPENSA", "UNKNOWN")
    assert found == {
        (kind, status): count
        for kind, counts in expected.items()
        for status, count in zip(statuses, counts)
    }
