"""Counts by file: any cities, one file again, and what they rest on."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cartorio.fixed import RAW, Rules
from cartorio.operators.conform import curated
from cartorio.operators.measures import type_status_counts
from cartorio.operators.partials import counts_of, partial_counts, renewed
from cartorio.plans import monthly
from cartorio.sources.versions import MonthTaken
from support import plan_of, sound

MONTH = "2026-01"
RULES = Rules(max_corrupt_rate=0.5, min_bronze_rows=1, max_null_rate=0.9, min_silver_rows=1)


def _csv(path, rows, damaged=()):
    names = RAW.fieldNames()
    lines = [";".join(f'"{"" if row.get(n) is None else row[n]}"' for n in names) for row in rows]
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes("\n".join([*lines, *damaged]).encode("latin-1"))
    return str(path)


def _rows(first, n, **values):
    return [sound(i, municipio=str(7100 + i % 5), identificador_matriz_filial=1 + i % 3, **values) for i in range(first, first + n)]


@pytest.fixture
def lake(spark, tmp_path):
    layers = monthly.Layers(str(tmp_path / "lake"))
    files = [_csv(tmp_path / f"one/E{n}.csv", _rows(100 * n, 30)) for n in range(3)]
    monthly.load_bronze(spark, files, layers, MONTH, RULES)
    monthly.build_partials(spark, layers, MONTH)
    return layers


def _seen(df):
    return sorted(map(tuple, df.collect()))


def _from_rows(spark, layers, cities):
    return _seen(type_status_counts(curated(monthly.read_bronze(spark, layers, MONTH), cities)))


@pytest.mark.parametrize("cities", [("7101",), ("7101", "7104"), (), ("none",), None])
def test_any_cities_as_counted_from_the_rows(spark, lake, cities):
    assert _seen(monthly.gold_from_partials(spark, lake, MONTH, cities)) == _from_rows(spark, lake, cities)


def test_bronze_is_not_scanned(spark, lake):
    plan = plan_of(monthly.gold_from_partials(spark, lake, MONTH, ("7101",)))
    assert "/partials/" in plan and "/bronze/" not in plan and "In(municipio" in plan or "EqualTo(municipio" in plan


def test_a_file_again_equals_a_rebuild(spark, lake, tmp_path):
    again = _csv(tmp_path / "two/E1.csv", _rows(500, 7), ['"cut";"short"'])
    monthly.replace_files(spark, again, lake, MONTH, RULES)
    assert monthly.read_bronze(spark, lake, MONTH).count() == 67
    merged = {cities: _seen(monthly.gold_from_partials(spark, lake, MONTH, cities)) for cities in (("7101",), None)}
    monthly.build_partials(spark, lake, MONTH)
    for cities, counts in merged.items():
        assert counts == _seen(monthly.gold_from_partials(spark, lake, MONTH, cities)) == _from_rows(spark, lake, cities)
    assert [r.raw_line for r in monthly.read_quarantine(spark, lake, MONTH).collect()] == ['"cut";"short"']
    # And once more, from what the replacement left.
    monthly.replace_files(spark, _csv(tmp_path / "three/E0.csv", _rows(700, 1)), lake, MONTH, RULES)
    assert monthly.read_bronze(spark, lake, MONTH).count() == 38
    assert _seen(monthly.gold_from_partials(spark, lake, MONTH, None)) == _from_rows(spark, lake, None)


def test_counts_of_another_bronze_are_refused(spark, lake, tmp_path):
    monthly.load_bronze(spark, _csv(tmp_path / "new/E0.csv", _rows(0, 3)), lake, MONTH, RULES)
    with pytest.raises(monthly.StaleMonth):
        monthly.gold_from_partials(spark, lake, MONTH, None)
    monthly.replace_files(spark, _csv(tmp_path / "new2/E7.csv", _rows(9, 3)), lake, MONTH, RULES)
    with pytest.raises(monthly.StaleMonth):  # nothing to merge into
        monthly.gold_from_partials(spark, lake, MONTH, None)
    monthly.build_partials(spark, lake, MONTH)
    assert _seen(monthly.gold_from_partials(spark, lake, MONTH, None)) == _from_rows(spark, lake, None)


def test_a_clustered_month_stays_counted(spark, lake):
    before = _seen(monthly.gold_from_partials(spark, lake, MONTH, None))
    monthly.cluster_bronze(spark, lake, MONTH)
    assert _seen(monthly.gold_from_partials(spark, lake, MONTH, None)) == before


def test_a_damaged_file_changes_nothing(spark, lake, tmp_path):
    before = _seen(monthly.gold_from_partials(spark, lake, MONTH, None))
    with pytest.raises(Exception, match="damaged|no usable"):
        monthly.replace_files(spark, _csv(tmp_path / "bad/E1.csv", [], ['"x"'] * 5), lake, MONTH, RULES)
    assert _seen(monthly.gold_from_partials(spark, lake, MONTH, None)) == before


def test_two_files_at_once(spark, lake, tmp_path, monkeypatch):
    """Of two files replaced from the same version the second is refused, not lost."""
    publish = monthly._publish

    def between(*given):
        monkeypatch.undo()
        monthly.replace_files(spark, _csv(tmp_path / "b/E2.csv", _rows(900, 2)), lake, MONTH, RULES)
        return publish(*given)

    monkeypatch.setattr(monthly, "_publish", between)
    with pytest.raises(MonthTaken):
        monthly.replace_files(spark, _csv(tmp_path / "a/E1.csv", _rows(800, 2)), lake, MONTH, RULES)
    assert monthly.read_bronze(spark, lake, MONTH).count() == 62
    assert _seen(monthly.gold_from_partials(spark, lake, MONTH, None)) == _from_rows(spark, lake, None)


ROW = st.tuples(
    st.sampled_from(["7107", "6001", None]), st.sampled_from([1, 2, 3, None]), st.sampled_from([2, 8, 9, None]),
    st.sampled_from(["x/a", "y/a", "b", None]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, max_size=20), st.lists(ROW, max_size=8))
def test_merged_counts_equal_counts_of_merged_rows(spark, old, new):
    schema = "municipio string, identificador_matriz_filial int, situacao_cadastral int, source_file string"
    new = [(*row[:3], "z/a") for row in new]
    kept = [row for row in old if row[3] is None or not row[3].endswith("a")]
    merged = renewed(partial_counts(spark.createDataFrame(old, schema)), partial_counts(spark.createDataFrame(new, schema)), ["a"])
    whole = partial_counts(spark.createDataFrame(kept + new, schema))
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))
    assert _seen(counts_of(merged, ("7107",))) == _seen(counts_of(whole, ("7107",)))
