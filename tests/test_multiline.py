"""Records that span lines, wherever their files are cut."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from cartorio.fixed import CORRUPT_FIELD, CSV_FORMAT, Rules
from cartorio.plans import monthly
from cartorio.sources.delimited import scan_extract, stage_extract
from cartorio.sources.layouts import RAW_NAMES, scan_schema
from cartorio.sources.multiline import cut_lines, joined, parsed
from support import sound

SHORT = T.StructType().add("id", "string").add("st", T.IntegerType()).add("nm", "string")
RECORDS = [
    '"1";"02";"SÃO ""X"" PAULO"', '"2";"xx";"bad int"', '"3";"08"', '"4";"01";"";"extra"', ';"02";"a\\b"', '"5";"02";',
    '"6";"1";"zwei\nZeilen"', '"7";"1";"drei\n\n""und"" mehr\nZeilen"', '"8";"1";x', '"9";"1";"\n\n\n"', '"a\nb";"1";"c;\nd"',
]


@pytest.fixture
def cut_at(setting):
    def cut(size):
        setting("spark.sql.files.openCostInBytes", "0")
        setting("spark.sql.files.maxPartitionBytes", str(size))

    return cut


def _file(path, records):
    path.write_bytes("\n".join(records).encode("latin-1"))
    return str(path)


def _read(spark, paths, schema=SHORT):
    cut, _ = cut_lines(spark, paths)
    return parsed(cut.filter("whole").select("source_file", "record").unionAll(joined(cut)), schema).drop("source_file")


def _whole(spark, paths):
    """The same by one task a file."""
    return spark.read.schema(scan_schema(SHORT)).options(
        **CSV_FORMAT, columnNameOfCorruptRecord=CORRUPT_FIELD, multiLine="true"
    ).csv(paths)


def _shown(rows):
    return sorted(map(str, rows.collect()))


def test_cuts_at_every_byte(spark, tmp_path, cut_at):
    """Every size of range up to the longest record, so that every byte is where some range ends."""
    path = _file(tmp_path / "a.csv", RECORDS)
    want = _shown(_whole(spark, path))
    assert len(want) == len(RECORDS)
    for size in [1, 2, 3, 5, 7, *range(9, 40, 5), 1000]:
        cut_at(size)
        assert _shown(_read(spark, path)) == want, size


def test_random_records_over_several_files(spark, tmp_path, cut_at):
    rng = random.Random(6)
    field = lambda: '"' + "".join(rng.choice(['\n', '""', ';', 'x', 'é', ' ']) for _ in range(rng.randint(0, 25))) + '"'
    paths = [
        _file(tmp_path / f"{n}.csv", [f'"{n}";"{i}";{field()}' for i in range(60)] + ([""] if n else [])) for n in range(3)
    ]
    want = _shown(_whole(spark, paths))
    for size in (37, 211):
        cut_at(size)
        assert _shown(_read(spark, paths)) == want
    assert len(want) == 180


def test_without_breaks_it_is_the_plain_scan(spark, tmp_path):
    path = _file(tmp_path / "a.csv", RECORDS[:6])
    assert _shown(_read(spark, path)) == _shown(scan_extract(spark, path, SHORT))


def test_carriage_returns_open_quotes_and_nothing(spark, tmp_path, cut_at):
    cut_at(6)
    path = _file(tmp_path / "a.csv", ['"1";"1";"a\r\nb"\r', '"2";"2";"c"\r', ""])
    assert {(r.id, r.nm) for r in _read(spark, path).collect()} == {("1", "a\r\nb"), ("2", "c")}
    open_ = _file(tmp_path / "b.csv", ['"1";"1";"a"', '"2";"2";"never', "closed", '"3"'])
    assert _shown(_read(spark, open_)) == _shown(_whole(spark, open_))  # all that is left is the last field
    assert _read(spark, _file(tmp_path / "c.csv", [])).collect() == []
    with pytest.raises(ValueError, match="no files"):
        cut_lines(spark, [])


def test_a_record_over_many_ranges(spark, tmp_path, cut_at):
    long = "\n".join(f"Zeile {i}" for i in range(200))
    path = _file(tmp_path / "a.csv", ['"1";"1";"a"', f'"2";"2";"{long}"', '"3";"3";"b"'])
    cut_at(100)
    assert {(r.id, r.nm) for r in _read(spark, path).collect()} == {("1", "a"), ("2", long), ("3", "b")}


def test_ranges_cut_otherwise_are_not_taken_for_others(spark, tmp_path, cut_at):
    path = _file(tmp_path / "a.csv", RECORDS)
    cut_at(30)
    cut, _ = cut_lines(spark, path)
    cut_at(20)
    with pytest.raises(Exception, match="byte ranges have changed"):
        cut.collect()


def test_a_month_with_breaks(spark, tmp_path, cut_at):
    cut_at(150)
    line = lambda row: ";".join(f'"{row.get(name, "")}"' for name in RAW_NAMES)
    rows = [line(sound(n, logradouro=f"RUA {n}\nFUNDOS; \n")) for n in range(12)]
    damaged = '"1";"a\nb"'
    path = _file(tmp_path / "a.csv", [*rows[:5], damaged, *rows[5:]])
    layers = monthly.Layers(str(tmp_path / "lake"))
    rules = Rules(max_corrupt_rate=0.5, min_bronze_rows=1)
    bronze = monthly.load_bronze(spark, path, layers, "2026-01", rules, multiline=True)
    assert {r.logradouro for r in bronze.collect()} == {f"RUA {n}\nFUNDOS; \n" for n in range(12)}
    assert [r.raw_line for r in monthly.read_quarantine(spark, layers, "2026-01").collect()] == [damaged]
    staged = stage_extract(spark, path, str(tmp_path / "staged"), multiline=True)
    assert staged.filter("damaged").count() == 1 and staged.count() == 13
