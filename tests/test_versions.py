"""Versions of a month: what readers see while runs write, break off and meet."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

from cartorio.operators.conform import stamped
from cartorio.plans import monthly
from cartorio.sources import versions
from cartorio.sources.layers import read_month, stage_rows, write_month
from cartorio.sources.layouts import GOLD
from cartorio.sources.versions import MonthTaken, Record
from support import gold_rows

MONTH = "2026-01"


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "gold")


def _rows(spark, count):
    return stamped(gold_rows(spark, ("Matriz", "ATIVA", count)), MONTH, "ts_aggregation")


def _write(spark, root, count, **how):
    return write_month(_rows(spark, count), root, MONTH, GOLD, **how)


def _seen(spark, root, version=None):
    return [row["count"] for row in read_month(spark, root, MONTH, GOLD, version=version).collect()]


def test_a_reader_keeps_the_version_it_began_with(spark, root):
    before = _write(spark, root, 1)
    _write(spark, root, 2)
    assert [row["count"] for row in before.collect()] == [1]
    assert _seen(spark, root) == [2] and _seen(spark, root, 1) == [1]
    assert [record.version for record in versions.history(spark, root, MONTH)] == [1, 2]
    assert versions.months(spark, root) == [MONTH]


def test_whichever_step_breaks_off_the_month_stays(spark, root, monkeypatch):
    _write(spark, root, 1)

    def lost(*_, **__):
        raise OSError("lost")

    for module, name in ((versions, "commit"), (versions, "_create")):
        monkeypatch.setattr(module, name, lost)
        with pytest.raises(OSError):
            _write(spark, root, 2)
        monkeypatch.undo()
        assert _seen(spark, root) == [1]
        assert len(list(Path(root, f"dt_ingestion={MONTH}").iterdir())) == 1
    with pytest.raises(Exception):  # the rows themselves fail
        write_month(_rows(spark, 2).selectExpr("*", "1/0 AS x").filter("raise_error('lost') IS NULL"), root, MONTH, GOLD)
    assert _seen(spark, root) == [1]
    _write(spark, root, 3)
    assert _seen(spark, root) == [3]


def test_a_record_that_was_never_filled_is_passed_over(spark, root):
    """The writer died between creating and filling its record, or has only just created it."""
    _write(spark, root, 1)
    Path(root, "_log", MONTH, "000000000002.json").touch()
    assert _seen(spark, root) == [1] and versions.head(spark, root, MONTH) == 2
    _write(spark, root, 3)
    assert _seen(spark, root) == [3] and versions.current(spark, root, MONTH).version == 3


def test_compare_and_set(spark, root):
    _write(spark, root, 1)
    base = versions.head(spark, root, MONTH)
    with versions.pending(spark, root, MONTH) as first, versions.pending(spark, root, MONTH) as second:
        for version, count in ((first, 5), (second, 6)):
            stage_rows(_rows(spark, count), version.path, GOLD, 1 << 20)
        second.commit(Record(second.run))
        with pytest.raises(MonthTaken):
            first.commit(Record(first.run))
    assert _seen(spark, root) == [6]
    with pytest.raises(MonthTaken):
        _write(spark, root, 7, base=base)
    assert len(list(Path(root, f"dt_ingestion={MONTH}").iterdir())) == 2


def test_one_name_is_created_once(spark, tmp_path):
    path = str(tmp_path / "log" / "1.json")
    assert versions._create(spark, path, "a") and not versions._create(spark, path, "b")
    assert Path(path).read_text() == "a"


def test_expired_versions_go_and_the_last_stay(spark, root):
    for count in range(1, 5):
        _write(spark, root, count)
    stray = Path(root, f"dt_ingestion={MONTH}", "run=stray")
    stray.mkdir()
    gone = versions.expire(spark, root, MONTH, keep=2)
    assert len(gone) == 2 and stray.exists()
    assert _seen(spark, root) == [4] and _seen(spark, root, 3) == [3]
    os.utime(stray, (0, 0))
    assert versions.expire(spark, root, MONTH, keep=2) == [f"{root}/dt_ingestion={MONTH}/run=stray"]
    assert [record.version for record in versions.history(spark, root, MONTH)] == [3, 4]


def test_no_job_runs_for_the_log(spark, root):
    _write(spark, root, 1)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("log", "log")
    try:
        versions.current(spark, root, MONTH)
        versions.commit(spark, root, MONTH, Record("x", folder="x"), 1)
        assert not tracker.getJobIdsForGroup("log")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_expiring_a_month_keeps_what_it_holds(spark, tmp_path):
    from support import raw_rows, sound

    layers = monthly.Layers(str(tmp_path / "lake"))
    for n in (3, 4, 5):
        monthly.publish_bronze(raw_rows(spark, *(sound(i) for i in range(n))), layers, MONTH)
        monthly.build_silver(spark, layers, MONTH)
        monthly.build_gold(spark, layers, MONTH)
    assert len(monthly.expire_versions(spark, layers, MONTH, keep=1)) == 6
    assert monthly.read_silver(spark, layers, MONTH).count() == 5
    monthly.require_fresh(spark, layers, MONTH)


def test_expiring_keeps_the_quarantine_of_what_was_laid_out_anew(spark, tmp_path):
    from cartorio.fixed import RAW, Rules
    from support import sound

    path, rules = tmp_path / "a.csv", Rules(max_corrupt_rate=0.5, min_bronze_rows=1, max_null_rate=0.9)
    lines = [";".join(f'"{sound(n).get(name, "")}"' for name in RAW.fieldNames()) for n in range(5)]
    layers = monthly.Layers(str(tmp_path / "lake"))
    for damaged in ('"first"', '"second"'):
        path.write_text("\n".join([*lines, damaged]))
        monthly.load_bronze(spark, str(path), layers, MONTH, rules)
    monthly.cluster_bronze(spark, layers, MONTH)
    assert len(monthly.expire_versions(spark, layers, MONTH, keep=1)) == 2
    assert monthly.read_bronze(spark, layers, MONTH).count() == 5
    assert [r.raw_line for r in monthly.read_quarantine(spark, layers, MONTH).collect()] == ['"second"']
    assert len(list(Path(layers.quarantine, f"dt_ingestion={MONTH}").iterdir())) == 1


def test_a_reader_never_finds_the_month_missing(spark, root):
    """A process of its own lists the log and opens what it names, while versions are written."""
    _write(spark, root, 0)
    reader = subprocess.Popen([sys.executable, "-c", f"""
import json, os, time
log, seen, until = {root!r} + "/_log/{MONTH}", set(), time.time() + 60
while time.time() < until and not os.path.exists({root!r} + "/over"):
    names = sorted(n for n in os.listdir(log) if n.endswith(".json") and not n.startswith("."))
    for name in reversed(names):
        text = open(log + "/" + name).read()
        if text:
            break
    record = json.loads(text)
    files = [n for n in os.listdir({root!r} + "/" + record["folder"]) if n.endswith(".parquet")]
    assert files, record
    seen.add(record["version"])
print(len(seen))
"""], stdout=subprocess.PIPE, text=True)
    for count in range(1, 5):
        _write(spark, root, count)
    Path(root, "over").touch()
    assert int(reader.communicate(timeout=90)[0]) >= 2 and reader.returncode == 0
