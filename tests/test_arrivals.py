"""Files as they arrive, each taken once."""

from __future__ import annotations

import pytest

from cartorio.fixed import RAW, Rules
from cartorio.plans import monthly
from cartorio.sources import arrivals
from cartorio.sources.arrivals import arrived, take_arrivals
from support import sound

MONTH = "2026-01"
RULES = Rules(max_corrupt_rate=0.5, min_bronze_rows=1, max_null_rate=0.9)


def _csv(path, rows, damaged=()):
    lines = [";".join(f'"{row.get(n, "")}"' for n in RAW.fieldNames()) for row in rows]
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes("\n".join([*lines, *damaged]).encode("latin-1"))
    return str(path)


def _ids(df):
    return sorted(row.cnpj_basico for row in df.collect())


def test_three_looks_at_a_growing_landing(spark, tmp_path):
    landing, layers = tmp_path / "landing", monthly.Layers(str(tmp_path / "lake"))
    other = monthly.Layers(str(tmp_path / "batch"))
    for turn in range(3):
        _csv(landing / f"day{turn}/a.csv", [sound(10 * turn + n) for n in range(4)], ['"cut";"short"'] * turn)
        _csv(landing / f"day{turn}/b.csv", [sound(10 * turn + n) for n in range(4, 6)])
        taken = monthly.load_arrivals(spark, str(landing), layers, MONTH, RULES)
        batch = monthly.load_bronze(spark, str(landing), other, MONTH, RULES)
        assert _ids(taken) == _ids(batch)
        caught = [monthly.read_quarantine(spark, lake, MONTH) for lake in (layers, other)]
        assert sorted(r.raw_line for r in caught[0].collect()) == sorted(r.raw_line for r in caught[1].collect())
    assert taken.columns == batch.columns and taken.count() == 18


def test_nothing_new_is_nothing_taken(spark, tmp_path):
    landing, folder = tmp_path / "landing", str(tmp_path / "staged")
    _csv(landing / "a.csv", [sound(n) for n in range(5)])
    assert take_arrivals(spark, str(landing), folder) == 5
    assert take_arrivals(spark, str(landing), folder) == 0
    _csv(landing / "b.csv", [sound(9)])
    assert take_arrivals(spark, str(landing), folder) == 1
    assert arrived(spark, folder).count() == 6


@pytest.mark.parametrize("files_a_look", [None, 1])
def test_a_look_that_breaks_off_is_done_again(spark, tmp_path, files_a_look):
    """The sink's rows of a look lie there, but it was never committed: its log has lost the last entry."""
    landing, folder = tmp_path / "landing", tmp_path / "staged"
    for n in range(3):
        _csv(landing / f"{n}.csv", [sound(10 * n + k) for k in range(4)])
    assert take_arrivals(spark, str(landing), str(folder), files_a_look) == 12
    before = _ids(arrived(spark, str(folder)))
    last = max(int(p.name) for p in (folder / "checkpoint/commits").iterdir() if p.name.isdigit())
    for place in ("checkpoint/commits", "rows/_spark_metadata"):
        for name in (f"{last}", f".{last}.crc"):
            (folder / place / name).unlink(missing_ok=True)
    _csv(landing / "3.csv", [sound(99)])
    take_arrivals(spark, str(landing), str(folder), files_a_look)
    assert _ids(arrived(spark, str(folder))) == sorted([*before, "00000099"])


def test_a_refused_month_keeps_what_has_arrived(spark, tmp_path):
    landing, layers = tmp_path / "landing", monthly.Layers(str(tmp_path / "lake"))
    _csv(landing / "a.csv", [sound(1)], ['"x"'] * 9)
    with pytest.raises(Exception, match="mismatch|damaged"):
        monthly.load_arrivals(spark, str(landing), layers, MONTH, RULES)
    _csv(landing / "b.csv", [sound(n) for n in range(2, 40)])
    rules = Rules(max_corrupt_rate=0.5, max_misfit_share=1.0, min_bronze_rows=1, max_null_rate=0.9)
    assert monthly.load_arrivals(spark, str(landing), layers, MONTH, rules).count() == 39
    assert arrivals.STAGED.fieldNames()[-1] == "damaged"
