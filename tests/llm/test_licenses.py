from __future__ import annotations

import random
import re

import duckdb
import pytest

from cartorio.llm.license_queries import SQL, op1_license_scan
from cartorio.llm.licenses import NOTICES, ScanSettings, license_notices

MIT, LONG_MIT = NOTICES[0][1], NOTICES[2][1]


def _docs(spark, rows):
    return spark.createDataFrame(
        [(*row, "x", 1) for row in rows], "doc_id bigint, text string, license string, begin int"
    )


def _filler(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))


def test_notices_in_texts(spark):
    rng = random.Random(1)
    words = LONG_MIT.split()
    rows = [
        (1, f"{_filler(rng, 300)}\n{MIT}\n{_filler(rng, 5)}"), (2, MIT.upper()),
        (3, f"{_filler(rng, 7)} {LONG_MIT} {_filler(rng, 900)} {MIT}"),
        (4, " ".join([*words[:30], "strange", *words[31:]])),  # one word changed: some shingles gone
        (5, " ".join(words[: len(words) // 2])), (6, "Released under the"), (7, None), (8, ""),
        (9, f"{_filler(rng, 60_000)} {NOTICES[5][1]}"), (10, "free of charge to any person"),
        (None, MIT), (1, "again"), *((i, f"{_filler(rng, 40)} {text}") for i, (_, text) in enumerate(NOTICES, 100)),
    ]
    found = license_notices(_docs(spark, rows))
    assert found.columns == ["doc_id", "license", "containment", "begin_word"]
    got = {(r.doc_id, r.license): r.containment for r in found.collect()}
    assert got[1, "MIT"] == got[2, "MIT"] == got[3, "MIT"] == got[None, "MIT"] == got[9, "GPL-3.0"] == 1.0
    assert 0.8 <= got[4, "MIT"] < 1
    assert not {5, 6, 7, 8, 10} & {key for key, _ in got}
    for i, (name, _) in enumerate(NOTICES, 100):
        assert got[i, name] == 1.0


@pytest.mark.parametrize("offset", [0, 1, 7, 8, 9, 63, 64, 65, 127])
def test_a_notice_lies_whole_in_some_window(spark, offset):
    text = f"{_filler(random.Random(offset), offset)} {LONG_MIT} tail words of the text"
    assert license_notices(_docs(spark, [(1, text)])).first().containment == 1.0


def test_empty_table_and_no_notices(spark):
    assert license_notices(_docs(spark, [(1, MIT)]).limit(0)).collect() == []
    assert license_notices(_docs(spark, [(1, MIT)]), notices=[("none", "too short")]).collect() == []


def test_bands_reach_the_wanted_probability():
    for rows in (1, 2):
        settings = ScanSettings(rows=rows)
        missed = (1 - settings.least_jaccard**rows) ** settings.bands
        assert missed <= 1 - settings.collision


def test_plan_has_no_python(spark):
    from support import plan_of

    plan = plan_of(op1_license_scan(spark, "/root/testdata/sf0.001"))
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_same_as_sql(spark, folder):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    query = duck.sql(SQL["op1_license_scan"])
    ours = op1_license_scan(spark, folder)
    assert ours.columns == query.columns
    got = sorted(map(tuple, ours.collect()))
    assert got and got == sorted(query.fetchall())


def test_each_notice_alone_is_its_own_license(spark):
    """Also those that differ from another's by a word."""
    words = " ".join(f"plain{i}" for i in range(90))
    docs = spark.createDataFrame(
        [(n, f"{words} {text} {words}") for n, (_, text) in enumerate(NOTICES)], "doc_id bigint, text string"
    )
    found = {}
    for row in license_notices(docs).collect():
        found.setdefault(row.doc_id, set()).add(row.license)
    assert found == {n: {name} for n, (name, _) in enumerate(NOTICES)}


def test_two_notices_nearly_alike_in_two_places(spark):
    gpl = {name: text for name, text in NOTICES if name in ("GPL-2.0", "GPL-3.0") and text.startswith("it under")}
    gap = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame([
        (1, f"{gpl['GPL-2.0']} {gap} {gpl['GPL-3.0']}"), (2, f"{gpl['GPL-2.0']} {gpl['GPL-3.0']}"), (3, gpl["GPL-3.0"]),
    ], "doc_id bigint, text string")
    found = {}
    for row in license_notices(docs).collect():
        found.setdefault(row.doc_id, set()).add(row.license)
    assert found == {1: {"GPL-2.0", "GPL-3.0"}, 2: {"GPL-2.0", "GPL-3.0"}, 3: {"GPL-3.0"}}
