"""Bronze ordered by city: what a scan passes over."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cartorio.fixed import Rules
from cartorio.operators.conform import curated
from cartorio.plans import monthly
from cartorio.sources.versions import MonthTaken, current
from support import raw_rows, sound

MONTH = "2026-01"
RULES = Rules(file_bytes=40_000)


def _rows(spark, n=40_000, crowded=3):
    """A third of all rows in one city, the others in two hundred."""
    return raw_rows(spark, sound(0)).crossJoin(spark.range(n)).select(
        *[c for c in raw_rows(spark, sound(0)).columns if c not in ("cnpj_basico", "municipio")],
        F.format_string("%08d", F.col("id") * 7919 % 99_999_989).alias("cnpj_basico"),
        F.when(F.col("id") % crowded == 0, "7107").otherwise((6000 + F.col("id") % 200).cast("string")).alias("municipio"),
    ).repartition(8)


@pytest.fixture
def layers(spark, tmp_path):
    lake = monthly.Layers(str(tmp_path / "lake"))
    monthly.publish_bronze(_rows(spark), lake, MONTH)
    return lake


def _groups(spark, layers, city):
    """Row groups of the month, and those a scan of one city can't pass over."""
    folder = Path(layers.bronze, current(spark, layers.bronze, MONTH).folder)
    every = needed = 0
    for file in folder.glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        column = meta.schema.names.index("municipio")
        for at in range(meta.num_row_groups):
            stats = meta.row_group(at).column(column).statistics
            every += 1
            needed += stats.min <= city <= stats.max
    return every, needed


def _scanned(df):
    """Rows that the scan of a plan gave to what comes after it."""
    df.write.format("noop").mode("overwrite").save()
    executed = df._jdf.queryExecution()
    leaves = executed.executedPlan().collectLeaves()
    df._jdf.queryExecution().toRdd().count()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_city_is_read_from_few_row_groups(spark, layers):
    before = _groups(spark, layers, "6100")
    assert before[0] == before[1]
    rows = sorted(map(str, monthly.read_bronze(spark, layers, MONTH).drop("ts_ingestion").collect()))
    clustered = monthly.cluster_bronze(spark, layers, MONTH, RULES, group_bytes=10_000)
    assert sorted(map(str, clustered.drop("ts_ingestion").collect())) == rows
    every, needed = _groups(spark, layers, "6100")
    assert every >= 20 and needed <= 0.05 * every + 1
    one = clustered.filter("municipio = '6100'").select("cnpj_basico")
    assert _scanned(one) <= 0.1 * len(rows)


def test_a_crowded_city_spans_ranges(spark, layers):
    monthly.cluster_bronze(spark, layers, MONTH, RULES)
    folder = Path(layers.bronze, current(spark, layers.bronze, MONTH).folder)
    sizes = [pq.ParquetFile(file).metadata.num_rows for file in folder.glob("*.parquet")]
    assert len(sizes) >= 8 and max(sizes) < 2.5 * sum(sizes) / len(sizes)


def test_single_ids_have_a_bloom_filter(spark, layers):
    monthly.cluster_bronze(spark, layers, MONTH, RULES)
    folder = Path(layers.bronze, current(spark, layers.bronze, MONTH).folder)
    file = next(folder.glob("*.parquet"))
    reader = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
            spark._jvm.org.apache.hadoop.fs.Path(str(file)), spark._jsc.hadoopConfiguration()
        )
    )
    try:
        block = reader.getFooter().getBlocks().get(0)
        columns = {c.getPath().toDotString(): c for c in block.getColumns()}
        assert columns["cnpj_basico"].getBloomFilterOffset() >= 0 > columns["municipio"].getBloomFilterOffset()
    finally:
        reader.close()


def test_what_was_built_stays_fresh(spark, layers):
    monthly.build_silver(spark, layers, MONTH)
    monthly.build_gold(spark, layers, MONTH)
    before = sorted(map(str, monthly.read_silver(spark, layers, MONTH).drop("ts_transform").collect()))
    monthly.cluster_bronze(spark, layers, MONTH, RULES)
    monthly.require_fresh(spark, layers, MONTH)
    monthly.build_silver(spark, layers, MONTH)
    assert sorted(map(str, monthly.read_silver(spark, layers, MONTH).drop("ts_transform").collect())) == before


def test_a_run_that_publishes_meanwhile_wins(spark, layers, monkeypatch):
    publish = monthly._publish

    def between(*given):
        monkeypatch.undo()
        monthly.publish_bronze(raw_rows(spark, sound(1)), layers, MONTH)
        return publish(*given)

    monkeypatch.setattr(monthly, "_publish", between)
    with pytest.raises(MonthTaken):
        monthly.cluster_bronze(spark, layers, MONTH, RULES)
    assert monthly.read_bronze(spark, layers, MONTH).count() == 1


def test_nulls_one_row_and_nothing_published(spark, tmp_path):
    lake = monthly.Layers(str(tmp_path / "lake"))
    with pytest.raises(monthly.StaleMonth):
        monthly.cluster_bronze(spark, lake, MONTH)
    monthly.publish_bronze(raw_rows(spark, sound(1, municipio=None), sound(2, cnpj_basico=None), sound(3), sound(3)), lake, MONTH)
    rows = monthly.cluster_bronze(spark, lake, MONTH)
    assert rows.count() == 4 and curated(rows).count() == 3
