"""What the plans of the registered queries must and must not hold."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cartorio.plans.queries import registered as queries
from cartorio.operators.lookup import in_named_city, with_city_name
from support import plan_of

SF = "/root/testdata/sf0.001"
FILES = {"corrupt_rate", "csv_roundtrip", "csv_quarantine", "layer_roundtrip", "layer_comparison",
         "monthly_run", "monthly_full", "monthly_rerun", "archive_manifest", "archive_ingest"}
PLAIN = sorted(set(queries()) - FILES)


@pytest.mark.parametrize("name", PLAIN)
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "MapInArrow", "CollectLimit"):
        assert bad not in plan


@pytest.mark.parametrize("name", PLAIN)
def test_scans_read_what_is_used(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    for line in plan.splitlines():
        if line.startswith("ReadSchema"):
            # Never used by any query: total price, order status and account balance.
            assert not re.search("o_totalprice|o_orderstatus|c_acctbal", line)


@pytest.mark.parametrize("name", ["gold_counts", "business_checks", "null_rates", "id_checks"])
def test_one_scan_of_the_big_table_and_one_shuffle(spark, name):
    plan = plan_of(queries()[name](spark, SF), "simple")
    assert len(re.findall(r"FileScan parquet \[o_", plan)) == 1
    assert len(re.findall(r"Exchange (hashpartitioning|SinglePartition)", plan)) == 1


@pytest.mark.parametrize("name", [
    "output_checks", "output_checks_first", "reconciliation", "run_gate", "quality_metrics",
    "quality_distributions", "compare_snapshots", "summary_report",
])
def test_one_scan_and_two_shuffles_of_counts(spark, name):
    """Cells, then one row (or one row a label) out of them; nothing collected into an array."""
    plan = plan_of(queries()[name](spark, SF), "simple")
    assert len(re.findall(r"FileScan parquet \[o_", plan)) == 1
    assert len(re.findall(r"Exchange (hashpartitioning|SinglePartition)", plan)) == 2
    assert "collect_list" not in plan and "Limit" not in plan


def test_silver_does_not_shuffle(spark):
    plan = plan_of(queries()["silver_rows"](spark, SF), "simple")
    assert not re.search(r"Exchange (hash|range|Single|RoundRobin)", plan)


def test_library_forces_nothing():
    """No broadcast hints, no cross joins, no local checkpoints, no row-at-a-time functions."""
    for file in Path(__file__).resolve().parent.parent.glob("cartorio/**/*.py"):
        if "llm" in file.parts:  # its rules are its own
            continue
        code = file.read_text()
        assert not re.search(r"tempfile|\bllm\b", code), file
        assert not re.search(
            r"broadcast\(|crossJoin|localCheckpoint|F\.udf|\.rdd|toPandas|\.cache\(", code
        ), file


@pytest.mark.parametrize("join", ["semi", "named"])
def test_a_crowded_city_is_split(spark, tmp_path, setting, join):
    """A third of all rows in one city, and a lookup too big to broadcast."""
    rows = spark.range(0, 300_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "7107").otherwise((F.col("id") % 997).cast("string"))
        .alias("municipio"),
        F.sha2(F.col("id").cast("string"), 256).alias("cnpj_completo"),
    )
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    spark.range(8000).selectExpr("CAST(id AS STRING) code", "'A' name").write.parquet(
        str(tmp_path / "lookup")
    )
    lookup = spark.read.parquet(str(tmp_path / "lookup"))

    def crossed():
        joined = in_named_city(rows, lookup, "A") if join == "semi" else with_city_name(rows, lookup)
        return joined.agg(F.count("*").alias("n"), F.sum(F.xxhash64("cnpj_completo") % 1000))

    expected = crossed().first()
    assert expected.n == 300_000
    for name, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "500k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500k",
        "spark.sql.shuffle.partitions": "16",
    }.items():
        setting(name, value)
    split = crossed()
    assert split.collect() == [expected]
    assert "skew=true" in plan_of(split, "simple")
