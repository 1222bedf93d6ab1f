"""The registered query of the quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartorio.llm.quality_rules import judged


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its figures, and whether it is kept."""
    return judged(spark.read.parquet(f"{sf_dir}/documents.parquet"))
