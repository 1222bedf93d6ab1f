"""The registered query of the nearest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.llm.ann import nearest


def op2_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest of every vector whose id is divisible by 20, among all others."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(table, is_query=F.col("vec_id") % 20 == 0)
