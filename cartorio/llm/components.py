"""Connected components of a table of edges, in rounds of joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, left: str, right: str, folder: str) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, of every node with an edge but the
    roots themselves. Null ends and loops are left out.

    Alternates large and small stars: neighbours are hung on the smallest neighbour until every node
    hangs on its root. Each round is a written table, so no round is computed again; its two sums over
    the edges tell when nothing changes. Edges never reach the driver.
    """
    spark = edges.sparkSession
    now = edges.select(
        F.greatest(left, right).alias("high"), F.least(left, right).alias("low")
    ).filter("high > low").distinct()
    before, turn = None, 0
    while True:
        path = f"{folder}/stars{turn}"
        now.write.parquet(path)
        now = spark.read.schema(now.schema).parquet(path)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("high", "low") % (1 << 30))).first()
        if state == before:
            return now.select(F.col("high").alias("node"), F.col("low").alias("root"))
        before, turn = state, turn + 1
        now = _small_star(_large_star(now))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are hung on its smallest neighbour (or itself)."""
    both = edges.select(F.col("high").alias("node"), F.col("low").alias("other")).unionAll(
        edges.select(F.col("low").alias("node"), F.col("high").alias("other"))
    )
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    return (
        both.join(least, "node").filter("other > node")
        .select(F.col("other").alias("high"), F.least("least", "node").alias("low")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung on the smallest of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    joined = edges.join(least, "high")
    return joined.select("high", F.col("least").alias("low")).unionAll(
        joined.filter("low > least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    ).distinct()
