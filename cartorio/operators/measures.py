"""Counts and what is derived from them.

The only shuffle is that of partial counts: a group costs one row per task however many rows it
holds, so a type or status with most of the data is no heavier than the others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.fixed import BRANCH, HEADQUARTERS, Rules
from cartorio.functions.columns import count_where, ratio, sum_where
from cartorio.functions.predicates import is_active, is_corrupt

GROUP_KEYS = ("establishment_type", "registration_status")


def side_by_side(*single_rows: DataFrame) -> DataFrame:
    """One-row tables with different columns as one row: stacked, then folded; no join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), single_rows)
    return stacked.agg(*[F.first(name, ignorenulls=True).alias(name) for name in stacked.columns])


def count_by(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def type_status_counts(silver: DataFrame) -> DataFrame:
    """The flagship: rows per establishment type and registration status."""
    return count_by(silver, *GROUP_KEYS)


def grand_total(counts: DataFrame) -> DataFrame:
    """Sum over all groups (null without groups) and the number of groups."""
    return counts.agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("groups"))


def distinct_labels(silver: DataFrame) -> DataFrame:
    """The labels that occur, per label column; read off the counts instead of the rows."""
    pairs = F.array(*[
        F.struct(F.lit(key).alias("column"), F.col(key).alias("label")) for key in GROUP_KEYS
    ])
    return type_status_counts(silver).select(F.inline(pairs)).distinct()


def null_rates(rows: DataFrame) -> DataFrame:
    """Null rate of every column, one row per column, from a single pass of counts; 0 on no rows."""
    wide = rows.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(name).alias(name) for name in rows.columns]
    )
    total, filled = F.col("_rows"), F.col("_filled")
    return wide.unpivot([total], rows.columns, "column", "_filled").select(
        "column", ratio(total - filled, total).alias("null_rate")
    )


def corrupt_rate(scanned: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Rows, damaged rows, their share, and whether the share is acceptable."""
    total = F.count(F.lit(1))
    corrupt = count_where(is_corrupt())
    return scanned.agg(
        total.alias("total"), corrupt.alias("corrupt"), ratio(corrupt, total).alias("corrupt_rate")
    ).withColumn("acceptable", F.col("corrupt_rate") <= rules.max_corrupt_rate)


def quality_metrics(silver: DataFrame) -> DataFrame:
    """Total, headquarters, branches, their ratio and the active rows: one row, from the counts."""
    kind, count = F.col("establishment_type"), F.col("count")
    return type_status_counts(silver).agg(
        sum_where(F.lit(True), count).alias("total_records"),
        sum_where(kind == HEADQUARTERS, count).alias("matriz_count"),
        sum_where(kind == BRANCH, count).alias("filial_count"),
        sum_where(is_active(), count).alias("active_count"),
    ).select(
        "total_records", "matriz_count", "filial_count",
        ratio(F.col("filial_count"), F.col("matriz_count")).alias("filial_matriz_ratio"),
        "active_count",
    )


def quality_distributions(silver: DataFrame) -> DataFrame:
    """Rows by status and rows by type, both from one count by type and status; a row for each label."""
    by_type, by_status = GROUP_KEYS
    sums = type_status_counts(silver).groupingSets(
        [[by_status], [by_type]], *GROUP_KEYS
    ).agg(F.sum("count").alias("count"), F.grouping(by_status).alias("_by_type"))
    return sums.select(
        F.when(F.col("_by_type") == 1, "type").otherwise("status").alias("dimension"),
        F.when(F.col("_by_type") == 1, F.col(by_type)).otherwise(F.col(by_status)).alias("label"),
        "count",
    )
