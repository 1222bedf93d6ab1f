"""Counts of a month that answer for any cities, and take a file again without the others.

A month is counted once by city, type, status and file: a few hundred thousand rows however large the
month, from one scan with partial counts. Counts of any set of cities are sums over them, and a file that
was delivered anew takes the place of its old counts.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartorio.fixed import STATUS_LABELS, TYPE_LABELS
from cartorio.functions.columns import label_of
from cartorio.functions.predicates import curated_scope
from cartorio.operators.measures import GROUP_KEYS

KEYS = ("municipio", "identificador_matriz_filial", "situacao_cadastral")


def file_name(path: str | Column = "source_file") -> Column:
    """What tells a file: its name, wherever it was delivered to."""
    return F.element_at(F.split(path, "/"), -1)


def partial_counts(rows: DataFrame) -> DataFrame:
    """Raw rows (with ``source_file``) by city, type, status and file; nulls are values like others."""
    return rows.withColumn("source_file", file_name()).groupBy(*KEYS, "source_file").agg(
        F.count(F.lit(1)).alias("count")
    )


def renewed(partials: DataFrame, newer: DataFrame, files: Iterable[str]) -> DataFrame:
    """Partial counts with those of the named files replaced; a file without rows now just goes."""
    names = list(files)
    kept = partials if not names else partials.filter(
        F.col("source_file").isNull() | ~F.col("source_file").isin(names)
    )
    return kept.unionByName(newer)


def counts_of(partials: DataFrame, cities: Iterable[str] | None) -> DataFrame:
    """Rows by type and status of some cities (``None``: of all), as counted from the rows themselves."""
    kind, status = GROUP_KEYS
    return partials.filter(curated_scope(cities)).groupBy(
        label_of(F.col("identificador_matriz_filial"), TYPE_LABELS).alias(kind),
        label_of(F.col("situacao_cadastral"), STATUS_LABELS).alias(status),
    ).agg(F.sum("count").alias("count"))
