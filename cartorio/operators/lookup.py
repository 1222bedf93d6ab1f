"""Crossing registry rows with the city lookup.

No join here is forced to broadcast. The lookup is a few thousand rows, so the optimizer broadcasts
it by its measured size (``spark.sql.autoBroadcastJoinThreshold``); a lookup beyond that goes
through a shuffle join, where adaptive execution splits the partitions of crowded cities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_named_city(rows: DataFrame, lookup: DataFrame, name: str) -> DataFrame:
    """Rows of the cities with this name; a city listed twice does not double them."""
    return rows.join(cities_named(lookup, name), "municipio", "left_semi")


def with_city_name(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """All rows with the city's name; null for an unlisted or unknown city.

    A code listed twice doubles its rows; ``codes_listed_twice`` tells, and a run refuses such a
    lookup. Folding the lookup to one row per code inside the query would put an aggregate between
    the join and its shuffle, and then adaptive execution no longer splits crowded cities.
    """
    names = lookup.select(F.col("code").alias("municipio"), F.col("name").alias("city_name"))
    return rows.join(names, "municipio", "left")


def codes_listed_twice(lookup: DataFrame) -> DataFrame:
    """City codes with more than one row in the lookup."""
    return lookup.groupBy("code").count().filter("count > 1")


def cities_named(lookup: DataFrame, name: str) -> DataFrame:
    """The codes behind a city name, as a table to semi-join with; a code may be there twice.

    Not made distinct: an aggregate before the join would keep crowded cities from being split.
    """
    return lookup.filter(F.col("name") == name).select(F.col("code").alias("municipio"))


def tidy(name: str | Column) -> Column:
    """A name without blanks around it and with one between words."""
    return F.trim(F.regexp_replace(name, r"\s+", " "))


def cities_named_like(lookup: DataFrame, name: str) -> DataFrame:
    """``municipio`` and ``name`` of the cities whose name is the same but for accents, case and blanks.

    Names are compared under a collation, and only on the lookup's side: rows are then joined by code,
    so the filters on them still reach the scan.
    """
    asked = F.collate(tidy(F.lit(name)), "UNICODE_CI_AI")
    return lookup.filter(F.collate(tidy("name"), "UNICODE_CI_AI") == asked).select(
        F.col("code").alias("municipio"), "name"
    )


def in_city_named_like(rows: DataFrame, lookup: DataFrame, name: str) -> DataFrame:
    """Rows of the cities of such a name."""
    return rows.join(cities_named_like(lookup, name).select("municipio"), "municipio", "left_semi")


def unlisted_cities(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """City codes absent from the lookup, with their rows; counted first, so few rows are joined."""
    totals = rows.groupBy("municipio").agg(F.count(F.lit(1)).alias("count"))
    return totals.join(lookup.select(F.col("code").alias("municipio")), "municipio", "left_anti")
