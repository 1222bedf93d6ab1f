"""Which files a snapshot needs, and which of them have arrived."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.fixed import ARCHIVES, PARTITION


def expected_files(snapshots: DataFrame, kinds: Iterable[str] = tuple(ARCHIVES)) -> DataFrame:
    """One row per snapshot and file it needs: ten numbered extracts and the city lookup."""
    files = [
        F.struct(F.lit(kind).alias("file_type"), F.lit(name).alias("file_name"))
        for kind in kinds
        for name in ARCHIVES[kind]
    ]
    return snapshots.select(PARTITION).distinct().select(PARTITION, F.inline(F.array(*files)))


def landed_files(spark: SparkSession, folder: str, pattern: str = "*.zip") -> DataFrame:
    """Files under a folder; only the listing is read, not the contents. An empty file has not
    landed yet and is left out."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", F.col("length").alias("bytes"))
    )


def classified(landed: DataFrame) -> DataFrame:
    """Landed files with the snapshot (their folder), their name and what they hold.

    The lookup has another layout than the extracts; read with theirs it would enter bronze as
    damaged rows. Files of unknown name get no type.
    """
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    kind = F.coalesce(*[F.when(name.isin(names), kind) for kind, names in ARCHIVES.items()])
    return landed.withColumns({
        PARTITION: F.element_at(parts, -2), "file_name": name, "file_type": kind,
    })


def expected_of(spark: SparkSession, month: str, kinds: Iterable[str] = tuple(ARCHIVES)) -> DataFrame:
    """The files that one month needs, whether or not anything of it has landed."""
    return expected_files(spark.range(1).select(F.lit(month).alias(PARTITION)), kinds)


def doubled_files(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected files that are there more than once, with the number of times."""
    copies = landed.groupBy(PARTITION, "file_name").agg(F.count(F.lit(1)).alias("copies"))
    return expected.join(copies.filter("copies > 1"), [PARTITION, "file_name"])


def missing_files(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected files that are not there."""
    return expected.join(
        landed.select(PARTITION, "file_name").distinct(), [PARTITION, "file_name"], "left_anti"
    )
