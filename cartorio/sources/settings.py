"""Session settings that hold for one write; other threads of the session see them meanwhile."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def unsorted_folders(spark: SparkSession, folders: int):
    """While inside, a task that writes to so many folders keeps a file open in each.

    Else its rows are sorted by folder first: all of them lie in memory or are spilled, and rows with
    many empty fields are many times as large there as in the text they came from. Spark goes back to
    that sort when as many files are open as the setting says.
    """
    return setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(folders + 1))


def small_batches(spark: SparkSession, size: int):
    """While inside, Python gets rows in batches of about so many bytes: one holds 10,000 rows or 64 MB
    else, once in Spark and several times over in the task."""
    return setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(size))
