"""Layer tables: Parquet under one root, a folder for each snapshot and in it one for each version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cartorio.fixed import PARTITION
from cartorio.sources.layouts import pick
from cartorio.sources.settings import setting
from cartorio.sources.versions import Record, current, month_path, pending

__all__ = ["EmptyMonth", "has_month", "month_path", "read_month", "require_rows", "stage_rows", "write_month"]


class EmptyMonth(ValueError):
    """A stage got or produced no rows; nothing was written."""


def read_month(
    spark: SparkSession,
    root: str,
    months: str | Sequence[str],
    schema: T.StructType,
    columns: Sequence[str] | None = None,
    version: int | None = None,
) -> DataFrame:
    """One or more snapshots of a layer, each as it is published now, or in one named version.

    Only the folders of those versions are listed, no footer is read for the schema, and
    ``dt_ingestion`` is kept as text whatever months and days lie side by side under the root. Versions
    published later don't change what is read.
    """
    wanted = [months] if isinstance(months, str) else list(months)
    records = [current(spark, root, month, version) for month in wanted]
    # Where nothing is published Spark says which path is absent.
    paths = [
        f"{root.rstrip('/')}/{record.folder}" if record else f"{month_path(root, month)}/version={version or 'none'}"
        for month, record in zip(wanted, records)
    ]
    return read_folders(spark, root, paths, schema, columns)


def read_folders(
    spark: SparkSession, root: str, paths: Sequence[str], schema: T.StructType, columns: Sequence[str] | None = None
) -> DataFrame:
    """Folders under a root; of the names of folders on the way only those in the schema are columns."""
    table = spark.read.schema(schema).option("basePath", root).parquet(*paths)
    return pick(table, list(columns or schema.fieldNames()))


def has_month(spark: SparkSession, root: str, month: str, schema: T.StructType) -> bool:
    try:
        return not read_month(spark, root, month, schema).isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def require_rows(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise EmptyMonth(f"no rows: {what}")


def stage_rows(
    df: DataFrame, folder: str, schema: T.StructType, file_bytes: int, files: str = "rebalanced"
) -> None:
    """Rows of a layer in a folder that no reader knows yet; the snapshot is told by the folder.

    ``files``: ``as read`` keeps the scan's partitions (no shuffle); ``rebalanced`` lets adaptive
    execution cut files of about ``file_bytes`` (as shuffled) after a strong filter, shuffling only
    the rows that are left; ``one`` is for tables bounded to a few rows.
    """
    stored = T.StructType([field for field in schema if field.name != PARTITION])
    rows = df.select(*stored.fieldNames()).to(stored)
    if files == "rebalanced":
        rows = rows.hint("rebalance")
    elif files == "one":
        rows = rows.repartition(1)
    # Rebalanced partitions aim at so many bytes.
    with setting(df.sparkSession, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(file_bytes)):
        rows.write.option("compression", "snappy").parquet(folder)


def write_month(
    df: DataFrame,
    root: str,
    month: str,
    schema: T.StructType,
    files: str = "as read",
    file_bytes: int = 256 << 20,
    record: Record | None = None,
    base: int | None = None,
) -> DataFrame:
    """A new version of one snapshot of a layer, current as soon as it is whole; returns what was written.

    Other snapshots are left alone, and so is the version before. Refused (``MonthTaken``) if another
    version was committed since ``base``. Callers check for rows first.
    """
    spark = df.sparkSession
    with pending(spark, root, month, base) as version:
        stage_rows(df, version.path, schema, file_bytes, files)
        version.commit(record or Record(version.run))
    return read_month(spark, root, month, schema)
