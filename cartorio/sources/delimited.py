"""Delimited text: registry extracts and the city lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio.fixed import CORRUPT_FIELD, CSV_FORMAT
from cartorio.sources.layouts import RAW, check_names, scan_schema
from cartorio.sources.multiline import cut_lines, joined, parsed
from cartorio.sources.settings import unsorted_folders

STAGED = scan_schema().add("source_file", "string").add("damaged", "boolean")
LOOKUP = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("name", T.StringType()),
])


def scan_extract(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = RAW
) -> DataFrame:
    """Rows of all files, with the damaged lines kept whole in ``_corrupt_record``.

    No inference pass. Lines stay splittable (no multi-line fields), so a file of any size is read
    by many tasks. A folder stands for all files below it.

    Damage is judged by the fields a query uses: the parser skips the others, and a bad number in
    a skipped field goes unseen. Judge it on ``stage_extract``, never on this scan.
    """
    if not paths:
        raise ValueError("no files to read")
    return (
        spark.read.schema(scan_schema(schema))
        .options(
            **CSV_FORMAT, columnNameOfCorruptRecord=CORRUPT_FIELD, recursiveFileLookup="true"
        )
        .csv(paths if isinstance(paths, str) else list(paths))
    )


def stage_extract(
    spark: SparkSession, paths: str | Sequence[str], folder: str, stamp: str | None = None, multiline: bool = False
) -> DataFrame:
    """The scan, all fields of it, as a written table with the file each row came from, and the time of
    loading as ``stamp``. With ``multiline`` quoted fields may hold line breaks (``multiline``).

    The text is parsed once. Everything after reads this table: the verdict on damage sees whole
    lines, later aggregates read single columns, and a lost executor costs no second parse. Sound and
    damaged rows lie apart (``damaged``), so neither is filtered out of the other again.
    """

    def stage(rows: DataFrame, mode: str) -> None:
        check_names(name for name in rows.columns if name != "source_file")
        if stamp:
            rows = rows.withColumn(stamp, F.current_timestamp())
        # Cached parse results would be judged on the columns in use; all of them are written here.
        rows = rows.withColumn("damaged", F.col(CORRUPT_FIELD).isNotNull())
        with unsorted_folders(spark, 2):
            rows.write.mode(mode).partitionBy("damaged").parquet(folder)

    if multiline:
        cut, parted = cut_lines(spark, paths)
        stage(parsed(cut.filter("whole")), "overwrite")
        if parted:
            stage(parsed(joined(cut)), "append")
    else:
        stage(scan_extract(spark, paths).withColumn("source_file", F.col("_metadata.file_path")), "overwrite")
    schema = T.StructType([*STAGED, *([T.StructField(stamp, T.TimestampType())] if stamp else [])])
    return spark.read.schema(schema).option("basePath", folder).parquet(folder)


def misfit_files(staged: DataFrame, most: float) -> DataFrame:
    """Files of which more than that share of the lines doesn't fit the layout: another layout, not
    damage. One row a file, from one pass over two columns."""
    share = F.avg(F.col("damaged").cast("int"))
    return staged.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("lines"), share.alias("misfit_share")
    ).filter(F.col("misfit_share") > most)


def read_lookup(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """City codes and names."""
    return (
        spark.read.schema(LOOKUP).options(**CSV_FORMAT, recursiveFileLookup="true").csv(paths)
    )
