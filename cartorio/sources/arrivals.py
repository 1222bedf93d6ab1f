"""Files as they arrive: each is parsed once, whenever the landing is looked at.

A file-source stream with a checkpoint reads what has come since the last look and stops
(``availableNow``); its sink commits each look as a whole. A look that breaks off is done again, and a
file is never taken twice, so the staged rows are those of one read of all files, in whatever steps
they came. A delivery that changes under a known name isn't seen: names are new, or ``replace_files``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio.fixed import CORRUPT_FIELD, CSV_FORMAT
from cartorio.sources.layouts import RAW, scan_schema
from cartorio.sources.settings import unsorted_folders

STAGED = T.StructType([
    *scan_schema(), T.StructField("source_file", T.StringType()), T.StructField("ts_ingestion", T.TimestampType()),
    T.StructField("damaged", T.BooleanType()),
])


def take_arrivals(spark: SparkSession, landing: str, folder: str, files_a_look: int | None = None) -> int:
    """Stages the files under ``landing`` that weren't staged before; returns the rows taken now.

    ``folder`` holds the staged rows and the checkpoint. With ``files_a_look`` a look commits every so
    many files, which bounds what a lost driver has to do again.
    """
    options = dict(CSV_FORMAT, columnNameOfCorruptRecord=CORRUPT_FIELD, recursiveFileLookup="true")
    if files_a_look:
        options["maxFilesPerTrigger"] = str(files_a_look)
    rows = (
        spark.readStream.schema(scan_schema(RAW)).options(**options).csv(landing)
        .withColumns({"source_file": F.col("_metadata.file_path"), "ts_ingestion": F.current_timestamp()})
        .withColumn("damaged", F.col(CORRUPT_FIELD).isNotNull())
    )
    with unsorted_folders(spark, 2):
        query = (
            rows.writeStream.format("parquet").partitionBy("damaged").outputMode("append")
            .option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/rows")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return sum(int(progress["numInputRows"]) for progress in query.recentProgress)


def arrived(spark: SparkSession, folder: str) -> DataFrame:
    """All rows staged so far (``STAGED``), as the sink's log has them."""
    return spark.read.schema(STAGED).parquet(f"{folder}/rows")
