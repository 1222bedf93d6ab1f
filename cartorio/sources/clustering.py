"""Bronze laid out so that a city is read from few row groups.

Rows are dealt into ranges of (city, id) and sorted in them. A city of few rows lies within one range;
one that holds a third of all rows spans as many ranges as its share asks for, told apart by the id, so
no task gets a crowded city whole. A file's row groups then each hold a few neighbouring cities, and the
minimum and maximum that Parquet keeps of each let a scan of one city pass over the rest. A Bloom filter
on the id does the same for a search of single ids, which lie all over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cartorio.fixed import ID_PARTS, PARTITION

#: What rows are ordered by.
ORDER = ("municipio", *ID_PARTS[:2])
BLOOM = ID_PARTS[0]


def folder_bytes(spark: SparkSession, folder: str) -> int:
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(where).getLength()


def write_clustered(
    rows: DataFrame,
    folder: str,
    schema: T.StructType,
    ranges: int,
    group_bytes: int = 32 << 20,
    order: Sequence[str] = ORDER,
) -> None:
    """Rows in sorted files, one a range. Spark finds the limits of the ranges from a bounded sample; they
    decide where a row lies, never whether. ``group_bytes`` is the size of a row group: the smaller, the
    less of other cities is read along with one."""
    stored = [field.name for field in schema if field.name != PARTITION]
    (
        rows.select(*stored)
        .repartitionByRange(max(1, ranges), *order)
        .sortWithinPartitions(*order)
        .write.options(**{
            "compression": "snappy",
            "parquet.block.size": str(group_bytes),
            f"parquet.bloom.filter.enabled#{BLOOM}": "true",
            "parquet.bloom.filter.adaptive.enabled": "true",  # as large as the ids of a row group ask for
        })
        .parquet(folder)
    )
