"""What a table's columns hold, as sketches that merge: months are profiled once and put together later.

A profile is a row a column: rows, filled rows, a sketch of the distinct values (HyperLogLog of 2**12
registers: a standard error of 1.6 %) and one of the quantiles (KLL of 200: ranks are off by 1.33 % at
most with probability 0.99; of numbers their values, of texts their lengths). Sketches have a fixed size, and merging them
gives what one pass over all rows would, within the same error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio.fixed import PARTITION
from cartorio.functions.columns import ratio

REGISTERS, KLL = 12, 200
#: Three standard errors of the distinct count, and the error of a rank.
DISTINCT_ERROR, RANK_ERROR = 3 * 1.04 / 2 ** (REGISTERS / 2), 0.0133
PROFILE = T.StructType([
    T.StructField("column", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("filled", T.LongType()),
    T.StructField("distinct_sketch", T.BinaryType()),
    T.StructField("quantile_sketch", T.BinaryType()),
    T.StructField(PARTITION, T.StringType()),
])


def measure_of(rows: DataFrame, name: str):
    """What quantiles are of: a number, or the length of a text."""
    column = F.col(f"`{name}`")
    return (F.length(column) if isinstance(rows.schema[name].dataType, T.StringType) else column).cast("bigint")


def column_profile(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The profile of a table (``PROFILE`` but for the snapshot): one pass, whatever the columns."""
    names = list(columns or rows.columns)
    wide = rows.agg(F.count(F.lit(1)).alias("rows"), *[
        F.struct(
            F.lit(name).alias("column"), F.count(f"`{name}`").alias("filled"),
            F.hll_sketch_agg(F.col(f"`{name}`").cast("string"), REGISTERS).alias("distinct_sketch"),
            F.kll_sketch_agg_bigint(measure_of(rows, name), KLL).alias("quantile_sketch"),
        ).alias(f"c{at}") for at, name in enumerate(names)
    ])
    return wide.select("rows", F.inline(F.array(*[f"c{at}" for at in range(len(names))]))).select(
        "column", "rows", "filled", "distinct_sketch", "quantile_sketch"
    )


def merged(profiles: DataFrame) -> DataFrame:
    """Profiles of several tables (months, files) as that of all their rows."""
    return profiles.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("filled").alias("filled"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_bigint("quantile_sketch").alias("quantile_sketch"),
    )


def described(profiles: DataFrame) -> DataFrame:
    """``column``, ``rows``, ``filled``, ``null_rate``, and estimates: ``n_distinct`` and the quartiles
    (null for a column without a value)."""
    quartile = lambda share: F.when(
        F.col("filled") > 0, F.kll_sketch_get_quantile_bigint("quantile_sketch", F.lit(share))
    )
    return profiles.select(
        "column", "rows", "filled", ratio(F.col("rows") - F.col("filled"), F.col("rows")).alias("null_rate"),
        F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"),
        quartile(0.25).alias("q1"), quartile(0.5).alias("median"), quartile(0.75).alias("q3"),
    )
