"""Whether a month's counts fit what the months before it had."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartorio.fixed import PARTITION
from cartorio.operators.measures import GROUP_KEYS

#: Makes the median of absolute deviations a standard deviation, were the counts normal.
NORMAL = 1.4826


def _median(values: Column) -> Column:
    """The middle of a list of numbers, of two the mean; null of none."""
    ordered, n = F.sort_array(values), F.size(values)
    low, high = F.floor((n + 1) / 2).cast("int"), F.floor(n / 2).cast("int") + 1
    return F.when(n > 0, (F.get(ordered, low - 1) + F.get(ordered, high - 1)) / 2.0)


def stability_history(
    gold: DataFrame, back: int = 12, least: int = 3, reach: float = 3.0, share: float = 0.02
) -> DataFrame:
    """Every count of every month beside the ``back`` last ones of its group: their number, median and
    median absolute deviation, and whether the count is ``stable``.

    It is if it lies within ``reach`` deviations of the median (``share`` of the median at least, for
    groups that hardly move). Counts with fewer than ``least`` before them aren't judged and pass. A
    month in which a group doesn't occur is no count of 0 but a gap, told by ``gap_months``: months
    since the last count, beyond one. A null count is no count. Months are told by the first of the month.
    """
    kind, status = GROUP_KEYS
    upto = Window.partitionBy(kind, status).orderBy(PARTITION)
    before = upto.rowsBetween(-back, -1)
    rows = gold.filter(F.col("count").isNotNull()).select(PARTITION, kind, status, "count").withColumns({
        "past": F.collect_list("count").over(before), "last": F.lag(PARTITION).over(upto),
    })
    month = lambda name: F.to_date(F.concat(F.substring(name, 1, 7), F.lit("-01")))
    rows = rows.withColumn("median", _median(F.col("past")))
    rows = rows.withColumn("deviation", _median(F.transform("past", lambda x: F.abs(x - F.col("median")))))
    room = F.greatest(reach * NORMAL * F.col("deviation"), share * F.col("median"))
    n = F.size("past")
    return rows.select(
        PARTITION, kind, status, "count", n.alias("n_past"), "median", "deviation",
        F.coalesce(F.months_between(month(PARTITION), month("last")).cast("int") - 1, F.lit(0)).alias("gap_months"),
        ((n < least) | (F.abs(F.col("count") - F.col("median")) <= room)).alias("stable"),
    )
