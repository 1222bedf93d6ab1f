"""The headline figures of a month and their change against another month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio.fixed import BRANCH, HEADLINES, HEADQUARTERS, PARTITION, Rules
from cartorio.functions.columns import change, half_even, iso_timestamp, ratio, sum_where
from cartorio.functions.predicates import is_active


def printable(gold: DataFrame) -> DataFrame:
    """The breakdown with timestamps as ISO text."""
    return gold.withColumns({
        field.name: iso_timestamp(F.col(field.name))
        for field in gold.schema
        if isinstance(field.dataType, T.TimestampType)
    })


def _active(kind: str, condition: Column) -> Column:
    return sum_where(condition & is_active() & (F.col("establishment_type") == kind), F.col("count"))


def _figures(condition: Column, prefix: str = "") -> list[Column]:
    return [
        _active(HEADQUARTERS, condition).alias(f"{prefix}matriz_active"),
        _active(BRANCH, condition).alias(f"{prefix}filial_active"),
    ]


def _ratio(prefix: str = "") -> Column:
    return half_even(ratio(F.col(f"{prefix}filial_active"), F.col(f"{prefix}matriz_active")), 2)


def _total(prefix: str = "") -> Column:
    return F.col(f"{prefix}matriz_active") + F.col(f"{prefix}filial_active")


def summary(gold: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row: active counts, their ratio, and whether the ratio is as expected.

    All groups are the rows of ``gold`` itself; ``printable`` makes them ready to print.
    """
    # Judged after rounding; the business check judges the exact ratio.
    expected = F.col("ratio_filial_matriz").between(rules.min_ratio, rules.max_ratio)
    return (
        gold.agg(*_figures(F.lit(True)))
        .withColumn("total_active", _total()).withColumn("ratio_filial_matriz", _ratio())
        .select(*HEADLINES, expected.alias("ratio_expected"))
    )


def compare(gold: DataFrame, current: str, previous: str, rules: Rules = Rules()) -> DataFrame:
    """One row: change of the active total between two snapshots, with the headline figures of both.

    Both snapshots are read in one pass. A snapshot without rows fails the query: a change against
    nothing would look like a real one.
    """
    months = {"current": F.col(PARTITION) == current, "previous": F.col(PARTITION) == previous}
    wanted = gold.filter(F.col(PARTITION).isin(current, previous))
    summed = wanted.agg(
        *[F.count_if(month).alias(f"{side}_rows") for side, month in months.items()],
        *[figure for side, month in months.items() for figure in _figures(month, f"{side}_")],
    ).withColumns({f"{side}_total": _total(f"{side}_") for side in months})
    both = (F.col("current_rows") > 0) & (F.col("previous_rows") > 0)
    absent = F.lit(f"nothing to compare: {current} or {previous} has no rows")
    moved = change(F.col("current_total"), F.col("previous_total"))
    # A filter, because an unused column would be pruned away and the refusal with it.
    return summed.filter(F.assert_true(both, absent).isNull()).select(
        F.lit(current).alias("current_date"),
        F.lit(previous).alias("previous_date"),
        "current_total",
        "previous_total",
        half_even(moved, 4).alias("variance"),
        half_even(moved * 100, 2).alias("variance_pct"),
        (F.abs(moved) <= rules.stability).alias("within_threshold"),
        *[
            column
            for side in months
            for column in (
                F.col(f"{side}_matriz_active"), F.col(f"{side}_filial_active"),
                _ratio(f"{side}_").alias(f"{side}_ratio_filial_matriz"),
            )
        ],
    )


def console_text(month: str, figures: Row) -> str:
    """The summary row as a few lines of text."""
    lines = [
        ("Month", month),
        ("Active headquarters", f"{figures.matriz_active:,}"),
        ("Active branches", f"{figures.filial_active:,}"),
        ("Active in total", f"{figures.total_active:,}"),
        ("Branches per headquarters", f"{figures.ratio_filial_matriz:.2f}"),
    ]
    return "\n".join(f"{label + ':':<28}{value}" for label, value in lines)
