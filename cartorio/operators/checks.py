"""Data-quality checks: each bundle is one row of measures and booleans from one pass.

A bundle reads its table once, whatever the number of checks in it. Failing a check is a result,
not an error; ``require`` turns it into one where a run must stop.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartorio.fixed import (
    BRANCH,
    BUSINESS_CHECKS,
    HEADQUARTERS,
    ID_PARTS,
    INPUT_CHECKS,
    OUTPUT_CHECKS,
    REQUIRED_FIELDS,
    STATUS_LABELS,
    TYPE_LABELS,
    Rules,
)
from cartorio.functions.columns import change, count_where, ratio, sum_where
from cartorio.functions.predicates import elsewhere, is_active, outside, wrong_length
from cartorio.operators.measures import GROUP_KEYS, side_by_side

PASSED = "all_checks_passed"


class CheckFailed(ValueError):
    """A check that guards the run did not pass."""


def _judged(measured: DataFrame, checks: dict[str, Column]) -> DataFrame:
    return measured.withColumns(checks).withColumn(PASSED, reduce(and_, map(F.col, checks)))


def _lowest(values: Sequence[Column]) -> Column:
    return F.least(*values) if len(values) > 1 else values[0]


def input_checks(
    bronze: DataFrame, rules: Rules = Rules(), columns: Sequence[str] | None = None
) -> DataFrame:
    """Enough rows, required columns present, no column too empty (of all, or of those named)."""
    present = all(name in bronze.columns for name in REQUIRED_FIELDS)
    # A column that isn't there fails its own check, not the query.
    judged = [name for name in columns or bronze.columns if name in bronze.columns]
    record_count = F.count(F.lit(1))
    measured = bronze.agg(
        record_count.alias("record_count"),
        _lowest([record_count, *(F.count(name) for name in judged)]).alias("least_filled"),
    ).select(
        "record_count",
        # All rates share the row count, so the worst one is that of the least filled column.
        ratio(
            F.col("record_count") - F.col("least_filled"), F.col("record_count")
        ).alias("worst_null_rate"),
    )
    return _judged(measured, dict(zip(INPUT_CHECKS, (
        F.col("record_count") >= rules.min_bronze_rows,
        F.lit(present),
        F.col("worst_null_rate") <= rules.max_null_rate,
    ), strict=True)))


def id_checks(bronze: DataFrame) -> DataFrame:
    """Rows lacking a part of the id, per part. File sources cannot promise non-null, data can."""
    measured = bronze.agg(*[
        count_where(F.col(part).isNull()).alias(f"null_{part}") for part in ID_PARTS
    ])
    return _judged(measured, {
        f"has_{part}": F.col(f"null_{part}") == 0 for part in ID_PARTS
    })


def _type_is_odd() -> Column:
    return outside("establishment_type", TYPE_LABELS.values())


def _status_is_odd() -> Column:
    return outside("registration_status", STATUS_LABELS.values())


def _business_verdicts(rules: Rules) -> dict[str, Column]:
    return dict(zip(BUSINESS_CHECKS, (
        F.col("rows_elsewhere") == 0,
        F.col("odd_types") == 0,
        F.col("odd_statuses") == 0,
        F.col("odd_ids") == 0,
        F.col("record_count").between(rules.min_silver_rows, rules.max_silver_rows),
        F.col("filial_matriz_ratio").between(rules.min_ratio, rules.max_ratio),
    ), strict=True))


def _output_verdicts(stable: Column) -> dict[str, Column]:
    return dict(zip(OUTPUT_CHECKS, (
        F.col("gold_sum").eqNullSafe(F.col("silver_rows")),
        (F.col("null_types") == 0) & (F.col("null_statuses") == 0),
        F.col("active") > 0,
        stable,
    ), strict=True))


def _with_ratio(measured: DataFrame) -> DataFrame:
    return measured.withColumn(
        "filial_matriz_ratio", ratio(F.col("filial_count"), F.col("matriz_count"))
    )


def business_checks(
    silver: DataFrame, rules: Rules = Rules(), cities: DataFrame | None = None
) -> DataFrame:
    """City, labels, id length, volume and the exact branch ratio of the curated rows.

    With ``cities`` (a table of ``municipio``) those are the target cities, else the rules' codes.
    """
    away = elsewhere(rules.cities)
    if cities is not None:
        listed = cities.select("municipio", F.lit(True).alias("_listed")).distinct()
        silver = silver.join(listed, "municipio", "left")
        away = F.col("municipio").isNotNull() & F.col("_listed").isNull()
    kind = F.col("establishment_type")
    measured = silver.agg(
        F.count(F.lit(1)).alias("record_count"),
        count_where(away).alias("rows_elsewhere"),
        count_where(_type_is_odd()).alias("odd_types"),
        count_where(_status_is_odd()).alias("odd_statuses"),
        count_where(wrong_length()).alias("odd_ids"),
        count_where(kind == HEADQUARTERS).alias("matriz_count"),
        count_where(kind == BRANCH).alias("filial_count"),
    )
    return _judged(_with_ratio(measured), _business_verdicts(rules))


def _stable(rules: Rules) -> Column:
    return F.abs(change(F.col("active"), F.col("previous_active"))) <= rules.stability


def output_checks(
    silver: DataFrame,
    gold: DataFrame,
    previous: DataFrame | None = None,
    rules: Rules = Rules(),
) -> DataFrame:
    """Counts add up to the rows, no group lost its key, some are active, active total is stable.

    Without a previous snapshot, or with nothing active in it, the month counts as stable. An
    unreadable previous snapshot fails the query instead of passing as stable.
    """
    active = sum_where(is_active(), F.col("count"))
    parts = [
        silver.agg(F.count(F.lit(1)).alias("silver_rows")),
        gold.agg(
            F.sum("count").alias("gold_sum"),
            count_where(F.col("establishment_type").isNull()).alias("null_types"),
            count_where(F.col("registration_status").isNull()).alias("null_statuses"),
            active.alias("active"),
        ),
    ]
    if previous is not None:
        parts.append(previous.agg(active.alias("previous_active")))
    stable = F.lit(True) if previous is None else _stable(rules)
    return _judged(side_by_side(*parts), _output_verdicts(stable))


# --- several bundles from one pass ----------------------------------------------------------------


def cells(silver: DataFrame, months: dict[str, Column], rules: Rules = Rules()) -> DataFrame:
    """All that the bundles need, from one pass over the curated rows.

    A row for each type and status, and one for all rows together (``whole``), which is counted from
    the rows themselves and not from the groups: rows, rows elsewhere, ids of wrong length, and the
    rows of each snapshot (a condition).
    """
    return silver.groupingSets([list(GROUP_KEYS), []], *GROUP_KEYS).agg(
        (F.grouping_id() > 0).alias("whole"),
        F.count(F.lit(1)).alias("rows"),
        count_where(elsewhere(rules.cities)).alias("rows_elsewhere"),
        count_where(wrong_length()).alias("odd_ids"),
        *[count_where(condition).alias(f"in_{month}") for month, condition in months.items()],
    )


def _total(condition: Column, amount: str | Column) -> Column:
    return sum_where(condition, F.col(amount) if isinstance(amount, str) else amount)


def _business_sums() -> list[Column]:
    group, kind = ~F.col("whole"), F.col("establishment_type")
    return [
        _total(F.col("whole"), "rows").alias("record_count"),
        _total(F.col("whole"), "rows_elsewhere").alias("rows_elsewhere"),
        _total(group & _type_is_odd(), "rows").alias("odd_types"),
        _total(group & _status_is_odd(), "rows").alias("odd_statuses"),
        _total(F.col("whole"), "odd_ids").alias("odd_ids"),
        _total(group & (kind == HEADQUARTERS), "rows").alias("matriz_count"),
        _total(group & (kind == BRANCH), "rows").alias("filial_count"),
    ]


def _output_sums(current: str, previous: str | None) -> list[Column]:
    group, now = ~F.col("whole") & (F.col(f"in_{current}") > 0), f"in_{current}"
    sums = [
        _total(F.col("whole"), now).alias("silver_rows"),
        F.sum(F.when(group, F.col(now))).alias("gold_sum"),
        count_where(group & F.col("establishment_type").isNull()).alias("null_types"),
        count_where(group & F.col("registration_status").isNull()).alias("null_statuses"),
        _total(group & is_active(), now).alias("active"),
    ]
    if previous is None:
        return sums
    return [*sums, _total(~F.col("whole") & is_active(), f"in_{previous}").alias("previous_active")]


def output_from(
    counted: DataFrame, current: str, previous: str | None = None, rules: Rules = Rules()
) -> DataFrame:
    """``output_checks`` of a snapshot out of ``cells``."""
    stable = F.lit(True) if previous is None else _stable(rules)
    return _judged(counted.agg(*_output_sums(current, previous)), _output_verdicts(stable))


def reconcile_from(counted: DataFrame, current: str) -> DataFrame:
    """``reconcile`` of a snapshot out of ``cells``."""
    sums = counted.agg(*_output_sums(current, None)).select("gold_sum", "silver_rows")
    return sums.withColumn("matches", F.col("gold_sum").eqNullSafe(F.col("silver_rows")))


def gate_from(
    counted: DataFrame, current: str, previous: str | None = None, rules: Rules = Rules()
) -> DataFrame:
    """``run_gate`` out of ``cells``: the business checks of all rows, the output checks of a snapshot."""
    measured = _with_ratio(counted.agg(*_business_sums(), *_output_sums(current, previous)))
    stable = F.lit(True) if previous is None else _stable(rules)
    return _gate(measured.select(
        reduce(and_, _business_verdicts(rules).values()).alias("business_passed"),
        reduce(and_, _output_verdicts(stable).values()).alias("output_passed"),
    ))


def _gate(both: DataFrame) -> DataFrame:
    return both.withColumn("all_passed", F.col("business_passed") & F.col("output_passed"))


def run_gate(business: DataFrame, output: DataFrame) -> DataFrame:
    """One row: both bundles and their conjunction."""
    both = side_by_side(
        business.select(F.col(PASSED).alias("business_passed")),
        output.select(F.col(PASSED).alias("output_passed")),
    )
    return _gate(both)


def reconcile(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """One row: rows counted in gold, rows in silver, and whether they are the same."""
    sums = side_by_side(
        gold.agg(F.sum("count").alias("gold_sum")),
        silver.agg(F.count(F.lit(1)).alias("silver_rows")),
    )
    return sums.withColumn("matches", F.col("gold_sum").eqNullSafe(F.col("silver_rows")))


def require(checked: DataFrame, what: str, verdict: str = PASSED) -> None:
    """Stop the run unless the one-row result says that all is well."""
    row = checked.first()
    if not row[verdict]:
        raise CheckFailed(f"{what}: {row.asDict()}")
