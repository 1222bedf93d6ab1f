"""Derived columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartorio.fixed import ID_PARTS, ISO_TIMESTAMP, UNMAPPED


def label_of(code: Column, labels: Mapping[int, str], default: str = UNMAPPED) -> Column:
    """Label of a code; null and unmapped codes get the default."""
    chain = reduce(lambda case, pair: case.when(code == pair[0], pair[1]), labels.items(), F)
    return chain.otherwise(default)


def registry_id(parts: Iterable[str] = ID_PARTS) -> Column:
    """All parts glued together; null as soon as one part is null."""
    return F.concat(*parts)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, 0 where the whole is not positive (or unknown)."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def change(current: Column, previous: Column) -> Column:
    """Signed relative change, 0 where there is nothing to compare with."""
    return ratio(current - previous, previous)


def half_even(value: Column, places: int) -> Column:
    return F.bround(value, places)


def iso_timestamp(moment: Column) -> Column:
    return F.date_format(moment, ISO_TIMESTAMP)


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true; 0 on empty input."""
    return F.count_if(condition)


def sum_where(condition: Column, amount: Column) -> Column:
    """Sum over the rows meeting the condition; 0 when there are none."""
    return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0).cast("bigint"))
