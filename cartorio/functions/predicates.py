"""Row conditions and argument checks."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartorio.fixed import (
    ACTIVE,
    CORRUPT_FIELD,
    ID_LENGTH,
    MONTH_PATTERN,
    SNAPSHOT_FORMATS,
    TYPE_LABELS,
)


def curated_scope(cities: Iterable[str] | None) -> Column:
    """Rows of the curated layer: in a target city, with a status, headquarters or branch.

    Written on the raw codes, so that all conditions reach the Parquet scan. Without cities, those
    are told elsewhere (by a join with the lookup).
    """
    known = F.col("situacao_cadastral").isNotNull() & F.col("identificador_matriz_filial").isin(
        list(TYPE_LABELS)
    )
    return known if cities is None else F.col("municipio").isin(list(cities)) & known


def is_active() -> Column:
    return F.col("registration_status") == ACTIVE


def is_corrupt() -> Column:
    return F.col(CORRUPT_FIELD).isNotNull()


def outside(column: str, allowed: Iterable[str]) -> Column:
    """A value not among the allowed ones; null counts as outside."""
    return F.col(column).isNull() | ~F.col(column).isin(list(allowed))


def elsewhere(cities: Iterable[str]) -> Column:
    """A city other than the targets; a null city is not elsewhere."""
    return ~F.col("municipio").isin(list(cities))


def wrong_length(column: str = "cnpj_completo", length: int = ID_LENGTH) -> Column:
    """An id of another length; a null id is not of wrong length."""
    return F.length(column) != length


def _parses(text: str, layout: str) -> bool:
    """A date in the layout, and spelled as the layout spells it (one name for each snapshot)."""
    try:
        return datetime.strptime(text, layout).strftime(layout) == text
    except ValueError:
        return False


def check_snapshot(text: str) -> str:
    """The name of a snapshot, month or day; anything else is refused."""
    if not any(_parses(text, layout) for layout in SNAPSHOT_FORMATS):
        raise ValueError(f"not a snapshot name (YYYY-MM or YYYY-MM-DD): {text!r}")
    return text


def names_snapshot(column: str) -> Column:
    """What ``check_snapshot`` accepts, of a whole column; null is no name."""
    text = F.col(column)
    day = F.when(F.length(text) == len("YYYY-MM"), F.concat(text, F.lit("-01"))).otherwise(text)
    spelled = day.rlike(r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z")
    return F.coalesce(spelled & F.try_to_date(day, "yyyy-MM-dd").isNotNull(), F.lit(False))


def names_month(column: str) -> Column:
    """What ``check_month`` accepts, of a whole column; null is no name."""
    return F.coalesce(F.col(column).rlike(rf"^(?:{MONTH_PATTERN})\z"), F.lit(False))


def check_month(text: str) -> str:
    """The name of a month as the run parameters accept it."""
    if not re.fullmatch(MONTH_PATTERN, text):
        raise ValueError(f"not a month (YYYY-MM): {text!r}")
    return text
