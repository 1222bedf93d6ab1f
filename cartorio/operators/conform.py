"""From raw rows to curated rows: filter on codes, map them, build the id, project, stamp."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartorio.fixed import CURATED_OUTPUT, PARTITION, STATUS_LABELS, TARGET_CITY, TYPE_LABELS
from cartorio.functions.columns import label_of, registry_id
from cartorio.functions.predicates import curated_scope, is_active


def in_scope(bronze: DataFrame, cities: Iterable[str] | None = (TARGET_CITY,)) -> DataFrame:
    return bronze.filter(curated_scope(cities))


def labelled(rows: DataFrame) -> DataFrame:
    """Adds the two labels and the composite id; no row is lost."""
    return rows.withColumns({
        "registration_status": label_of(F.col("situacao_cadastral"), STATUS_LABELS),
        "establishment_type": label_of(F.col("identificador_matriz_filial"), TYPE_LABELS),
        "cnpj_completo": registry_id(),
    })


def curated(bronze: DataFrame, cities: Iterable[str] | None = (TARGET_CITY,)) -> DataFrame:
    """Curated rows without load metadata. One scan, no shuffle."""
    return labelled(in_scope(bronze, cities)).select(*CURATED_OUTPUT)


def stamped(rows: DataFrame, month: str, name: str, moment: Column | None = None) -> DataFrame:
    """Adds the snapshot and the load time (now, unless a moment is given)."""
    return rows.withColumns({
        PARTITION: F.lit(month),
        name: F.current_timestamp() if moment is None else moment,
    })


def active_only(counts: DataFrame) -> DataFrame:
    return counts.filter(is_active())
