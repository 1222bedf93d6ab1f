"""Schemas of the raw extract and of the three layers."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio.fixed import (
    CORRUPT_FIELD,
    CRITICAL_FIELDS,
    CURATED_OUTPUT,
    PARTITION,
    RAW,
)

log = logging.getLogger(__name__)

RAW_NAMES = RAW.fieldNames()


def _layer(fields: Iterable[T.StructField], stamp: str) -> T.StructType:
    return T.StructType([
        *fields,
        T.StructField(stamp, T.TimestampType()),
        T.StructField(PARTITION, T.StringType()),
    ])


BRONZE = _layer((T.StructField(f.name, f.dataType) for f in RAW), "ts_ingestion")
SILVER = _layer((T.StructField(name, T.StringType()) for name in CURATED_OUTPUT), "ts_transform")
GOLD = _layer(
    [
        T.StructField("establishment_type", T.StringType()),
        T.StructField("registration_status", T.StringType()),
        T.StructField("count", T.LongType()),
    ],
    "ts_aggregation",
)
PARTIALS = T.StructType([
    T.StructField("municipio", T.StringType()),
    T.StructField("identificador_matriz_filial", T.IntegerType()),
    T.StructField("situacao_cadastral", T.IntegerType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField(PARTITION, T.StringType()),
])
QUARANTINE = T.StructType([
    T.StructField("raw_line", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField(PARTITION, T.StringType()),
])


def scan_schema(schema: T.StructType = RAW) -> T.StructType:
    """The read schema with the field that captures lines which do not fit."""
    return T.StructType([*schema, T.StructField(CORRUPT_FIELD, T.StringType())])


def check_names(names: Iterable[str], schema: T.StructType = RAW) -> None:
    """Refuse a table lacking declared fields or holding others; order and type are not compared."""
    declared, given = set(schema.fieldNames()), set(names)
    missing, extra = declared - given, given - declared - {CORRUPT_FIELD}
    if missing or extra:
        raise ValueError(f"schema mismatch: missing {sorted(missing)}, unexpected {sorted(extra)}")


def pick(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    """The named columns in the order asked for; unknown names are reported and skipped."""
    if not columns:
        return df
    unknown = [name for name in columns if name not in df.columns]
    if unknown:
        log.warning("columns not in the table, skipped: %s", unknown)
    return df.select(*[name for name in columns if name in df.columns])


def describe(df: DataFrame, schema: T.StructType = RAW) -> DataFrame:
    """One row per declared field: its declaration and how the table fills it.

    One pass: a count per field, then the single wide row is turned into one row per field.
    """
    names = schema.fieldNames()
    measured = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(n).alias(n) for n in names])
    fields = ", ".join(
        f"struct({position} AS position, '{field.name}' AS field, "
        f"'{field.dataType.simpleString()}' AS type, {not field.nullable} AS required, "
        f"{field.name in CRITICAL_FIELDS} AS critical, `{field.name}` AS filled)"
        for position, field in enumerate(schema, start=1)
    )
    return measured.selectExpr("rows", f"inline(array({fields}))")
