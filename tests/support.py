from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartorio.fixed import CURATED_OUTPUT
from cartorio.sources.layouts import RAW, RAW_NAMES

GOLD_ROWS = "establishment_type string, registration_status string, count bigint"


def plan_of(df: DataFrame, mode: str = "formatted") -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def task_memory(spark: SparkSession) -> dict[int, int]:
    """Bytes that the tasks of each stage so far took for sorts, hash tables and the like."""
    context, jvm = spark._jsc.sc(), spark._jvm
    context.listenerBus().waitUntilEmpty(30_000)
    none = jvm.java.util.ArrayList()
    quantiles = spark.sparkContext._gateway.new_array(jvm.double, 0)
    stages = context.statusStore().stageList(none, False, False, quantiles, none)
    return {(s := stages.apply(at)).stageId(): s.peakExecutionMemory() for at in range(stages.size())}


def raw_rows(spark: SparkSession, *rows: dict) -> DataFrame:
    """Raw rows; fields not given are null."""
    return spark.createDataFrame(
        [tuple(row.get(name) for name in RAW_NAMES) for row in rows],
        ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW),
    )


def sound(number: int, **values) -> dict:
    return {
        "cnpj_basico": f"{number:08d}", "cnpj_ordem": "0001", "cnpj_dv": "55",
        "identificador_matriz_filial": 1, "situacao_cadastral": 2, "municipio": "7107",
        **values,
    }


def silver_rows(spark: SparkSession, *rows: dict) -> DataFrame:
    """Curated rows, sound where nothing else is given."""
    base = {
        "cnpj_completo": "0" * 14, "establishment_type": "Matriz",
        "registration_status": "ATIVA", "municipio": "7107",
    }
    return spark.createDataFrame(
        [tuple({**base, **row}.get(name) for name in CURATED_OUTPUT) for row in rows],
        ", ".join(f"{name} string" for name in CURATED_OUTPUT),
    )


def gold_rows(spark: SparkSession, *rows: tuple, month: str | None = None) -> DataFrame:
    if month:
        return spark.createDataFrame(
            [(month, *row) for row in rows], f"dt_ingestion string, {GOLD_ROWS}"
        )
    return spark.createDataFrame(list(rows), GOLD_ROWS)
