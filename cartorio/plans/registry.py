"""A business registry seen in the driver's order tables.

Every order is an establishment, its customer's nation the city, the region the state. All thirty
raw fields are derived, so that scans, checks and round trips work on full-width rows. The customer
join is many-to-one on a key that may be crowded: no side is forced to broadcast, and adaptive
execution splits the crowded partitions of the shuffle join it becomes at size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.fixed import PARTITION
from cartorio.sources.layouts import RAW_NAMES

# Declared, so that no query starts with jobs that only look at file footers.
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

# The raw fields over orders, customer, nation and region, in SQL both engines read; {day} is the
# order date as yyyyMMdd text.
FIELDS = {
    "cnpj_basico": "lpad(CAST(o_orderkey AS STRING), 8, '0')",
    "cnpj_ordem": "lpad(CAST(o_custkey % 10000 AS STRING), 4, '0')",
    "cnpj_dv": "lpad(CAST(o_orderkey % 97 AS STRING), 2, '0')",
    "identificador_matriz_filial":
        "CASE WHEN o_orderkey % 50 = 7 THEN NULL WHEN o_orderkey % 50 = 8 THEN 3"
        " WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END",
    "nome_fantasia": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE c_name END",
    "situacao_cadastral":
        "CASE WHEN o_orderkey % 20 = 0 THEN 1 WHEN o_orderkey % 20 = 1 THEN 3"
        " WHEN o_orderkey % 20 = 2 THEN 4 WHEN o_orderkey % 20 = 3 THEN 9"
        " WHEN o_orderkey % 20 = 4 THEN NULL WHEN o_orderkey % 20 < 10 THEN 8 ELSE 2 END",
    "data_situacao_cadastral": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE {day} END",
    "motivo_situacao_cadastral":
        "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey % 64 AS INT) END",
    "nome_cidade_exterior": "CASE WHEN o_orderkey % 200 = 0 THEN n_name END",
    "pais": "CASE WHEN o_orderkey % 200 = 0 THEN lpad(CAST(c_nationkey AS STRING), 3, '0') END",
    "data_inicio_atividade": "{day}",
    "cnae_fiscal_principal": "lpad(CAST(o_custkey % 1000 AS STRING), 7, '0')",
    "cnae_fiscal_secundaria":
        "lpad(CAST(o_orderkey % 1000 AS STRING), 7, '0') || ',' ||"
        " lpad(CAST(o_custkey % 777 AS STRING), 7, '0')",
    "tipo_logradouro":
        "CASE o_orderkey % 3 WHEN 0 THEN 'RUA' WHEN 1 THEN 'AVENIDA' ELSE 'PRAÇA' END",
    "logradouro": "'São \"' || c_mktsegment || '\"; ' || n_name",
    "numero": "CAST(o_orderkey % 9999 AS STRING)",
    "complemento":
        "CASE WHEN o_orderkey % 2 = 1 THEN 'SALA ' || CAST(o_custkey % 50 AS STRING) END",
    "bairro": "o_orderpriority",
    "cep": "lpad(CAST(o_custkey AS STRING), 8, '0')",
    "uf": "r_name",
    "municipio": "CAST(7100 + c_nationkey AS STRING)",
    "ddd_1": "CAST(11 + c_nationkey AS STRING)",
    "telefone_1": "lpad(CAST(o_orderkey % 100000000 AS STRING), 8, '0')",
    "ddd_2": "CASE WHEN o_orderkey % 10 = 0 THEN '11' END",
    "telefone_2":
        "CASE WHEN o_orderkey % 10 = 0 THEN lpad(CAST(o_custkey AS STRING), 8, '0') END",
    "ddd_fax": "CAST(NULL AS STRING)",
    "fax": "CAST(NULL AS STRING)",
    "correio_eletronico":
        "CASE WHEN o_orderkey % 4 = 0 THEN NULL"
        " ELSE 'contato' || CAST(o_custkey AS STRING) || '@example.com' END",
    "situacao_especial": "CASE WHEN o_orderkey % 500 = 1 THEN 'ESPOLIO' END",
    "data_situacao_especial": "CASE WHEN o_orderkey % 500 = 1 THEN {day} END",
}


def select_list(day: str) -> list[str]:
    """The select list of the registry view, given the engine's spelling of the day."""
    return [
        *(f"{FIELDS[name].format(day=day)} AS {name}" for name in RAW_NAMES),
        "o_orderkey AS record_no",
    ]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thirty raw fields and ``record_no``; unused fields are pruned down to the scans."""
    orders, customer, nation, region = (table(spark, sf_dir, name) for name in TABLES)
    return (
        orders.join(customer, F.expr("o_custkey = c_custkey"))
        .join(nation, F.expr("c_nationkey = n_nationkey"))
        .join(region, F.expr("n_regionkey = r_regionkey"))
        .selectExpr(*select_list("date_format(o_orderdate, 'yyyyMMdd')"))
    )


def opened_by(last_day: str) -> Column:
    """The establishments a snapshot of that day (yyyyMMdd) holds: all opened until then."""
    return F.col("data_inicio_atividade") <= last_day


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The city lookup."""
    return table(spark, sf_dir, "nation").selectExpr(
        "CAST(7100 + n_nationkey AS STRING) AS code", "n_name AS name"
    )


#: How the lookup spells a city that is asked for otherwise, in SQL both engines read.
SPELLED = "replace(name, 'NATION_', 'Nação ') || ' '"


def accented(lookup: DataFrame) -> DataFrame:
    """The lookup with names as people write them."""
    return lookup.withColumn("name", F.expr(SPELLED))


def opening_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month every establishment was opened in, with the number of the file that carries it."""
    return table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias(PARTITION),
        F.format_string("Estabelecimentos%d.zip", F.col("o_orderkey") % 10).alias("file_name"),
    )


#: Formats of the names, by order number modulo their count; the last two name no day.
NAME_FORMATS = ("yyyy-MM", "yyyy-MM-dd", "yyyy/MM", "yyyy-'13'", "yyyy-'02-30'")


def delivery_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``name``: the day or month of each order as a delivery might be called, rightly or not."""
    turn = F.col("o_orderkey") % len(NAME_FORMATS)
    name = F.lit(None)
    for number, layout in enumerate(NAME_FORMATS):
        name = F.when(turn == number, F.date_format("o_orderdate", layout)).otherwise(name)
    return table(spark, sf_dir, "orders").select(name.alias("name"))


def extract_lines(rows: DataFrame) -> DataFrame:
    """Registry rows as lines of the raw extract. One line in 499 each is cut short, too long, or
    holds text in a number field."""
    turn = F.col("record_no") % 499
    status = F.when(turn == 3, "xx").otherwise(F.col("situacao_cadastral").cast("string"))
    rows = rows.withColumn("situacao_cadastral", status)
    layout = {"sep": ";", "quoteAll": "true", "escape": '"'}
    short, whole = (F.to_csv(F.struct(*names), layout) for names in (RAW_NAMES[:12], RAW_NAMES))
    return rows.select(
        F.when(turn == 1, short)
        .when(turn == 2, F.concat(whole, F.lit(';"more"')))
        .otherwise(whole)
        .alias("line")
    )


def write_extract(rows: DataFrame, folder: str) -> None:
    """Registry rows as text files of the raw extract, lines as they are, in its encoding."""
    (
        extract_lines(rows)
        .write.options(
            encoding="ISO-8859-1", quote="", sep="\u0001", escapeQuotes="false", emptyValue="",
            ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
        )
        .csv(folder)
    )


#: A field that holds line breaks, quotes and a separator, in SQL both engines read.
BROKEN = {"complemento": "complemento || chr(10) || 'FUNDOS \"' || numero || '\";' || chr(10) || chr(10) || 'TERREO'"}


def with_breaks(rows: DataFrame) -> DataFrame:
    return rows.withColumns({name: F.expr(value) for name, value in BROKEN.items()})


def write_broken_extract(rows: DataFrame, folder: str) -> None:
    """Like ``write_extract``, of rows whose fields hold line breaks: the bytes of each record as they are."""
    extract_lines(with_breaks(rows)).select(
        F.encode("line", "ISO-8859-1").cast("string").alias("value")
    ).write.text(folder)
