"""Values fixed by the registry's public file layout and by the published rules.

Nothing here is computed: names, codes, labels, formats and limits are stated as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: the raw extract, field by field, in file order ---------------------------------
RAW = T.StructType([
    T.StructField("cnpj_basico", T.StringType(), nullable=False),
    T.StructField("cnpj_ordem", T.StringType(), nullable=False),
    T.StructField("cnpj_dv", T.StringType(), nullable=False),
    T.StructField("identificador_matriz_filial", T.IntegerType()),
    T.StructField("nome_fantasia", T.StringType()),
    T.StructField("situacao_cadastral", T.IntegerType()),
    T.StructField("data_situacao_cadastral", T.StringType()),
    T.StructField("motivo_situacao_cadastral", T.IntegerType()),
    T.StructField("nome_cidade_exterior", T.StringType()),
    T.StructField("pais", T.StringType()),
    T.StructField("data_inicio_atividade", T.StringType()),
    T.StructField("cnae_fiscal_principal", T.StringType()),
    T.StructField("cnae_fiscal_secundaria", T.StringType()),
    T.StructField("tipo_logradouro", T.StringType()),
    T.StructField("logradouro", T.StringType()),
    T.StructField("numero", T.StringType()),
    T.StructField("complemento", T.StringType()),
    T.StructField("bairro", T.StringType()),
    T.StructField("cep", T.StringType()),
    T.StructField("uf", T.StringType()),
    T.StructField("municipio", T.StringType()),
    T.StructField("ddd_1", T.StringType()),
    T.StructField("telefone_1", T.StringType()),
    T.StructField("ddd_2", T.StringType()),
    T.StructField("telefone_2", T.StringType()),
    T.StructField("ddd_fax", T.StringType()),
    T.StructField("fax", T.StringType()),
    T.StructField("correio_eletronico", T.StringType()),
    T.StructField("situacao_especial", T.StringType()),
    T.StructField("data_situacao_especial", T.StringType()),
])
ID_PARTS = ("cnpj_basico", "cnpj_ordem", "cnpj_dv")
CRITICAL_FIELDS = ("cnpj_basico", "cnpj_ordem", "cnpj_dv", "municipio")
REQUIRED_FIELDS = ("cnpj_basico", "cnpj_ordem", "cnpj_dv", "municipio", "situacao_cadastral")
CORRUPT_FIELD = "_corrupt_record"
ID_LENGTH = 14
# Weights of the check digits; the first digit uses all but the first of them.
CHECK_WEIGHTS = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
ID_PATTERN = r"^[0-9A-Z]{12}[0-9]{2}\z"

# --- Fixed values: columns read for the curated layer and columns it holds ------------------------
CURATED_INPUT = (
    "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "situacao_cadastral",
    "nome_fantasia", "data_inicio_atividade", "municipio", "uf", "cnae_fiscal_principal",
)
CURATED_OUTPUT = (
    "cnpj_completo", "cnpj_basico", "cnpj_ordem", "cnpj_dv", "establishment_type",
    "registration_status", "nome_fantasia", "data_inicio_atividade", "municipio", "uf",
    "cnae_fiscal_principal",
)

# --- Fixed values: code dictionaries --------------------------------------------------------------
STATUS_LABELS = {1: "NULA", 2: "ATIVA", 3: "SUSPENSA", 4: "INAPTA", 8: "BAIXADA"}
TYPE_LABELS = {1: "Matriz", 2: "Filial"}
UNMAPPED = "UNKNOWN"
ACTIVE = "ATIVA"
HEADQUARTERS = "Matriz"
BRANCH = "Filial"
TARGET_CITY = "7107"

# --- Fixed values: file format, archive names and entry suffixes ----------------------------------
CSV_FORMAT = {
    "sep": ";",
    "encoding": "ISO-8859-1",
    "header": "false",
    "mode": "PERMISSIVE",
    "quote": '"',
    "escape": '"',
}
ARCHIVES = {
    "estabelecimentos": [f"Estabelecimentos{index}.zip" for index in range(10)],
    "municipios": ["Municipios.zip"],
}
EXACT_SUFFIX = ".csv"
ANY_CASE_SUFFIX = ".ESTABELE"

# --- Fixed values: snapshot names and report formats ----------------------------------------------
SNAPSHOT_FORMATS = ("%Y-%m", "%Y-%m-%d")
MONTH_PATTERN = r"\d{4}-(0[1-9]|1[0-2])"
ISO_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss"
PARTITION = "dt_ingestion"


# --- Fixed values: names of checks and of headline figures ----------------------------------------
INPUT_CHECKS = ("has_minimum_records", "has_required_fields", "null_rate_acceptable")
BUSINESS_CHECKS = (
    "only_sao_paulo", "valid_types", "valid_statuses", "valid_cnpj_format", "record_count_in_range",
    "ratio_in_range",
)
OUTPUT_CHECKS = ("sum_matches_silver", "no_null_keys", "has_active_records", "stable_vs_previous")
HEADLINES = ("matriz_active", "filial_active", "total_active", "ratio_filial_matriz")


@dataclass(frozen=True)
class Rules:
    """Target cities and the limits of every check; fixed published values as defaults."""

    cities: tuple[str, ...] = (TARGET_CITY,)
    max_corrupt_rate: float = 0.01
    max_misfit_share: float = 0.5
    min_bronze_rows: int = 10_000_000
    max_null_rate: float = 0.05
    min_silver_rows: int = 1_000_000
    max_silver_rows: int = 10_000_000
    min_ratio: float = 0.01
    max_ratio: float = 1.0
    stability: float = 0.10
    # Curated files: about 256 MB.
    file_bytes: int = 256 << 20
