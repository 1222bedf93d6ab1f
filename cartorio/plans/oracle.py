"""The same results in ANSI SQL over the given tables, for the DuckDB side of the comparison."""

from __future__ import annotations

from cartorio.fixed import CHECK_WEIGHTS, CRITICAL_FIELDS, CURATED_INPUT, REQUIRED_FIELDS
from cartorio.plans.queries import (
    ASKED_NAME,
    CITY_NAME,
    CURRENT,
    LAST_DAY,
    LOADED_AT,
    PREVIOUS,
    PROFILED,
    SOME_CITIES,
    UNLISTED_NAME,
)
from cartorio.plans.registry import BROKEN, SPELLED, select_list
from cartorio.sources.layouts import RAW, RAW_NAMES

REGISTRY = f"""
registry AS (
  SELECT {", ".join(select_list("strftime(o_orderdate, '%Y%m%d')"))}
  FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

SILVER = REGISTRY + """,
silver AS (
  SELECT cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj_completo,
         cnpj_basico, cnpj_ordem, cnpj_dv,
         CASE identificador_matriz_filial WHEN 1 THEN 'Matriz' WHEN 2 THEN 'Filial'
              ELSE 'UNKNOWN' END AS establishment_type,
         CASE situacao_cadastral WHEN 1 THEN 'NULA' WHEN 2 THEN 'ATIVA' WHEN 3 THEN 'SUSPENSA'
              WHEN 4 THEN 'INAPTA' WHEN 8 THEN 'BAIXADA' ELSE 'UNKNOWN' END AS registration_status,
         nome_fantasia, data_inicio_atividade, municipio, uf, cnae_fiscal_principal
  FROM registry
  WHERE municipio = '7107' AND situacao_cadastral IS NOT NULL
    AND identificador_matriz_filial IN (1, 2)
)"""

GOLD = SILVER + """,
gold AS (
  SELECT establishment_type, registration_status, count(*) AS "count"
  FROM silver GROUP BY establishment_type, registration_status
)"""

SNAPSHOTS = SILVER + "," + ",".join(f"""
gold_{side} AS (
  SELECT '{month}' AS dt_ingestion, establishment_type, registration_status, count(*) AS "count"
  FROM silver WHERE data_inicio_atividade <= '{LAST_DAY[month]}'
  GROUP BY establishment_type, registration_status
)""" for side, month in (("previous", PREVIOUS), ("current", CURRENT)))


# Curated rows that come through the text files whole, and their counts.
SOUND_ROWS = SILVER + """,
sound AS (SELECT s.* FROM silver s JOIN registry r ON s.cnpj_basico = r.cnpj_basico
          AND s.cnpj_ordem = r.cnpj_ordem AND s.cnpj_dv = r.cnpj_dv
          WHERE r.record_no % 499 NOT IN (1, 2, 3))"""
SOUND_GOLD = SOUND_ROWS + """,
gold AS (
  SELECT establishment_type, registration_status, count(*) AS "count"
  FROM sound GROUP BY establishment_type, registration_status
)"""


def _with(views: str, body: str) -> str:
    return f"WITH {views}\n{body}"


def _sum_where(condition: str, source: str = "gold") -> str:
    return (f"(SELECT CAST(coalesce(sum(\"count\") FILTER ({condition}), 0) AS BIGINT) "
            f"FROM {source})")


HEADQUARTERS = "registration_status = 'ATIVA' AND establishment_type = 'Matriz'"
BRANCHES = "registration_status = 'ATIVA' AND establishment_type = 'Filial'"
ACTIVE = "registration_status = 'ATIVA'"
RATIO = "CASE WHEN {m} > 0 THEN {f} / {m} ELSE 0.0 END"


def _summary(source: str, prefix: str = "") -> str:
    return f"""{_sum_where(HEADQUARTERS, source)} AS {prefix}matriz_active,
       {_sum_where(BRANCHES, source)} AS {prefix}filial_active"""


def _rate(field: str) -> str:
    return (f"CASE WHEN count(*) > 0 THEN CAST(count(*) - count({field}) AS DOUBLE) / count(*) "
            "ELSE 0.0 END")


def _per_field(select: str) -> str:
    return "\nUNION ALL\n".join(
        select.format(
            position=position, field=field.name, type=field.dataType.simpleString(),
            required=str(not field.nullable).lower(),
            critical=str(field.name in CRITICAL_FIELDS).lower(), rate=_rate(field.name),
        )
        for position, field in enumerate(RAW, start=1)
    )


def _weighted(text: str, weights) -> str:
    terms = (f"{weight} * (ascii(substr({text}, {at}, 1)) - 48)" for at, weight in enumerate(weights, start=1))
    return f"({' + '.join(terms)})"


def _digit(total: str) -> str:
    return f"CASE WHEN {total} % 11 < 2 THEN 0 ELSE 11 - {total} % 11 END"


FIRST_DIGIT = _digit(_weighted("stem", CHECK_WEIGHTS[1:]))
SECOND_DIGIT = _digit(f"({_weighted('stem', CHECK_WEIGHTS[:12])} + {CHECK_WEIGHTS[12]} * first)")


def _input_checks(fields, present: str = "true") -> str:
    return _with(REGISTRY, f"""
SELECT *, has_minimum_records AND has_required_fields AND null_rate_acceptable AS all_checks_passed
FROM (
  SELECT record_count, worst_null_rate, record_count >= 10000000 AS has_minimum_records,
         {present} AS has_required_fields, worst_null_rate <= 0.05 AS null_rate_acceptable
  FROM (SELECT count(*) AS record_count,
               greatest({", ".join(_rate(name) for name in fields)}) AS worst_null_rate
        FROM registry))""")


def _business(rows: str = "silver", least: int = 1_000_000) -> str:
    return f"""
  SELECT *, only_sao_paulo AND valid_types AND valid_statuses AND valid_cnpj_format
            AND record_count_in_range AND ratio_in_range AS all_checks_passed
  FROM (
    SELECT *, rows_elsewhere = 0 AS only_sao_paulo, odd_types = 0 AS valid_types,
           odd_statuses = 0 AS valid_statuses, odd_ids = 0 AS valid_cnpj_format,
           record_count BETWEEN {least} AND 10000000 AS record_count_in_range,
           filial_matriz_ratio BETWEEN 0.01 AND 1.0 AS ratio_in_range
    FROM (
      SELECT *, {RATIO.format(m="matriz_count", f="filial_count")} AS filial_matriz_ratio
      FROM (
        SELECT count(*) AS record_count,
               count(*) FILTER (municipio <> '7107') AS rows_elsewhere,
               count(*) FILTER (establishment_type IS NULL
                                OR establishment_type NOT IN ('Matriz', 'Filial')) AS odd_types,
               count(*) FILTER (registration_status IS NULL OR registration_status NOT IN
                 ('NULA', 'ATIVA', 'SUSPENSA', 'INAPTA', 'BAIXADA')) AS odd_statuses,
               count(*) FILTER (length(cnpj_completo) <> 14) AS odd_ids,
               count(*) FILTER (establishment_type = 'Matriz') AS matriz_count,
               count(*) FILTER (establishment_type = 'Filial') AS filial_count
        FROM {rows})))"""


def _output(silver: str, gold: str, previous: str | None) -> str:
    before = f", {_sum_where(ACTIVE, previous)} AS previous_active" if previous else ""
    stable = (
        "CASE WHEN previous_active > 0 "
        "THEN abs((active - previous_active) / previous_active) ELSE 0.0 END <= 0.1"
        if previous else "true"
    )
    return f"""
  SELECT *, sum_matches_silver AND no_null_keys AND has_active_records AND stable_vs_previous
            AS all_checks_passed
  FROM (
    SELECT *, gold_sum IS NOT DISTINCT FROM silver_rows AS sum_matches_silver,
           null_types = 0 AND null_statuses = 0 AS no_null_keys,
           active > 0 AS has_active_records, {stable} AS stable_vs_previous
    FROM (
      SELECT (SELECT count(*) FROM {silver}) AS silver_rows,
             (SELECT CAST(sum("count") AS BIGINT) FROM {gold}) AS gold_sum,
             (SELECT count(*) FROM {gold} WHERE establishment_type IS NULL) AS null_types,
             (SELECT count(*) FROM {gold} WHERE registration_status IS NULL) AS null_statuses,
             {_sum_where(ACTIVE, gold)} AS active{before}))"""


COMPARISON = _with(SNAPSHOTS, f"""
SELECT '{CURRENT}' AS current_date, '{PREVIOUS}' AS previous_date, current_total, previous_total,
       round_even(moved, 4) AS variance, round_even(moved * 100, 2) AS variance_pct,
       abs(moved) <= 0.1 AS within_threshold,
       current_matriz_active, current_filial_active,
       round_even({RATIO.format(m="current_matriz_active", f="current_filial_active")}, 2)
         AS current_ratio_filial_matriz,
       previous_matriz_active, previous_filial_active,
       round_even({RATIO.format(m="previous_matriz_active", f="previous_filial_active")}, 2)
         AS previous_ratio_filial_matriz
FROM (
  SELECT *, CASE WHEN previous_total > 0
                 THEN (current_total - previous_total) / previous_total ELSE 0.0 END AS moved
  FROM (
    SELECT *, current_matriz_active + current_filial_active AS current_total,
           previous_matriz_active + previous_filial_active AS previous_total
    FROM (SELECT {_summary("gold_current", "current_")},
                 {_summary("gold_previous", "previous_")})))""")

OUTPUT = _output(
    f"(SELECT * FROM silver WHERE data_inicio_atividade <= '{LAST_DAY[CURRENT]}')",
    "gold_current", "gold_previous",
)

QUOTED = {
    name: f"""'"' || replace(coalesce(CAST({name} AS VARCHAR), ''), '"', '""') || '"'"""
    for name in RAW_NAMES
}
LINE = " || ';' || ".join(QUOTED.values())
SHORT_LINE = " || ';' || ".join(list(QUOTED.values())[:12])
TEXT_LINE = " || ';' || ".join({**QUOTED, "situacao_cadastral": """'"xx"'"""}.values())
WRITTEN = (f"""CASE record_no % 499 WHEN 1 THEN {SHORT_LINE} WHEN 2 THEN {LINE} || ';"more"' """
           f"WHEN 3 THEN {TEXT_LINE} ELSE {LINE} END")
SOUND = "record_no % 499 NOT IN (1, 2, 3)"
DAMAGED = "record_no % 499 IN (1, 2, 3)"
EXPECTED = """
snapshots AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS dt_ingestion FROM orders),
files AS (
  SELECT 'estabelecimentos' AS file_type, 'Estabelecimentos' || i || '.zip' AS file_name
  FROM range(10) numbers(i)
  UNION ALL SELECT 'municipios', 'Municipios.zip'
),
expected AS (SELECT dt_ingestion, file_type, file_name FROM snapshots CROSS JOIN files)"""

_ORACLE = {
    "gold_counts": _with(GOLD, "SELECT * FROM gold"),
    "silver_rows": _with(SILVER, "SELECT * FROM silver"),
    "silver_pruned": _with(REGISTRY, f"SELECT {', '.join(CURATED_INPUT)} FROM registry"),
    "active_counts": _with(GOLD, f"SELECT * FROM gold WHERE {ACTIVE}"),
    "gold_total": _with(
        GOLD, 'SELECT CAST(sum("count") AS BIGINT) AS total, count(*) AS groups FROM gold'
    ),
    "type_distribution": _with(
        SILVER, 'SELECT establishment_type, count(*) AS "count" FROM silver GROUP BY 1'
    ),
    "status_distribution": _with(
        SILVER, 'SELECT registration_status, count(*) AS "count" FROM silver GROUP BY 1'
    ),
    "distinct_labels": _with(SILVER, """
SELECT DISTINCT 'establishment_type' AS "column", establishment_type AS label FROM silver
UNION ALL
SELECT DISTINCT 'registration_status', registration_status FROM silver"""),
    "quality_metrics": _with(SILVER, f"""
SELECT *, {RATIO.format(m="matriz_count", f="filial_count")} AS filial_matriz_ratio
FROM (SELECT count(*) AS total_records,
             count(*) FILTER (establishment_type = 'Matriz') AS matriz_count,
             count(*) FILTER (establishment_type = 'Filial') AS filial_count,
             count(*) FILTER (registration_status = 'ATIVA') AS active_count FROM silver)"""),
    "quality_distributions": _with(SILVER, """
SELECT 'status' AS dimension, registration_status AS label, count(*) AS "count"
FROM silver GROUP BY 2
UNION ALL
SELECT 'type', establishment_type, count(*) FROM silver GROUP BY 2"""),
    "null_rates": _with(REGISTRY, _per_field(
        "SELECT '{field}' AS \"column\", {rate} AS null_rate FROM registry"
    )),
    "column_profile": _with(REGISTRY, "\nUNION ALL\n".join(f"""
SELECT '{name}' AS "column", count(*) AS "rows", count({name}) AS filled, {_rate(name)} AS null_rate,
       count(DISTINCT {name}) AS n_distinct, true AS distinct_within, true AS median_within
FROM registry""" for name in PROFILED)),
    "schema_describe": _with(REGISTRY, _per_field(
        "SELECT count(*) AS \"rows\", {position} AS position, '{field}' AS field, "
        "'{type}' AS type, {required} AS required, {critical} AS critical, "
        "count({field}) AS filled FROM registry"
    )),
    "summary_report": _with(GOLD, f"""
SELECT *, ratio_filial_matriz BETWEEN 0.01 AND 1.0 AS ratio_expected
FROM (SELECT *, matriz_active + filial_active AS total_active,
             round_even({RATIO.format(m="matriz_active", f="filial_active")}, 2)
               AS ratio_filial_matriz
      FROM (SELECT {_summary("gold")}))"""),
    "summary_breakdown": _with(GOLD, f"""
SELECT establishment_type, registration_status, "count", '{CURRENT}' AS dt_ingestion,
       strftime(TIMESTAMP '{LOADED_AT}', '%Y-%m-%dT%H:%M:%S') AS ts_aggregation FROM gold"""),
    "compare_snapshots": COMPARISON,
    "input_checks": _input_checks(RAW_NAMES),
    "input_checks_required": _input_checks(REQUIRED_FIELDS),
    "input_checks_absent": _input_checks(
        [name for name in REQUIRED_FIELDS if name != "municipio"], "false"
    ),
    "id_checks": _with(REGISTRY, """
SELECT *, null_cnpj_basico = 0 AS has_cnpj_basico, null_cnpj_ordem = 0 AS has_cnpj_ordem,
       null_cnpj_dv = 0 AS has_cnpj_dv,
       null_cnpj_basico = 0 AND null_cnpj_ordem = 0 AND null_cnpj_dv = 0 AS all_checks_passed
FROM (SELECT count(*) FILTER (cnpj_basico IS NULL) AS null_cnpj_basico,
             count(*) FILTER (cnpj_ordem IS NULL) AS null_cnpj_ordem,
             count(*) FILTER (cnpj_dv IS NULL) AS null_cnpj_dv FROM registry)"""),
    "id_digit_checks": _with(REGISTRY, f"""
SELECT *, wrong_digits / ids AS bad_rate, wrong_digits / ids <= 0.0 AS digits_acceptable
FROM (SELECT count(*) AS ids, CAST(0 AS BIGINT) AS null_ids, CAST(0 AS BIGINT) AS malformed_ids,
             count(*) FILTER (record_no % 3 = 0 AND cnpj_dv <> digits) AS wrong_digits
      FROM (SELECT *, CAST(first AS VARCHAR) || CAST({SECOND_DIGIT} AS VARCHAR) AS digits
            FROM (SELECT *, {FIRST_DIGIT} AS first
                  FROM (SELECT record_no, cnpj_dv, cnpj_basico || cnpj_ordem AS stem FROM registry))))"""),
    "doubled_ids": _with(REGISTRY, """
SELECT cnpj_completo, count(*) AS copies
FROM (SELECT cnpj_basico || cnpj_ordem || cnpj_dv AS cnpj_completo FROM registry
      UNION ALL
      SELECT cnpj_basico || cnpj_ordem || cnpj_dv FROM registry WHERE record_no % 50 = 0)
GROUP BY 1 HAVING count(*) > 1"""),
    "stability_history": _with(SILVER.replace("municipio = '7107' AND ", ""), """
SELECT dt_ingestion, establishment_type, registration_status, "count", n_past, median, deviation, gap_months,
       n_past < 3 OR abs("count" - median) <= greatest(3.0 * 1.4826 * deviation, 0.02 * median) AS stable
FROM (SELECT *, CAST(coalesce(len(past), 0) AS INTEGER) AS n_past,
             list_median(list_transform(past, lambda x: abs(x - median))) AS deviation,
             CAST(coalesce(date_diff('month', strptime(last || '-01', '%Y-%m-%d'),
                                     strptime(dt_ingestion || '-01', '%Y-%m-%d')) - 1, 0) AS INTEGER) AS gap_months
      FROM (SELECT *, list_median(past) AS median
            FROM (SELECT *, list("count") OVER (PARTITION BY establishment_type, registration_status
                             ORDER BY dt_ingestion ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS past,
                         lag(dt_ingestion) OVER (PARTITION BY establishment_type, registration_status
                             ORDER BY dt_ingestion) AS last
                  FROM (SELECT substr(data_inicio_atividade, 1, 4) || '-' || substr(data_inicio_atividade, 5, 2)
                               AS dt_ingestion, establishment_type, registration_status, count(*) AS "count"
                        FROM silver GROUP BY ALL))))"""),
    "business_checks": _with(SILVER, _business()),
    "output_checks": _with(SNAPSHOTS, OUTPUT),
    "output_checks_first": _with(GOLD, _output("silver", "gold", None)),
    "reconciliation": _with(GOLD, """
SELECT *, gold_sum IS NOT DISTINCT FROM silver_rows AS matches
FROM (SELECT (SELECT CAST(sum("count") AS BIGINT) FROM gold) AS gold_sum,
             (SELECT count(*) FROM silver) AS silver_rows)"""),
    "run_gate": _with(SNAPSHOTS, f"""
SELECT *, business_passed AND output_passed AS all_passed
FROM (SELECT (SELECT all_checks_passed FROM ({_business()})) AS business_passed,
             (SELECT all_checks_passed FROM ({OUTPUT})) AS output_passed)"""),
    "city_lookup_semi": _with(REGISTRY, f"""
SELECT {', '.join(CURATED_INPUT)} FROM registry
WHERE municipio IN (SELECT CAST(7100 + n_nationkey AS VARCHAR) FROM nation
                    WHERE n_name = '{CITY_NAME}')"""),
    "city_lookup_named": _with(REGISTRY, f"""
SELECT {', '.join(CURATED_INPUT)}, n_name AS city_name
FROM registry LEFT JOIN nation
  ON municipio = CAST(7100 + n_nationkey AS VARCHAR) AND n_name <> '{UNLISTED_NAME}'"""),
    "city_lookup_folded": _with(REGISTRY, f"""
SELECT {', '.join(CURATED_INPUT)} FROM registry
WHERE municipio IN (
  SELECT CAST(7100 + n_nationkey AS VARCHAR) FROM (SELECT n_nationkey, n_name AS name FROM nation)
  WHERE lower(strip_accents(regexp_replace(trim({SPELLED}), '\\s+', ' ', 'g')))
      = lower(strip_accents(regexp_replace(trim('{ASKED_NAME}'), '\\s+', ' ', 'g'))))"""),
    "city_lookup_counts": _with(GOLD, "SELECT * FROM gold"),
    "unknown_city_codes": _with(REGISTRY, f"""
SELECT municipio, count(*) AS "count" FROM registry
WHERE municipio NOT IN (SELECT CAST(7100 + n_nationkey AS VARCHAR) FROM nation
                        WHERE n_name <> '{UNLISTED_NAME}')
GROUP BY municipio"""),
    "file_manifest": _with(EXPECTED, "SELECT * FROM expected"),
    "manifest_gaps": _with(EXPECTED, """
SELECT * FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM orders
                  WHERE strftime(o_orderdate, '%Y-%m') = e.dt_ingestion
                    AND 'Estabelecimentos' || (o_orderkey % 10) || '.zip' = e.file_name)"""),
    "manifest_doubled": _with(EXPECTED, """
SELECT dt_ingestion, file_type, file_name, copies FROM expected JOIN (
  SELECT strftime(o_orderdate, '%Y-%m') AS dt_ingestion,
         'Estabelecimentos' || (o_orderkey % 10) || '.zip' AS file_name, count(*) AS copies
  FROM orders GROUP BY 1, 2 HAVING count(*) > 1) USING (dt_ingestion, file_name)"""),
    "snapshot_names": """
SELECT o_orderkey % 5 IN (0, 1) AS is_snapshot, o_orderkey % 5 = 0 AS is_month, count(*) AS "count"
FROM orders GROUP BY ALL""",
    "month_guards": f"""
SELECT month, month = '{CURRENT}' AS has_rows FROM (VALUES ('{PREVIOUS}'), ('{CURRENT}'), ('1999-01')) t(month)""",
    "layout_misfits": """
SELECT 'cities' AS folder, count(*) AS lines, 1.0::DOUBLE AS least_share FROM orders
HAVING count(*) > 0""",
    "corrupt_rate": _with(REGISTRY, f"""
SELECT *, CASE WHEN total > 0 THEN corrupt / total ELSE 0.0 END AS corrupt_rate,
       CASE WHEN total > 0 THEN corrupt / total ELSE 0.0 END <= 0.01 AS acceptable
FROM (SELECT count(*) AS total, count(*) FILTER ({DAMAGED}) AS corrupt FROM registry)"""),
    "csv_roundtrip": _with(REGISTRY, f"""
SELECT {', '.join(RAW_NAMES)}, '{CURRENT}' AS dt_ingestion FROM registry WHERE {SOUND}"""),
    "csv_multiline": _with(REGISTRY, f"""
SELECT {', '.join(f"{BROKEN.get(name, name)} AS {name}" for name in RAW_NAMES)}, '{CURRENT}' AS dt_ingestion
FROM registry WHERE {SOUND}"""),
    "arrivals_stream": _with(REGISTRY, f"""
SELECT {', '.join(RAW_NAMES)}, '{CURRENT}' AS dt_ingestion FROM registry WHERE {SOUND}"""),
    "csv_quarantine": _with(REGISTRY, f"""
SELECT {WRITTEN} AS raw_line,
       '{CURRENT}' AS dt_ingestion
FROM registry WHERE {DAMAGED}"""),
    "layer_roundtrip": _with(SNAPSHOTS, """
SELECT * FROM gold_previous UNION ALL SELECT * FROM gold_current"""),
    "month_versions": _with(SNAPSHOTS + """,
gold_all AS (
  SELECT establishment_type, registration_status, count(*) AS "count"
  FROM silver GROUP BY establishment_type, registration_status
)""", f"""
SELECT '{CURRENT}' AS dt_ingestion, establishment_type, registration_status, "count", 3 AS version FROM gold_all
UNION ALL
SELECT '{CURRENT}', establishment_type, registration_status, "count", 2 FROM gold_current"""),
    "gold_from_partials": _with(SILVER.replace(
        "municipio = '7107'", f"municipio IN {SOME_CITIES} AND (record_no % 10 <> 3 OR record_no % 20 = 3)"
    ), """
SELECT establishment_type, registration_status, count(*) AS "count" FROM silver GROUP BY ALL"""),
    "clustered_city_rows": _with(SILVER, "SELECT * FROM silver"),
    "layer_comparison": COMPARISON,
    "monthly_run": _with(SOUND_ROWS, _business(rows="sound", least=0)),
    "monthly_full": _with(SOUND_GOLD, f"""
SELECT *, business_passed AND output_passed AS all_passed,
       ratio_filial_matriz BETWEEN 0.01 AND 1.0 AS ratio_expected
FROM (SELECT *, matriz_active + filial_active AS total_active,
             round_even({RATIO.format(m="matriz_active", f="filial_active")}, 2)
               AS ratio_filial_matriz
      FROM (SELECT (SELECT all_checks_passed FROM ({_business(rows="sound", least=0)})) AS business_passed,
                   (SELECT all_checks_passed FROM ({_output("sound", "gold", None)})) AS output_passed,
                   (SELECT CAST(sum("count") AS BIGINT) FROM gold) AS total,
                   (SELECT count(*) FROM gold) AS groups, {_summary("gold")}))"""),
    "monthly_rerun": _with(SOUND_GOLD, f"""
SELECT *, '{CURRENT}' AS dt_ingestion FROM gold"""),
    "archive_manifest": _with(REGISTRY, f"""
SELECT true AS all_exist, true AS all_valid, true AS all_filled, true AS all_passed,
       CAST(sum(length({WRITTEN}) + 1) AS BIGINT) AS bytes, CAST(0 AS BIGINT) AS problems
FROM registry"""),
    "archive_ingest": _with(REGISTRY, f"""
SELECT municipio, count(*) AS "count" FROM registry WHERE {SOUND} GROUP BY municipio"""),
}


def oracle() -> dict[str, str]:
    return dict(_ORACLE)
