"""The registered query of the URL filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartorio.llm.urls import ALLOW, BLOCK, LOWER, UPPER, Rule, UrlPolicy, judged_urls

POLICY = UrlPolicy(rules=(
    Rule(ALLOW, "org"), Rule(BLOCK, "example.org", "/es/"), Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"), Rule(BLOCK, "com", "/de/"),
))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), POLICY)


def _sql() -> str:
    rules = sorted(POLICY.rules, key=lambda rule: -len(rule.text))
    fits = {
        rule: f"(host = '{rule.host}' OR ends_with(host, '.{rule.host}'))"
              f" AND starts_with(path, '{rule.path}')"
        for rule in rules
    }

    def hits(terms: tuple[str, ...]) -> str:
        return " + ".join(
            f"regexp_matches(low, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')::INTEGER" for term in terms
        )

    return f"""
        WITH parts AS (
            SELECT page_id,
                translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                          '{UPPER}', '{LOWER}') AS host,
                regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path,
                translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS low
            FROM pages
        ), found AS (
            SELECT *,
                CASE {" ".join(f"WHEN {fits[r]} THEN '{r.text}'" for r in rules)} END AS rule,
                CASE {" ".join(f"WHEN {fits[r]} THEN '{r.verdict}'" for r in rules)} END AS ruled,
                ({hits(POLICY.strict)})::INTEGER AS strict_terms,
                ({hits(POLICY.soft)})::INTEGER AS soft_terms
            FROM parts
        )
        SELECT page_id, host, path, rule,
            coalesce(ruled, CASE WHEN strict_terms > 0 OR soft_terms >= {POLICY.soft_needed}
                THEN '{BLOCK}' ELSE '{ALLOW}' END) AS verdict,
            strict_terms, soft_terms
        FROM found"""


SQL = {"op6_url_filter": _sql()}
