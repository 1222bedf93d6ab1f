"""The registered query of the license scan, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartorio.llm.licenses import GAPS, NOTICES, ScanSettings, license_notices


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a license notice, by license."""
    return license_notices(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    """All shingles of all documents against all notices, by window, without any hashing."""
    settings = ScanSettings()
    values = ", ".join(
        f"({number}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')"
        for number, (name, text) in enumerate(NOTICES)
    )
    parts = " || ' ' || ".join(f"words[pos + {step}]" for step in range(settings.shingle))

    def shingles(table: str, keys: str) -> str:
        return f"""(
            SELECT {keys}, pos - 1 AS place, {parts} AS shingle
            FROM (SELECT {keys}, words, unnest(range(1, len(words) - {settings.shingle - 2})) AS pos
                  FROM (SELECT {keys}, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
                                   '{GAPS}'), lambda w: w <> '') AS words FROM {table})
                  WHERE len(words) >= {settings.shingle}))"""

    return f"""
        WITH notices(number, license, text) AS (VALUES {values}),
        wanted AS (SELECT DISTINCT number, license, shingle FROM {shingles('notices', 'number, license')}),
        sized AS (SELECT number, license, count(*) AS n,
                         pow(2, ceil(log2(count(*))))::INTEGER AS stride FROM wanted GROUP BY ALL),
        hits AS (SELECT doc_id, number, place, shingle
                 FROM {shingles('documents', 'doc_id')} JOIN wanted USING (shingle)),
        windows AS (
            SELECT doc_id, number, shingle, unnest([place // stride - 1, place // stride]) AS win,
                   stride, n, license
            FROM hits JOIN sized USING (number)),
        held AS (SELECT doc_id, license, number, win * stride AS begin_word, stride,
                        count(DISTINCT shingle) / n AS containment
                 FROM windows WHERE win >= 0 GROUP BY doc_id, license, number, win, stride, n),
        best AS (SELECT doc_id, license, containment, begin_word::INTEGER AS begin_word, stride
                 FROM held WHERE containment >= {settings.containment}
                 QUALIFY row_number() OVER (PARTITION BY doc_id, license
                                            ORDER BY containment DESC, begin_word, stride) = 1),
        rivals AS (SELECT DISTINCT a.license AS one, b.license AS other
                   FROM wanted a JOIN wanted b USING (shingle)
                   JOIN sized p ON p.number = a.number JOIN sized q ON q.number = b.number
                   WHERE a.license <> b.license GROUP BY a.license, b.license, a.number, b.number
                   HAVING count(*) >= {settings.containment} * least(any_value(p.n), any_value(q.n)))
        SELECT doc_id, license, containment, begin_word FROM best a
        WHERE NOT EXISTS (
            SELECT 1 FROM best b JOIN rivals ON one = a.license AND other = b.license
            WHERE b.doc_id IS NOT DISTINCT FROM a.doc_id AND b.containment > a.containment
                AND b.begin_word < a.begin_word + 2 * a.stride AND a.begin_word < b.begin_word + 2 * b.stride)"""


SQL = {"op1_license_scan": _sql()}
