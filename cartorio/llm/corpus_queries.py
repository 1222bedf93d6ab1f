"""The registered queries over the corpus that are thin calls of an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.llm import mixing, ngram_join, pii, toxicity

#: Stands in for a secret that a deployment would take from its store.
PSEUDONYM_KEY = b"demonstration key, not a secret"

#: The chain, in order: what is poor is told first, and helps to tell what is toxic.
CATEGORIES = ("poor", "toxic")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return table.select("doc_id", (1 - F.col("quality")).alias("poor"), "toxic")


def op3_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with pseudonyms, and where they stand."""
    rows = _documents(spark, sf_dir).select("doc_id", "text")
    return pii.with_pseudonyms(rows, PSEUDONYM_KEY)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_documents(spark, sf_dir))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its class of copies, its group of near ones, and its number of links."""
    found = ngram_join.similar(_documents(spark, sf_dir))
    return found.select(
        F.col("key").alias("doc_id"), F.col("group_key").alias("group_id"),
        F.col("class_key").alias("copy_id"), "n_links",
    )


def _ngram_sql() -> str:
    """All pairs of documents that share a shingle, and the groups they link."""
    settings = ngram_join.JoinSettings()
    width = settings.shingle
    run = " || ' ' || ".join(f"w[p + {step}]" for step in range(width))
    return f"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
                '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id,
                CASE WHEN len(w) < {width} THEN array_to_string(w, ' ') ELSE {run} END AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {width - 2}, 2))) AS p
                  FROM words WHERE len(w) > 0)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), pairs AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
            FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL
        ), near AS (
            SELECT x, y, c = p.n AND c = q.n AS same
            FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
            WHERE c / (p.n + q.n - c) >= {settings.threshold}
        ), reach AS (
            SELECT doc_id, doc_id AS r FROM documents
            UNION SELECT reach.doc_id, near.y FROM reach JOIN near ON near.x = reach.r
        )
        SELECT doc_id, min(r) AS group_id,
            least(doc_id, (SELECT min(y) FROM near WHERE x = doc_id AND same)) AS copy_id,
            (SELECT count(*) FROM near WHERE x = doc_id) AS n_links
        FROM reach GROUP BY doc_id"""


SQL = {"op7_ngram_join": _ngram_sql()}


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.judged(
        _documents(spark, sf_dir), labels(spark, sf_dir), CATEGORIES, "toxic", keep=["doc_id"]
    )
    return found.select(
        "doc_id", *(F.col(f"probabilities.{name}").alias(f"p_{name}") for name in CATEGORIES),
        F.col("rejected").alias("is_toxic"),
    )
