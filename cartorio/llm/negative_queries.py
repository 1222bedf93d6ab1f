"""The registered query of the hard negatives, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.llm.negatives import mined, usable


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every hundredth vector the negatives that come close to each of its five best positives."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mined(usable(table, label), F.col("vec_id") % 100 == 0)


SQL = {
    "op12_hard_negatives": """
        WITH sound AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                list_inner_product(a.v, b.v)::BIGINT AS score
            FROM sound a JOIN sound b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
        ), positives AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
        )
        SELECT anchor_id, positive_id,
            row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
            other_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10""",
}
