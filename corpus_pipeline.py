"""A corpus made ready for training: five stages, each over all that the one before has kept.

Toxic documents go, one document of each group of near copies stays, personal values become pseudonyms,
the sources are mixed to their target shares, and the mixture is encoded. Every stage is written to the
shared folder and read again as the next one's documents.

``run`` on an empty table gives an empty table; how null, empty, very long and repeated texts and
columns of any further name fare is said in each operator's module.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.llm import byte_bpe, corpus_queries, mixing, ngram_join, pii, toxicity
from cartorio.sources.scratch import fresh_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain of classifiers, trained on the labelled ones among them, lets pass."""
    settings, names = toxicity.ChainSettings(), corpus_queries.CATEGORIES
    chain = toxicity.train(docs, corpus_queries.labels(spark, sf_dir), names, settings)
    into, taken = "toxicity", {name.lower() for name in docs.columns}
    while into in taken:
        into += "_"
    found = toxicity.scored(docs, chain, names, into=into)
    return found.filter(F.col(f"{into}.toxic") < settings.threshold).select(*_named(docs))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of documents linked by similar shingles the one of smallest id."""
    return ngram_join.deduplicated(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms in their texts and the length that follows."""
    made = pii.with_pseudonyms(docs, corpus_queries.PSEUDONYM_KEY, spans=None)
    if "n_chars" not in docs.columns:
        return made
    length = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return made.withColumn("n_chars", length)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it."""
    return mixing.repeated(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document of the mixture, and the byte at which each token begins."""
    return byte_bpe.encode(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), keys=["doc_id", "lang", "source"]
    )


def _named(docs: DataFrame) -> list[str]:
    return [f"`{name}`" for name in docs.columns]


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("n-gram Jaccard join", without_near_copies),
    ("PII", without_personal_data),
    ("mixing sources to target weights", mixed_sources),
    ("byte-level BPE encoding and decoding", encoded),
]

#: The first stage is a trained classifier, which SQL cannot express; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = fresh_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/stage{number}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/stage{number}")
    return docs
