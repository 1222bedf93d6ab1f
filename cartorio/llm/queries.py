"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartorio.llm import (
    ann_queries, corpus_queries, edit_queries, license_queries, negative_queries, quality_queries,
    spelling_queries, url_queries,
)
from cartorio.llm.byte_bpe import Vocabulary, decoded_texts, encode
from cartorio.llm.ragged import taken
from cartorio.llm.token_counts import token_counts

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- 8: encoding and decoding ---------------------------------------------------------------------


@cache
def _decimals(highest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every id as decimal digits and a space, with begin and length."""
    words = [b"%d " % number for number in range(highest + 1)]
    lengths = np.array([len(word) for word in words])
    return np.frombuffer(b"".join(words), np.uint8), np.cumsum(lengths) - lengths, lengths


def _digests(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
    data, starts, lengths = _decimals(len(vocabulary.lengths) - 1)
    joined = taken(data, starts[ids], lengths[ids]).tobytes()
    ends = np.concatenate([[0], np.cumsum(lengths[ids])])[offsets].tolist()
    lists = [joined[begin : max(begin, end - 1)] for begin, end in zip(ends, ends[1:])]
    texts = decoded_texts(vocabulary, ids, offsets)
    return {
        "n_tokens": pa.array(np.diff(offsets), pa.int64()),
        "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in lists]),
        "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in texts]),
    }


@_query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        derive=_digests, fields="n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )


# --- 10: token counts -----------------------------------------------------------------------------


@_query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


for _module in (
    license_queries, ann_queries, edit_queries, url_queries, corpus_queries, negative_queries, quality_queries,
    spelling_queries,
):
    _QUERIES.update({name: f for name, f in vars(_module).items() if name.startswith("op")})
    _SQL.update(getattr(_module, "SQL", {}))


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle() -> dict[str, str]:
    return dict(_SQL)
