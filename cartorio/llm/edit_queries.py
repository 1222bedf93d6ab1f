"""The registered query of the document fingerprints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cartorio.llm.edit_embedding import END, bands, class_of, codes_in, likeness, linked, walk, written
from cartorio.llm.in_order import descending_runs, successors
from cartorio.sources.scratch import fresh_folder
from cartorio.sources.settings import small_batches

GROUP_BYTES = 4 << 20
_ENDED = np.array([END], np.uint8)
#: From this likeness on documents are linked.
LEAST = 0.8

FIELDS = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, edited_found boolean"
)


def op4_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document beside its edited text (the last third gives way to the beginning of the next
    document) and the next document; ``edited_found``: a band leads from one to the other.
    ``group_key`` and ``n_links``: the group of documents linked by their fingerprints, and the number of
    other documents like this one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = fresh_folder(spark, "edits")
    with small_batches(spark, GROUP_BYTES):
        made = written(with_edits(docs), folder, "made")
    found = linked(made, LEAST, folder, "doc_id")
    return made.withColumn("class", class_of("fingerprint")).join(found, "class").select(
        *made.columns, "group_key", "n_links"
    )


def with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return descending_runs(docs, key, text).mapInArrow(_compared, FIELDS)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, texts in successors(batches, GROUP_BYTES):
        n = len(keys)
        read = [text.decode() for text in texts]
        # Codes of one text at a time: places and codepoints of all would take many times the texts' bytes.
        codes = [codes_in(text) for text in read]
        lengths = np.array([len(text) for text in read])
        given = lengths[:-1] // 3
        taken = np.minimum(given, lengths[1:])
        kept = lengths[:-1] - given
        cuts = list(zip(range(n), kept.tolist(), taken.tolist()))
        digests = [
            hashlib.sha256(read[at][:a].encode() + read[at + 1][:b].encode()).hexdigest() for at, a, b in cuts
        ]
        everything = np.concatenate([
            *(part for own in codes for part in (own, _ENDED)),
            *(part for at, a, b in cuts for part in (codes[at][:a], codes[at + 1][:b], _ENDED)),
        ])
        del texts, read, codes
        found = walk(everything, np.concatenate([lengths, kept + taken]))
        own, other = found[:n], found[n + 1 :]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(lengths[:-1], pa.int64()), pa.array(digests, pa.string()),
             pa.array(own, pa.string()), pa.array(other, pa.string()),
             pa.array([likeness(*pair) for pair in zip(own, other)], pa.float64()),
             pa.array([likeness(*pair) for pair in zip(own, found[1 : n + 1])], pa.float64()),
             pa.array([not set(bands(a)).isdisjoint(bands(b)) for a, b in zip(own, other)], pa.bool_())],
            names=[field.split()[0] for field in FIELDS.split(", ")],
        )
