"""Delimited text whose quoted fields may hold line breaks, read in byte ranges like any other.

Whether a line break ends a record depends on whether the quotes before it, from the beginning of the
file, are even in number. That parity adds up: every byte range (a split of Spark's text reader) counts
its own quotes, a window over the ranges of a file gives the parity each one begins with, and then every
range is cut into records by itself. What begins in one range and ends in another comes as fragments,
at most one at each end of a range, and is put together by the range it began in. So files of any size
are read by many tasks, lines aren't shuffled, and only fragments meet.

A doubled quote inside a field counts two and changes nothing. A lone quote inside an unquoted field
does: the text up to the next quote counts as quoted, and a record that doesn't fit the layout for it is
damaged and kept whole, as ever. A file that ends inside quotes ends its last record there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio.fixed import CORRUPT_FIELD, CSV_FORMAT
from cartorio.sources.layouts import RAW, scan_schema

#: What comes out of a range: a whole record, or part of one that begins in range ``began``.
_CUT = "source_file string, began bigint, at bigint, whole boolean, record binary"


def text_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``line`` (as its bytes), whether its quotes are odd in number, ``source_file``, and of its range the
    begin ``at``, the ``bytes``, and whether it is the ``last`` of the file. The reader gives the lines of
    a range in order."""
    if not paths:
        raise ValueError("no files to read")
    lines = (
        spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true")
        .text(paths if isinstance(paths, str) else list(paths))
    )
    # Bytes, not characters: the text isn't UTF-8.
    rest = F.replace("value", F.lit(CSV_FORMAT["quote"]), F.lit(""))
    quotes = F.octet_length("value") - F.octet_length(rest)
    at, bytes_ = F.col("_metadata.file_block_start"), F.col("_metadata.file_block_length")
    return lines.select(
        F.col("value").cast("binary").alias("line"), (quotes % 2 == 1).alias("odd"),
        F.col("_metadata.file_path").alias("source_file"), at.alias("at"), bytes_.alias("bytes"),
        (at + bytes_ == F.col("_metadata.file_size")).alias("last"),
    )


def ranges_of(lines: DataFrame) -> DataFrame:
    """``source_file``, ``at``, ``bytes`` of each range, whether it is entered ``inside`` quotes, and where
    the record that it then continues ``began``."""
    ranges = lines.groupBy("source_file", "at").agg(F.count_if("odd").alias("flips"), F.max("bytes").alias("bytes"))
    before = Window.partitionBy("source_file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("inside", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2 == 1)
    odd = F.col("flips") % 2 == 1
    # A record is left open by a range that it begins in: entered outside quotes and left inside, or
    # entered and left inside but closed and opened between.
    opens = (odd & ~F.col("inside")) | (~odd & F.col("inside") & (F.col("flips") > 0))
    return ranges.withColumn("began", F.max(F.when(opens, F.col("at"))).over(before)).drop("flips")


def cut_lines(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, bool]:
    """Records and fragments (``_CUT``) of all files, and whether there are fragments at all."""
    lines = text_lines(spark, paths)
    ranges = ranges_of(lines)
    # The ranges entered inside quotes: few, and a row a range at most.
    inside = {(r.source_file, r.at): r.began for r in ranges.filter("inside").collect()}
    size = ranges.agg(F.max("bytes")).first()[0] or 0
    # Ranges depend on the session's settings and cores. Cut otherwise now, they would be taken for others.
    same = F.col("last") | (F.col("bytes") == size)
    checked = F.when(same, F.col("line")).otherwise(F.raise_error(F.lit("byte ranges have changed between the passes")))
    lines = lines.select(checked.cast("binary").alias("line"), "odd", "source_file", "at")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _cut(batches, inside)

    return lines.mapInArrow(task, _CUT), bool(inside)


def joined(cut: DataFrame) -> DataFrame:
    """``source_file`` and ``record`` of the records whose parts lie in several ranges."""
    parts = cut.filter("NOT whole").groupBy("source_file", "began").agg(
        F.array_sort(F.collect_list(F.struct("at", "record"))).alias("parts")
    )
    text = F.aggregate(
        F.slice("parts", F.lit(2), F.size("parts")), F.col("parts")[0]["record"],
        lambda text, part: F.concat(text, F.lit(b"\n"), part["record"]),
    )
    return parts.select("source_file", text.alias("record"))


def _cut(
    batches: Iterator[pa.RecordBatch], inside: dict[tuple[str, int], int]
) -> Iterator[pa.RecordBatch]:
    """Lines of ranges, in order, to records and fragments."""
    here: tuple[str, int] | None = None
    open_: list[bytes] = []  # lines of the record that isn't at its end yet
    quoted, began = False, -1
    carried = False  # the open record began in an earlier range

    def rest() -> Iterator[tuple]:
        """The end of a range: what is open goes on in the next one, or ends with the file."""
        if here is not None and open_:
            yield here[0], began if carried else here[1], here[1], False, b"\n".join(open_)

    for batch in batches:
        out: list[tuple] = []
        keys = list(zip(batch.column("source_file").to_pylist(), batch.column("at").to_pylist()))
        odd = batch.column("odd").to_numpy(zero_copy_only=False).astype(bool)
        lines = batch.column("line")
        begin = 0
        while begin < len(keys):
            if keys[begin] != here:
                out += rest()
                here, open_ = keys[begin], []
                carried = quoted = here in inside
                began = inside.get(here, here[1])
            end = begin
            while end < len(keys) and keys[end] == here:
                end += 1
            states = np.cumsum(odd[begin:end]) % 2 == 1
            states = ~states if quoted else states
            if not quoted and not states.any():  # every line is a record
                if out:
                    yield _batch(out)
                    out = []
                yield _plain(lines.slice(begin, end - begin), here)
                begin = end
                continue
            for line, still in zip(lines.slice(begin, end - begin).to_pylist(), states.tolist()):
                open_.append(line)
                if not still:
                    text = b"\n".join(open_)
                    out.append((here[0], began, here[1], False, text) if carried else (here[0], here[1], here[1], True, text))
                    open_, carried = [], False
            quoted = bool(states[-1])
            begin = end
        if out:
            yield _batch(out)
    if left := list(rest()):
        yield _batch(left)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
        names=["source_file", "began", "at", "whole", "record"],
    )


def _plain(lines: pa.Array, here: tuple[str, int]) -> pa.RecordBatch:
    n = len(lines)
    return pa.RecordBatch.from_arrays(
        [pa.array([here[0]] * n, pa.string()), pa.array(np.full(n, here[1])), pa.array(np.full(n, here[1])),
         pa.array(np.ones(n, bool)), lines.cast(pa.binary())],
        names=["source_file", "began", "at", "whole", "record"],
    )


def parsed(records: DataFrame, schema: T.StructType = RAW) -> DataFrame:
    """The fields of records, damaged ones whole in ``_corrupt_record``, and ``source_file``, as
    ``scan_extract`` gives them. An empty line is no record."""
    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in scan_schema(schema))
    options = {name: value for name, value in CSV_FORMAT.items() if name not in ("header", "encoding")}
    text = F.regexp_replace(F.decode("record", CSV_FORMAT["encoding"]), "\r$", "")
    row = F.from_csv("text", F.lit(fields), {**options, "columnNameOfCorruptRecord": CORRUPT_FIELD})
    return (
        records.select(text.alias("text"), "source_file").filter("text <> ''")
        .select(row.alias("row"), "source_file").select("row.*", "source_file")
    )
