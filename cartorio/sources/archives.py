"""Zip archives: integrity and expansion, spread over the executors entry by entry.

Only paths travel through Spark. A task opens an archive on the shared file system through Arrow
(local or mounted paths, ``hdfs://``, ``s3a://``, ``gs://``), reads one entry as a stream of small
chunks and, when expanding, writes it beside the others. No archive and no entry is ever held whole.
"""

from __future__ import annotations

import hashlib
import io
import re
import shutil
import sys
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import IO

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.fixed import ANY_CASE_SUFFIX, EXACT_SUFFIX
from cartorio.sources.scratch import fresh_folder

CHUNK = 1 << 20
NOT_A_ZIP = "not a readable zip archive"
NO_DATA = "no data entry"
# The last: an encrypted entry, or one packed by a method unknown here.
DAMAGE = (zipfile.BadZipFile, zlib.error, EOFError, RuntimeError)

ENTRIES = "archive string, file_exists boolean, is_zip boolean, number int, entry string"
EXPANDED = "archive string, entry string, path string, bytes bigint, problem string"


def locate(uri: str, store: dict[str, str] | None = None) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a path as Spark spells it.

    ``store`` holds the session's ``fs.s3a`` settings, which Arrow doesn't read by itself.
    """
    plain = re.sub(r"^file:/+", "/", uri)
    if plain.startswith("/"):
        return arrow_fs.LocalFileSystem(), plain
    if store and (found := re.match(r"s3[an]?://(.*)", plain)):
        return arrow_fs.S3FileSystem(**s3_options(store)), found[1]
    return arrow_fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", plain))


# Names of the object-store settings.
S3A = "spark.hadoop.fs.s3a."
S3A_NAMES = ("access.key", "secret.key", "session.token", "endpoint", "endpoint.region",
             "path.style.access", "connection.ssl.enabled")


def store_settings(spark: SparkSession) -> dict[str, str]:
    """The session's object-store settings, by name without prefix."""
    found = {name: spark.conf.get(S3A + name, None) for name in S3A_NAMES}
    return {name: value for name, value in found.items() if value is not None}


def s3_options(store: dict[str, str]) -> dict[str, object]:
    """The same settings under the names of Arrow's file system."""
    endpoint = store.get("endpoint", "")
    scheme, _, host = endpoint.rpartition("://")
    secure = store.get("connection.ssl.enabled", "true") != "false"
    options: dict[str, object] = {
        "access_key": store.get("access.key"),
        "secret_key": store.get("secret.key"),
        "session_token": store.get("session.token"),
        "region": store.get("endpoint.region"),
        "endpoint_override": host or None,
        "scheme": scheme or ("https" if secure else "http"),
        "force_virtual_addressing": store.get("path.style.access", "false") != "true" if host else None,
    }
    return {name: value for name, value in options.items() if value is not None}


class _Stream(io.RawIOBase):
    """An Arrow file that refuses a seek before its start the way ``zipfile`` expects."""

    def __init__(self, file: pa.NativeFile) -> None:
        self._file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._file.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        try:
            return self._file.seek(offset, whence)
        except pa.ArrowInvalid as error:
            raise OSError(str(error)) from error

    def readinto(self, buffer) -> int:
        return self._file.readinto(buffer)

    def close(self) -> None:
        self._file.close()
        super().close()


@contextmanager
def _open(uri: str, store: dict[str, str] | None) -> Iterator[zipfile.ZipFile]:
    files, path = locate(uri, store)
    with (
        io.BufferedReader(_Stream(files.open_input_file(path)), CHUNK) as stream,
        zipfile.ZipFile(stream) as opened,
    ):
        yield opened


def flat_map(rows: DataFrame, function: Callable[[dict], list[dict]], columns: str) -> DataFrame:
    """What ``function`` makes of each row. A row is a file or an entry to stream, which takes long:
    rows are dealt out evenly, one by one, and results leave as they come."""
    kinds = {"string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "bigint": pa.int64()}
    fields = [column.split() for column in columns.split(", ")]
    schema = pa.schema([(name, kinds[kind]) for name, kind in fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist(function(row), schema=schema)

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks).mapInArrow(work, columns)


Work = Callable[[dict], list[dict]]


def _lister(store: dict[str, str]) -> Work:
    def entries_of(row: dict) -> list[dict]:
        """From the directory at the end of an archive; one row without entry if there is none."""
        found = {"archive": row["archive"], "file_exists": True, "is_zip": True}
        try:
            with _open(row["archive"], store) as opened:
                return [
                    {**found, "number": number, "entry": info.filename}
                    for number, info in enumerate(opened.infolist())
                ] or [found]
        except FileNotFoundError:
            return [{**found, "file_exists": False, "is_zip": False}]
        except DAMAGE:
            return [{**found, "is_zip": False}]

    return entries_of


def _tester(store: dict[str, str]) -> Work:
    def tested(row: dict) -> list[dict]:
        """Reads an entry to its end, where its checksum is compared."""
        if row["number"] is None:
            return [row]
        try:
            with _open(row["archive"], store) as opened, _entry(opened, row) as stream:
                while stream.read(CHUNK):
                    pass
            return [{**row, "intact": True}]
        except DAMAGE:
            return [{**row, "intact": False}]

    return tested


def _entry(opened: zipfile.ZipFile, row: dict) -> IO[bytes]:
    return opened.open(opened.infolist()[row["number"]])


def _expander(target: str, store: dict[str, str]) -> Work:
    def expanded(row: dict) -> list[dict]:
        """Streams one entry out. The final name appears only once the copy is whole and its
        checksum holds, so a task lost or run twice leaves nothing half-written under it."""
        result = {"archive": row["archive"], "entry": row["entry"]}
        if row["number"] is None:
            return [{**result, "problem": NO_DATA if row["is_zip"] else NOT_A_ZIP}]
        files, folder = locate(target, store)
        mark = hashlib.md5(row["archive"].encode()).hexdigest()
        home = f"{row['archive'].rsplit('/', 1)[-1].removesuffix('.zip')}-{mark}"
        name = f"{home}/{row['number']:06d}-{row['entry'].rsplit('/', 1)[-1]}"
        partial = f"{folder}/{home}/_{uuid.uuid4().hex}"
        files.create_dir(f"{folder}/{home}", recursive=True)
        try:
            with _open(row["archive"], store) as opened, _entry(opened, row) as source:
                with files.open_output_stream(partial) as sink:
                    shutil.copyfileobj(source, sink, CHUNK)
                    size = sink.tell()
        except DAMAGE as error:
            files.delete_file(partial)
            return [{**result, "problem": str(error)}]
        files.move(partial, f"{folder}/{name}")
        return [{**result, "path": f"{target}/{name}", "bytes": size}]

    return expanded


def list_entries(archives: DataFrame) -> DataFrame:
    """One row per entry of each archive (column ``archive``: its path)."""
    store = store_settings(archives.sparkSession)
    return flat_map(archives.select("archive"), _lister(store), ENTRIES)


def check_archives(archives: DataFrame) -> DataFrame:
    """One row per archive: it exists, every entry's checksum holds, it has entries."""
    tester = _tester(store_settings(archives.sparkSession))
    tested = flat_map(list_entries(archives), tester, f"{ENTRIES}, intact boolean")
    valid = F.bool_and("is_zip") & F.coalesce(F.bool_and("intact"), F.lit(True))
    verdicts = tested.groupBy("archive").agg(
        F.bool_and("file_exists").alias("file_exists"),
        valid.alias("is_valid_zip"),
        (valid & (F.count("entry") > 0)).alias("has_content"),
    )
    return verdicts.withColumn(
        "all_checks_passed", F.expr("file_exists AND is_valid_zip AND has_content")
    )


def expand_archives(archives: DataFrame, target: str) -> DataFrame:
    """Expands the data entries under ``target`` and returns the manifest of what came out.

    Damaged archives and entries, and archives without a data entry, are listed with their problem and
    do not stop the others. The manifest is a written table, so reading it never expands anything a
    second time; so is the list of entries, and each directory is read once for it.
    """
    spark = archives.sparkSession
    folder = fresh_folder(spark, "manifest")
    list_entries(archives).write.parquet(f"{folder}/entries")
    entries = spark.read.schema(ENTRIES).parquet(f"{folder}/entries")
    name = F.col("entry")
    wanted = F.coalesce(
        name.endswith(EXACT_SUFFIX) | F.upper(name).endswith(ANY_CASE_SUFFIX), F.lit(False)
    )
    barren = (
        entries.groupBy("archive", "file_exists", "is_zip").agg(F.bool_or(wanted).alias("any"))
        .filter(~F.col("any")).select(
            "archive", "file_exists", "is_zip", F.lit(None).cast("int").alias("number"),
            F.lit(None).cast("string").alias("entry"),
        )
    )
    expander = _expander(target, store_settings(spark))
    work = entries.filter(wanted).unionByName(barren)
    flat_map(work, expander, EXPANDED).write.parquet(f"{folder}/expanded")
    return spark.read.schema(EXPANDED).parquet(f"{folder}/expanded")


def require_expanded(manifest: DataFrame) -> None:
    """Refuses a manifest with problems: a month is built from all of its files or not at all."""
    problem = manifest.filter(F.col("problem").isNotNull()).first()
    if problem:
        raise ValueError(f"archive not expanded: {problem.asDict()}")


# The functions above run in Python workers that need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
