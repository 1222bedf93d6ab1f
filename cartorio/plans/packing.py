"""Raw extract files packed into zip archives, one archive per file, on the executors."""

from __future__ import annotations

import shutil
import sys
import zipfile
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame

from cartorio.sources.archives import CHUNK, flat_map, locate


def _packer(target: str) -> Callable[[dict], list[dict]]:
    def packed(row: dict) -> list[dict]:
        files, path = locate(row["path"])
        into, folder = locate(target)
        into.create_dir(folder, recursive=True)
        name = "-".join(path.split("/")[-2:])
        with (
            into.open_output_stream(f"{folder}/{name}.zip") as sink,
            zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive,
        ):
            archive.writestr("LEIAME.txt", "registro")
            with (
                files.open_input_stream(path) as lines,
                archive.open(f"{name}.Estabele", "w", force_zip64=True) as entry,
            ):
                shutil.copyfileobj(lines, entry, CHUNK)
        return [{"archive": f"{target}/{name}.zip"}]

    return packed


def pack_files(landed: DataFrame, target: str, manifest: str) -> DataFrame:
    """Packs every file (column ``path``) and returns the archives; runs once, into a table."""
    columns = "archive string"
    flat_map(landed.select("path"), _packer(target), columns).write.parquet(manifest)
    return landed.sparkSession.read.schema(columns).parquet(manifest)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
