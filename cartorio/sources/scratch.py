"""The shared folder for intermediate tables."""

from __future__ import annotations

import logging
import re
import uuid
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, or else a part of the warehouse.

    Every executor must see it, as it must see the warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if private(warehouse, spark.conf.get("spark.master", "local")):
        log.warning("spark.checkpoint.dir isn't set and the warehouse %s may be the driver's own: "
                    "executors elsewhere won't see intermediate tables", warehouse)
    return f"{warehouse}/_scratch"


def private(folder: str, master: str) -> bool:
    """Whether a folder lies on the driver's own disk while tasks run on other machines."""
    scheme = urlsplit(folder).scheme
    return scheme in ("", "file") and re.fullmatch(r"local(\[.*\])?", master) is None


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A folder of its own for one run."""
    return f"{shared_folder(spark)}/cartorio/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder that this library wrote, on whatever file system it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
