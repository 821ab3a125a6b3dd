"""Rows that several steps read, worked out once and kept in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; only a session on this machine alone (tests) may lack it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir is not set: on a cluster, name a folder that all its machines share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def kept(rows: DataFrame) -> DataFrame:
    """``rows``, written to the shared folder and read from there: the work behind them is done once, and not again if an executor is lost."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint(eager=True)


def open_store(folder: str):
    """The file system that a folder's address names, for code in tasks, and the folder's path in it."""
    from pyarrow import fs

    where = urlparse(folder)
    if where.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(where.path)
    return fs.FileSystem.from_uri(folder)
