"""Small helpers that every operator of this subpackage shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows of a few dozen bytes that are broadcast at most.
FEW = 100_000
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a session that runs on this machine alone (tests) may lack one, and gets a temporary folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir is not set: on a cluster, name a folder that all its machines share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage there.

    The rows, always few bytes each, are first rebalanced into partitions of the advisory size, so that a table is a
    few files and not one per task.
    """
    checkpoint_folder(df.sparkSession)
    return df.hint("rebalance").checkpoint(eager=True)


def dealt_checkpoint(df: DataFrame) -> DataFrame:
    """``checkpoint`` of rows that need no rebalancing: they come from a shuffle, or are as many as a scan's partitions."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_few(df: DataFrame, most: int = FEW) -> DataFrame:
    """A checkpointed table of short rows, to be broadcast if it was counted to have at most ``most``, else to be joined by a shuffle."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def whole_ids(docs: DataFrame, id_col: str) -> None:
    """Refuses ids that are not whole numbers, before any work is done."""
    kind = docs.schema[id_col].dataType
    if not isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        raise TypeError(f"{id_col} is {kind.simpleString()}; this operator takes whole numbers as ids")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes the byte-wise ``lower``, the rest ``translate``."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def text_of(name: str = "text") -> Column:
    """The text column, null read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
