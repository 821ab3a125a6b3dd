"""Pages deep in a sorted table without sorting it again: ordered files with cumulative counts.

The table is written once in its order, dealt by range into shares and, inside a share, into files of bounded length; one
row per file says how many rows lie before it. A page reads the files that its ranks fall into, and no other.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: Rows of a file, at most.
FILE_ROWS = 100_000
#: Files of a share, about, and shares, at most: the driver gets a sample for each share, and no row for a file.
SHARE_FILES, SHARES = 8, 512
_SHARE = "share"
_NUMBER = (1 << 33) - 1


def write(rows: DataFrame, order: list[Column], folder: str, file_rows: int = FILE_ROWS) -> DataFrame:
    """Writes ``rows`` in a total order and returns the index: share, before, rows, data, file (one row for each file)."""
    shares = min(SHARES, max(1, -(-rows.count() // (file_rows * SHARE_FILES))))
    data = f"{folder}/data-{uuid.uuid4().hex}"
    # The share leads the order, so that the writer need not sort again.
    ranged = rows.repartitionByRange(shares, *order).withColumn(_SHARE, F.spark_partition_id()).sortWithinPartitions(_SHARE, *order)
    ranged.withColumn("at", F.monotonically_increasing_id()).write.option("maxRecordsPerFile", file_rows).partitionBy(_SHARE).parquet(data)
    spark = rows.sparkSession
    # ``at`` numbers the rows of a share in order, on top of the share's own number.
    number = F.col("at").bitwiseAND(F.lit(_NUMBER))
    stored = spark.read.parquet(data).select(_SHARE, F.col("_metadata.file_name").alias("file"), number.alias("number"))
    files = stored.groupBy(_SHARE, "file").agg(F.min("number").alias("inside"), F.count(F.lit(1)).alias("rows"))
    files.write.parquet(f"{data}-files")
    files = spark.read.parquet(f"{data}-files")
    before, table = 0, []
    for r in sorted(files.groupBy(_SHARE).agg(F.sum("rows").alias("rows")).collect()):
        table.append((r[_SHARE], before))
        before += r["rows"]
    ahead = spark.createDataFrame(table, "share int, ahead long")
    found = files.join(F.broadcast(ahead), _SHARE).select(_SHARE, (F.col("ahead") + F.col("inside")).alias("before"), "rows", F.lit(data).alias("data"), "file", "ahead")
    found.write.mode("overwrite").parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def page(spark: SparkSession, folder: str, number: int, size: int = 100) -> DataFrame:
    """Page ``number`` (from 1) of a table that ``write`` stored, with ``rank`` (from 1)."""
    first = (number - 1) * size
    every = spark.read.parquet(f"{folder}/index")
    hit = every.filter((F.col("before") < first + size) & (F.col("before") + F.col("rows") > first)).orderBy("before").collect()
    if not hit:
        return _files(spark, [every.first()]).limit(0).withColumn("rank", F.lit(0).cast("long")).drop("at", _SHARE)
    before = F.lit(None).cast("long")
    for r in hit:
        before = F.when(F.col(_SHARE) == r[_SHARE], r["ahead"]).otherwise(before)
    inside = _files(spark, hit).filter(F.col(_SHARE).isin([r[_SHARE] for r in hit]))
    ranked = inside.withColumn("rank", before + F.col("at").bitwiseAND(F.lit(_NUMBER)) + 1)
    return ranked.filter((F.col("rank") > first) & (F.col("rank") <= first + size)).drop("at", _SHARE).orderBy("rank")


def _files(spark: SparkSession, index: list[Row]) -> DataFrame:
    """The given files of the data, and no listing of the others."""
    return spark.read.option("basePath", index[0]["data"]).parquet(*(f"{r['data']}/{_SHARE}={r[_SHARE]}/{r['file']}" for r in index))
