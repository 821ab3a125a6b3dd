"""Status entries as an append-only table; a run replaces what earlier runs said about its documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticelake.functions.dates import stamp


def entries(rows: DataFrame, level: str | Column, text: Column, at: Column, run_id: int, source: str) -> DataFrame:
    """One status row per row of ``rows``, which has kraj, okres and doc_id (null: about the district, region or source)."""
    have = lambda c: F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string")
    kind = F.lit(level) if isinstance(level, str) else level
    return rows.select(
        F.lit(source).alias("source"), have("kraj").alias("kraj"), have("okres").alias("okres"), have("doc_id").alias("doc_id"), F.lit(run_id).cast("long").alias("run_id"), stamp(at).alias("date"), kind.alias("type"), text.alias("text")
    )


def append(status: DataFrame, path: str, step: str = "run") -> None:
    """Adds a run's entries. A run that is repeated replaces what it wrote in the same step, so nothing is said twice."""
    rows = status.withColumn("step", F.lit(step))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source", "run_id", "step").parquet(path)


def latest_run(status: DataFrame) -> DataFrame:
    """Of each document's entries those of its last run."""
    last = F.max("run_id").over(Window.partitionBy("source", "kraj", "okres", "doc_id"))
    return status.withColumn("_last", last).filter("run_id = _last").drop("_last")


def faults(rows: DataFrame) -> DataFrame:
    """Rows that cannot be processed, with ``fault``: why."""
    blank = F.trim(F.coalesce("url", F.lit(""))) == ""
    fault = F.when(blank, "Invalid or empty URL").when(F.coalesce("kraj", F.lit("")) == "", "Missing region").when(F.coalesce("okres", F.lit("")) == "", "Missing district")
    return rows.withColumn("fault", fault).filter("fault IS NOT NULL")
