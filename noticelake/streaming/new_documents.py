"""Listings as a stream: every snapshot that arrives yields the documents not seen before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from noticelake.functions.urls import doc_id
from noticelake.streaming import state


def read(spark, path: str, schema: str) -> DataFrame:
    """JSON array files of a folder, one snapshot each, as they arrive."""
    return spark.readStream.schema(schema).option("multiLine", True).json(path)


def first_seen(listing: DataFrame, seen_at: str | None = None, lateness: str = "90 days") -> DataFrame:
    """Each URL once, with its id. With an event-time column, its state is dropped once the watermark has passed."""
    keyed = listing.filter("url IS NOT NULL").withColumn("doc_id", doc_id(F.col("url")))
    if seen_at is None:
        return keyed.dropDuplicates(["url"])
    return keyed.withWatermark(seen_at, lateness).dropDuplicatesWithinWatermark(["url"])


def append_new(listing: DataFrame, table: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Appends each batch's new documents to a Parquet table, once per batch even if it is repeated.

    Which URLs were seen is keyed state, so a batch reads nothing of what was written before.
    """
    return state.to_table(state.first_seen(listing), table, checkpoint, available_now=available_now)


def status_counts(entries: DataFrame, at: str = "ts", level: str = "type", window: str = "1 hour", lateness: str = "2 hours") -> DataFrame:
    """Entries per level and window; late ones count until the watermark."""
    counted = entries.withWatermark(at, lateness).groupBy(F.window(at, window), level).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("since"), level, "n")
