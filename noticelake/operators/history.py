"""The history of many snapshots: in which of them each key was listed, as intervals, and what was listed at any time.

A listing's versions are numbered. A row that stays the same from version to version is kept once, with the first and
the last version of each unbroken run (gaps and islands), so a history of n snapshots that change little is about the
size of one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def intervals(snapshots: DataFrame, key: str = "url", version: str = "version") -> DataFrame:
    """``snapshots``: rows of all versions. One row per key, content and unbroken run of versions: all columns but the version, since, until.

    Versions are the numbers 1, 2, 3, …; repeated rows of a version count once. A changed row ends one run and begins the next.
    """
    columns = [c for c in snapshots.columns if c != version]
    rows = snapshots.groupBy(*columns, version).agg(F.lit(1).alias("_once")).drop("_once")
    # Within a run, the version grows as fast as the row's number among its equals.
    place = F.row_number().over(Window.partitionBy(*columns).orderBy(version))
    runs = rows.withColumn("_run", F.col(version) - place)
    return runs.groupBy(*columns, "_run").agg(F.min(version).alias("since"), F.max(version).alias("until")).drop("_run")


def extended(history: DataFrame, snapshot: DataFrame, version: int) -> DataFrame:
    """The history with the next snapshot: runs that reach the version before it go on, other rows begin a run. Only open runs are joined."""
    columns = [c for c in history.columns if c not in ("since", "until")]
    open_, closed = history.filter(F.col("until") == version - 1), history.filter(F.col("until") < version - 1)
    new = snapshot.select(*columns).distinct().select(F.struct(*columns).alias("_new"))
    old = open_.select(F.struct(*columns).alias("_old"), "since", "until")
    same = [F.col(f"_old.`{c}`").eqNullSafe(F.col(f"_new.`{c}`")) for c in columns]
    both = old.join(new, same, "full")
    pick = F.coalesce("_new", "_old")
    row = [F.col(f"_row.`{c}`").alias(c) for c in columns]
    until = F.when(F.col("_new").isNotNull(), F.lit(version)).otherwise(F.col("until"))
    done = both.select(pick.alias("_row"), F.coalesce("since", F.lit(version)).alias("since"), until.alias("until"))
    return closed.unionByName(done.select(*row, F.col("since").cast(history.schema["since"].dataType).alias("since"), F.col("until").cast(history.schema["until"].dataType).alias("until")))


def as_of(history: DataFrame, version: int | Column) -> DataFrame:
    """The rows listed in a version."""
    at = F.lit(version) if isinstance(version, int) else version
    return history.filter((F.col("since") <= at) & (F.col("until") >= at)).drop("since", "until")


def as_of_each(history: DataFrame, asked: DataFrame, version: str, key: str = "url") -> DataFrame:
    """``asked``: key and version. Each with the content that its key had then; without a match, nulls.

    Runs and questions are sorted together by key and version in one pass; a key's runs do not overlap, so the last run
    that began is the only one that can hold the question.
    """
    content = [c for c in history.columns if c not in (key, "since", "until")]
    run = F.struct(*content, F.col("until").alias("_until"))
    null = F.lit(None)
    runs = history.select(F.col(key).alias("_k"), F.col("since").cast("long").alias("_v"), F.lit(0).alias("_side"), run.alias("_run"), null.cast(asked.schema.simpleString()).alias("_asked"))
    asks = asked.select(F.col(key).alias("_k"), F.col(version).cast("long").alias("_v"), F.lit(1).alias("_side"), null.cast(runs.schema["_run"].dataType).alias("_run"), F.struct(*asked.columns).alias("_asked"))
    over = Window.partitionBy("_k").orderBy("_v", "_side").rowsBetween(Window.unboundedPreceding, 0)
    told = runs.unionByName(asks).withColumn("_last", F.last("_run", ignorenulls=True).over(over)).filter("_side = 1")
    held = F.col("_last._until") >= F.col("_v")
    return told.select("_asked.*", *(F.when(held, F.col(f"_last.`{c}`")).alias(c) for c in content))
