"""Keyed state: what a stream has seen of each key, held by Spark's state store and forgotten by timers.

Nothing that was written before is read again: a batch costs what it holds. State lives in the RocksDB store, so it may
outgrow an executor's memory; keys that have not been met for ``forget`` of event time leave it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks(spark: SparkSession):
    """Queries that start inside keep their state in RocksDB."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


#: The column that brings event times to the processors.
_MS = "event_millis_of_state"


class _Forgetting(StatefulProcessor):
    """Holds the latest event time of its key, and forgets the key when the watermark is ``forget`` past it."""

    def __init__(self, forget: timedelta | None):
        self.forget = None if forget is None else int(forget.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "millis long")

    def _met(self, first: int | None, latest: int | None) -> bool:
        """Notes sightings from ``first`` to ``latest``; whether the key was known, and not long ago.

        A batch's rows come before its timers, so a key that is due to be forgotten is told by its times.
        """
        held, first, latest = self.last.exists(), first or 0, latest or 0
        if not held and self.forget is not None:
            self.handle.registerTimer(latest + self.forget)
        last = self.last.get()[0] if held else None
        if last is None or last < latest:
            self.last.update((latest,))
        return held and (self.forget is None or first <= last + self.forget)

    def _drop(self) -> None:
        self.last.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.last.exists():
            due = self.last.get()[0] + self.forget
            if due > expiredTimerInfo.getExpiryTimeInMs():
                self.handle.registerTimer(due)
            else:
                self._drop()
        yield from ()

    def close(self) -> None:
        pass


def _later(latest: int | None, millis) -> int | None:
    return latest if pd.isna(millis) else int(millis) if latest is None else max(latest, int(millis))


class _FirstSeen(_Forgetting):
    """Lets the earliest row of a key pass, once."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first, latest = None, None
        for df in rows:
            own = df.sort_values(_MS, kind="stable").iloc[[0]]
            if first is None or own[_MS].iloc[0] < first[_MS].iloc[0]:
                first = own
            latest = _later(latest, df[_MS].max())
        if not self._met(_later(None, first[_MS].iloc[0]), latest):
            yield first.drop(columns=_MS)


class _LatestRun(_Forgetting):
    """Holds the highest run of a key and how many rows it has."""

    def __init__(self, keys: list[str], run: str, forget: timedelta | None):
        super().__init__(forget)
        self.keys, self.run = keys, run

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.best = handle.getValueState("best", "run long, n long")

    def _drop(self) -> None:
        super()._drop()
        self.best.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        best, n = self.best.get() if self.best.exists() else (None, 0)
        latest = None
        for df in rows:
            top = int(df[self.run].max())
            if best is None or top > best:
                best, n = top, 0
            n += int((df[self.run] == best).sum())
            latest = _later(latest, df[_MS].max())
        self._met(latest, latest)
        self.best.update((best, n))
        yield pd.DataFrame({**{k: [v] for k, v in zip(self.keys, key, strict=True)}, self.run: [best], "n": [n]})


def _timed(rows: DataFrame, at: str | None, lateness: str) -> tuple[DataFrame, str]:
    if at is None:
        return rows.withColumn(_MS, F.lit(0).cast("long")), "none"
    return rows.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, lateness).withColumn(_MS, F.unix_millis(at)), "eventTime"


def first_seen(rows: DataFrame, key: str = "url", at: str | None = None, forget: timedelta = timedelta(days=90), lateness: str = "1 day") -> DataFrame:
    """Each key's first row (the earliest of the batch in which it appears), once; rows without a key go.

    With an event-time column ``at``, a key that was not met for ``forget`` is new again.
    """
    timed, mode = _timed(rows.filter(F.col(key).isNotNull()), at, lateness)
    return timed.groupBy(key).transformWithStateInPandas(_FirstSeen(forget if at else None), timed.drop(_MS).schema, "Append", mode)


def latest_runs(entries: DataFrame, keys: list[str], run: str = "run_id", at: str | None = None, forget: timedelta = timedelta(days=365), lateness: str = "1 day") -> DataFrame:
    """For every key that a batch touches: keys, its highest run so far, and n, the rows of that run. Keys are not null."""
    timed, mode = _timed(entries, at, lateness)
    schema = T.StructType([*(entries.schema[k] for k in keys), T.StructField(run, T.LongType()), T.StructField("n", T.LongType())])
    return timed.groupBy(*keys).transformWithStateInPandas(_LatestRun(keys, run, forget if at else None), schema, "Update", mode)


def to_table(rows: DataFrame, table: str, checkpoint: str, mode: str = "append", available_now: bool = True) -> StreamingQuery:
    """Each batch's rows written once under their batch's number, however often it is tried."""

    def batch(out: DataFrame, number: int) -> None:
        out.write.mode("overwrite").parquet(f"{table}/batch={number}")

    with rocks(rows.sparkSession):
        writer = rows.writeStream.outputMode(mode).foreachBatch(batch).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def latest_of(table: DataFrame, keys: list[str]) -> DataFrame:
    """Of a table of updates the last row of each key."""
    rest = [c for c in table.columns if c not in (*keys, "batch")]
    return table.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_row")).select(*keys, "_row.*")
