"""A site of numbered pages as a data source of Spark, to be read whole or as a stream.

The caller supplies the fetcher, from an address to (status, content type, bytes). The number of the last page is found
by doubling steps and halving them, so planning asks for a few pages only. Partitions are runs of page numbers: their
pages are asked for in the task that reads them, and a task that fails asks for its own run again and no other page.
A stream's offset is the last page taken; a restart goes on after it, and pages that appear later come with the next
batch. A page that fails is a row with its error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

Fetcher = Callable[[str], tuple[int, str, bytes]]
PAGE = "page long, url string, http_status int, content_type string, body binary, error string"
_TYPES = {"page": pa.int64(), "url": pa.string(), "http_status": pa.int32(), "content_type": pa.string(), "body": pa.binary(), "error": pa.string()}
#: Pages of a partition, and bytes of a batch of rows.
RUN = 50
_BATCH = 16_000_000


@dataclass
class Run(InputPartition):
    """The pages from ``first`` to before ``end``."""

    first: int
    end: int


def last_page(exists: Callable[[int], bool], known: int = 0) -> int:
    """The last page of a site without gaps, from ``known``, which exists (0: none is known)."""
    low, step = known, 1
    while exists(low + step):
        low, step = low + step, step * 2
    high = low + step
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if exists(middle) else (low, middle)
    return low


def _runs(first: int, end: int, size: int) -> list[Run]:
    return [Run(at, min(end, at + size)) for at in range(first, end, size)]


class _Pages:
    """What both readers share."""

    def __init__(self, fetcher: Fetcher, options: dict[str, str]):
        self.fetcher, self.address = fetcher, options["address"]
        self.run, self.limit = int(options.get("run", RUN)), int(options.get("last", 0))

    def url(self, page: int) -> str:
        return self.address.replace("{page}", str(page))

    def exists(self, page: int) -> bool:
        return self.fetcher(self.url(page))[0] != 404

    def last(self, known: int) -> int:
        return self.limit or last_page(self.exists, known)

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for page in range(partition.first, partition.end):
            url = self.url(page)
            try:
                status, kind, body = self.fetcher(url)
                row = (page, url, status, kind, body, None if status < 400 else f"HTTP {status}")
            except Exception as e:  # a page's failure is its row's own
                row = (page, url, None, None, None, f"{type(e).__name__}: {e}")
            rows.append(row)
            size += len(row[4] or b"")
            if size >= _BATCH:
                yield self._batch(rows)
                rows, size = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES.values(), strict=True)], list(_TYPES))


class _Reader(_Pages, DataSourceReader):
    def partitions(self) -> list[Run]:
        # Spark wants one partition at least.
        return _runs(1, self.last(0) + 1, self.run) or [Run(1, 1)]


class _StreamReader(_Pages, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"last": 0}

    def latestOffset(self) -> dict:
        self.seen = self.last(getattr(self, "seen", 0))
        return {"last": self.seen}

    def partitions(self, start: dict, end: dict) -> list[Run]:
        self.seen = max(getattr(self, "seen", 0), end["last"])
        return _runs(start["last"] + 1, end["last"] + 1, self.run)

    def commit(self, end: dict) -> None:
        """Nothing is held for pages that were taken."""


def register(spark: SparkSession, fetcher: Fetcher, name: str = "site") -> str:
    """Makes ``spark.read.format(name)`` and ``spark.readStream.format(name)`` read through ``fetcher``.

    Options: ``address`` with ``{page}`` in it; ``run``, the pages of a partition; ``last``, the last page where it is known.
    """

    class Site(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return PAGE

        def reader(self, schema):
            return _Reader(fetcher, self.options)

        def streamReader(self, schema):
            return _StreamReader(fetcher, self.options)

    spark.dataSource.register(Site)
    return name


# A site made of a table ----------------------------------------------------------------------------------------------

#: Pages of a stored bundle.
BUNDLE = 100


def store_site(pages, folder: str) -> None:
    """``pages``: page (from 1), body (string). Written in bundles that ``stored_site`` serves."""
    from pyspark.sql import functions as F

    bundle = F.floor(F.col("page") / BUNDLE)
    pages.select(bundle.alias("bundle"), "page", "body").repartition("bundle").sortWithinPartitions("page").write.partitionBy("bundle").parquet(folder)


def stored_site(folder: str) -> Fetcher:
    """A fetcher over a stored site; the page is what follows the last '='. Workers hold one bundle at a time."""
    held: dict = {}

    def get(url: str) -> tuple[int, str, bytes]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        from noticelake.sources.stored import open_store

        page = int(url.rsplit("=", 1)[1])
        bundle = page // BUNDLE
        if bundle not in held:
            held.clear()
            store, path = open_store(folder)
            listed = store.get_file_info(fs.FileSelector(f"{path}/bundle={bundle}", allow_not_found=True))
            files = [x.path for x in listed if x.path.endswith(".parquet") and x.size]
            tables = [pq.ParquetFile(store.open_input_file(f)).read(columns=["page", "body"]) for f in files]
            held[bundle] = {p: b for t in tables for p, b in zip(t["page"].to_pylist(), t["body"].to_pylist(), strict=True)}
        body = held[bundle].get(page)
        return (404, "", b"") if body is None else (200, "text/html", body.encode())

    return get
