"""Fetching through a function that the caller supplies: url to (status, content type, bytes).

Requests run inside tasks, in Arrow batches; a failed one is a row with its error. Rounds of retries and of
following pages are driven here and write each round's rows once, so a lost executor repeats one round at most.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.functions.urls import file_suffix
from noticelake.sources.html import next_page

Fetcher = Callable[[str], tuple[int, str, bytes]]
RETRY_DELAYS = (10, 60, 400)
_PAGE = "_status int, _type string, _body binary, _error string"


def fetch(rows: DataFrame, fetcher: Fetcher, url: str = "url") -> DataFrame:
    """``rows`` with http_status, content_type, body and error. A null URL is an error."""

    # Not deterministic, so that no rewriting of the plan asks twice for one row.
    @F.pandas_udf(f"struct<{_PAGE.replace(' ', ':').replace(',:', ',')}>")
    def get(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for urls in batches:
            out = []
            for u in urls:
                try:
                    if not u:
                        raise ValueError("no URL")
                    status, kind, body = fetcher(u)
                    out.append((status, kind, body, None if status < 400 else f"HTTP {status}"))
                except Exception as e:  # any failure of a request is that row's own
                    out.append((None, None, None, f"{type(e).__name__}: {e}"))
            df = pd.DataFrame(out, columns=["_status", "_type", "_body", "_error"])
            yield df.assign(_status=df["_status"].astype("Int32"))

    got = rows.withColumn("_got", get.asNondeterministic()(F.col(url)))
    return got.select(*rows.columns, F.col("_got._status").alias("http_status"), F.col("_got._type").alias("content_type"), F.col("_got._body").alias("body"), F.col("_got._error").alias("error"))


def fetch_with_fallback(rows: DataFrame, fetcher: Fetcher, url: str = "url", fallback: str = "fallback_url") -> DataFrame:
    """As ``fetch``; where the first answer is 404, the second URL is asked. Adds used_fallback."""

    def both(pair: str) -> tuple[int, str, bytes]:
        first, second = pair.split("\x00")
        status, kind, body = fetcher(first)
        if status != 404 or not second:
            return status, kind, body
        status, kind, body = fetcher(second)
        return status, f"\x00{kind}", body

    pair = F.when(F.col(url) != "", F.concat(F.col(url), F.lit("\x00"), F.coalesce(F.col(fallback), F.lit(""))))
    got = fetch(rows.withColumn("_pair", pair), both, "_pair").drop("_pair")
    marked = F.coalesce(F.col("content_type").startswith("\x00"), F.lit(False))
    return got.withColumn("used_fallback", marked).withColumn("content_type", F.translate("content_type", "\x00", ""))


def in_rounds(rows: DataFrame, attempt: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, int], DataFrame], delays: tuple[int, ...] = RETRY_DELAYS, sleep: Callable[[float], None] = time.sleep, url: str = "url") -> DataFrame:
    """``attempt`` adds error and others to rows. Failed rows only are tried again, after each of ``delays``.

    ``write`` stores a round's rows and returns them read back. A row without a URL fails for good.
    """
    done, left = None, rows
    for number in range(len(delays) + 1):
        got = write(attempt(left), number)
        again = got.filter(F.col("error").isNotNull() & F.col(url).isNotNull())
        if number == len(delays) or again.isEmpty():
            return got if done is None else done.unionByName(got)
        settled = got.filter(F.col("error").isNull() | F.col(url).isNull())
        done = settled if done is None else done.unionByName(settled)
        left = again.select(*rows.columns)
        sleep(delays[number])
    raise AssertionError


def fetch_with_retries(rows: DataFrame, fetcher: Fetcher, write: Callable[[DataFrame, int], DataFrame], delays: tuple[int, ...] = RETRY_DELAYS, sleep: Callable[[float], None] = time.sleep, url: str = "url") -> DataFrame:
    """As ``fetch``, in rounds."""
    return in_rounds(rows, lambda left: fetch(left, fetcher, url), write, delays, sleep, url)


def crawl(first: DataFrame, fetcher: Fetcher, write: Callable[[DataFrame, int], DataFrame], base: str) -> DataFrame:
    """``first``: url of each list's first page. Follows each list to its last page; rows get their page number.

    Each page leads to the one with the next number at most, so a list ends where its numbers do.
    """
    left, pages, number = first.select("url").withColumn("page", F.lit(1)), None, 0
    while True:
        number += 1
        got = write(fetch(left, fetcher).withColumn("html", F.decode("body", "UTF-8")), number)
        pages = got if pages is None else pages.unionByName(got)
        left = got.filter("error IS NULL").select(next_page("html", F.col("page"), F.lit(base)).alias("url")).filter("url IS NOT NULL").withColumn("page", F.lit(number + 1))
        if left.isEmpty():
            return pages


def stored_name(rows: DataFrame) -> DataFrame:
    """Adds file_name: ``orig`` with the suffix of the content type."""
    return rows.withColumn("file_name", F.concat(F.lit("orig"), file_suffix(F.col("content_type"))))
