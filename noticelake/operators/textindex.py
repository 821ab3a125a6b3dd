"""An inverted index over trigrams for filters that look for a text inside a column.

A row that holds a text holds all its trigrams, so the rows of the rarest ones are the only candidates; each is then
checked. Postings are dealt by trigram and block of rows, so that a trigram found in a third of all rows is many rows
of bounded size, and a search reads the postings of a few trigrams only. Texts of under three characters are searched
without the index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3
#: Rows whose numbers share a posting, and trigrams that a search looks up at most.
BLOCK = 4096
RAREST = 4
INDEX = "gram string, block long, ids array<long>"


def grams(text: Column) -> Column:
    """The different trigrams of a text in lower case; none for shorter ones and null."""
    low = F.lower(text)
    places = F.sequence(F.lit(1), F.length(low) - (GRAM - 1))
    every = F.transform(places, lambda i: F.substring(low, i, F.lit(GRAM)))
    return F.when(F.length(low) >= GRAM, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def index(rows: DataFrame, key: str, text: str) -> DataFrame:
    """gram, block, ids: the numbers of the rows that hold a trigram, sorted. To be written partitioned or sorted by gram."""
    each = rows.select(F.col(key).cast("long").alias("id"), F.explode(grams(F.col(text))).alias("gram"))
    return each.groupBy("gram", F.floor(F.col("id") / BLOCK).alias("block")).agg(F.array_sort(F.collect_set("id")).alias("ids"))


def sizes(postings: DataFrame) -> DataFrame:
    """gram, rows: how many rows hold each trigram, to be stored beside the index."""
    return postings.groupBy("gram").agg(F.sum(F.size("ids")).alias("rows"))


def candidates(postings: DataFrame, counts: DataFrame, part: str, rarest: int = RAREST) -> DataFrame | None:
    """``id`` of rows that hold the rarest trigrams of ``part``; None if it is too short for the index."""
    low = part.lower()
    wanted = sorted({low[i : i + GRAM] for i in range(len(low) - GRAM + 1)})
    if not wanted:
        return None
    known = {r["gram"]: r["rows"] for r in counts.filter(F.col("gram").isin(wanted)).collect()}
    chosen = sorted(wanted, key=lambda g: (known.get(g, 0), g))[:rarest]
    found = postings.filter(F.col("gram").isin(chosen)).select("gram", F.explode("ids").alias("id"))
    return found.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == len(chosen)).select("id")


def containing(rows: DataFrame, postings: DataFrame, counts: DataFrame, key: str, text: str, part: str, rarest: int = RAREST) -> DataFrame:
    """The rows whose column holds ``part``, in either case: candidates of the index, each checked."""
    found = candidates(postings, counts, part, rarest)
    if found is not None:
        rows = rows.join(found, F.col(key) == F.col("id"), "left_semi")
    return rows.filter(F.contains(F.lower(F.col(text)), F.lit(part.lower()))) if part else rows
