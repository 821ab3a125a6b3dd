"""Operator 5, line dedup.

The query removes runs (``drop_repeated_runs``): every line of a run of two lines or more that occurred before in the
table, wherever it stands, except for its first occurrence. A run is the pairs of neighbouring lines that it is made of.
A pair is known by 128 bits of BLAKE2b over the bytes of its lines, and pairs whose key is repeated are compared by
their bytes; a pair of white space only is never removed by
itself, and where equal lines follow each other the lines of the first pair stay. Keys and places travel first, then
the bytes of pairs with a repeated key, merged per input partition; texts travel once, to meet the list of their repeated pairs.

Content-defined chunks (``drop_repeated_lines``) are the coarser way. Lines are hashed; a rolling hash over the last ``window`` line hashes ends a chunk where its value falls in
one class of ``divisor``. Boundaries depend on nearby lines only, so a passage that is copied into another
document is cut alike there, wherever it stands. Chunks of at least two lines that occur more than once in
the table, compared byte by byte, are removed except for their first occurrence (smallest document id, then
place).

The chunks' bytes travel once, merged per input partition before the shuffle, so a chunk in a third of all
documents arrives as one row per partition. What returns to the documents is only a list of chunk numbers.

Defined cases: a null text stays null and an empty one has one empty line; repeated rows (same id and text)
count as one document and are treated alike; rows with a null id come after all others in the order of
occurrences; a chunk of white space only is never removed; an empty table gives an empty result; all columns are
kept, whatever their names, but for ``lines`` and ``removed``, which the result's own replace.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticelake.llm.common import checkpoint, table
from noticelake.operators.membership import blocks_for, filter_of, with_possible

WINDOW = 2
DIVISOR = 3
_BASE = 0x9E3779B97F4A7C15


def chunks(lines: list[str], window: int = WINDOW, divisor: int = DIVISOR) -> list[tuple[int, int]]:
    """(first, end) of each chunk of lines."""
    h = np.fromiter((xxhash.xxh64_intdigest(x.encode()) for x in lines), np.uint64, len(lines))
    rolled, factor = np.zeros(len(h), np.uint64), 1
    for back in range(min(window, len(h))):
        rolled[back:] += h[: len(h) - back] * np.uint64(factor)
        factor = factor * _BASE % 2**64
    ends = (np.flatnonzero((rolled >> np.uint64(33)) % np.uint64(divisor) == 0) + 1).tolist()
    edges = sorted({0, *ends, len(lines)})
    return list(zip(edges, edges[1:], strict=False))


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def document_chunks(docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR) -> DataFrame:
    """``docs``: id, digest, text. One row per chunk of two lines or more that is not blank: id, digest, chunk, key (16 bytes), content."""

    @F.pandas_udf("array<struct<chunk:int,key:binary,content:string>>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for text in batch:
                lines = text.split("\n")
                rows = []
                for k, (a, b) in enumerate(chunks(lines, window, divisor)):
                    if b - a > 1 and (content := "\n".join(lines[a:b])).strip():
                        rows.append({"chunk": k, "key": xxhash.xxh3_128_digest(content.encode()), "content": content})
                out.append(rows)
            yield pd.Series(out, dtype=object)

    return docs.select("id", "digest", F.inline(of("text")))


def removals(docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR) -> DataFrame:
    """id, digest, drop: the numbers of the chunks to remove, for documents that have any."""
    rows = document_chunks(docs, window, divisor)
    # A chunk is repeated if its first and last place differ; repeated rows share their places and so count once.
    place = F.struct(F.col("id").isNull().alias("last"), "id", "digest", "chunk")
    texts = rows.groupBy("key", "content").agg(F.min(place).alias("first"), F.max(place).alias("other"))
    repeated = texts.filter("first <> other")
    firsts = checkpoint(texts.groupBy("key").agg(F.count(F.lit(1)).alias("texts"), F.min("first").alias("first"), F.max(F.col("first") != F.col("other")).alias("again")).filter("again"))
    clear = firsts.filter("texts = 1").select("key", "first")
    found = rows.select("id", "digest", "chunk", "key").join(clear, "key")
    if not firsts.filter("texts > 1").isEmpty():
        # Different chunks under one key: these are joined by their bytes.
        mixed = rows.join(firsts.filter("texts > 1").select("key"), "key", "left_semi")
        found = found.unionByName(mixed.join(repeated.select("key", "content", "first"), ["key", "content"]).select("key", "id", "digest", "chunk", "first"))
    later = found.filter(~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("digest") == F.col("first.digest")) & (F.col("chunk") == F.col("first.chunk"))))
    return later.groupBy("id", "digest").agg(F.sort_array(F.collect_set("chunk")).alias("drop"))


def _rebuilt(docs: DataFrame, id_col: str, text_col: str, mark, removals_of, without) -> DataFrame:
    """``docs`` with new texts, lines and removed. removals_of: from id, mark, text to id, mark, drop; without: from lines and drop to the lines that stay."""
    rows = docs.select(F.col(id_col).alias("id"), mark(F.col(text_col)).alias("mark"), F.col(text_col).alias("text"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    gone = removals_of(rows.select("id", "mark", "text").filter("text IS NOT NULL")).select(F.col("id").alias("own_id"), F.col("mark").alias("own_mark"), "drop")

    @F.pandas_udf("text string, lines long, removed long")
    def rebuilt(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, drops in batches:
            out = []
            for text, drop in zip(texts, drops, strict=True):
                lines = [] if text is None else text.split("\n")
                kept = lines if drop is None or not len(drop) else without(lines, drop.tolist())
                out.append((text if kept is lines else "\n".join(kept), len(lines), len(lines) - len(kept)))
            yield pd.DataFrame(out, columns=["text", "lines", "removed"])

    joined = rows.join(gone, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("mark") == F.col("own_mark")), "left")
    done = joined.select("row", rebuilt("text", "drop").alias("new"))
    kept = [c for c in docs.columns if c not in ("lines", "removed")]
    return done.select(*(F.col("new.text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in kept), "new.lines", "new.removed")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, divisor: int = DIVISOR) -> DataFrame:
    """``docs`` with repeated chunks removed from the text, and lines, removed (numbers of lines) added at the end."""

    def without(lines: list[str], drop: list[int]) -> list[str]:
        away = set(drop)
        return [x for k, (a, b) in enumerate(chunks(lines, window, divisor)) if k not in away for x in lines[a:b]]

    gone = lambda rows: removals(rows.withColumnRenamed("mark", "digest"), window, divisor).withColumnRenamed("digest", "mark")
    return _rebuilt(docs, id_col, text_col, _digest, gone, without)


def line_pairs(docs: DataFrame, content: bool = False) -> DataFrame:
    """``docs``: id, mark, text. One row per pair of neighbouring lines that is not blank: id, mark, pair, key (16 bytes), with ``content`` also that."""

    @F.pandas_udf(f"array<struct<pair:int,key:binary{',content:string' if content else ''}>>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for text in batch:
                lines = text.split("\n")
                both = ((k, f"{a}\n{b}") for k, (a, b) in enumerate(zip(lines, lines[1:], strict=False)))
                out.append([{"pair": k, "key": _pair_key(x)} | ({"content": x} if content else {}) for k, x in both if x.strip()])
            yield pd.Series(out, dtype=object)

    return docs.select("id", "mark", F.inline(of("text")))


def _pair_key(content: str) -> bytes:
    return hashlib.blake2b(content.encode(), digest_size=16).digest()


def repeated_pairs(docs: DataFrame) -> DataFrame:
    """id, mark, drop: twice the number of each pair that occurred before, and one more if it did so one line earlier in the same text."""
    rows = line_pairs(docs)
    # Repeated rows share their places and so count once.
    place = F.struct(F.col("id").isNull().alias("last"), "id", "mark", "pair")
    ends = [F.min(place).alias("first"), F.max(place).alias("other")]
    again = checkpoint(rows.groupBy("key").agg(*ends).filter("first <> other").select("key"))
    # A filter of bounded size finds the pairs with a repeated key where they are read; one that passes by chance occurs once
    # and falls out below. So the bytes of a pair travel once per partition that has it, however often it occurs there.
    blocks = blocks_for(again.count())
    held = with_possible(line_pairs(docs, content=True), filter_of(again, F.col("key"), blocks=blocks), blocks, F.col("key")).filter("possible").drop("possible")
    texts = held.groupBy("key", "content").agg(*ends)
    several = F.count(F.lit(1)).over(Window.partitionBy("key")) > 1
    firsts = checkpoint(texts.withColumn("several", several).filter("first <> other").select("key", "first", "several", F.when(F.col("several"), F.col("content")).alias("content")))
    found = rows.join(firsts.filter("NOT several").select("key", "first"), "key")
    if not firsts.filter("several").isEmpty():
        # Different pairs under one key: these are joined by their bytes.
        found = found.unionByName(held.join(firsts.filter("several").select("key", "content", "first"), ["key", "content"]).drop("content"))
    same = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("mark") == F.col("first.mark"))
    later = found.filter(~(same & (F.col("pair") == F.col("first.pair"))))
    return later.groupBy("id", "mark").agg(F.collect_set(F.col("pair") * 2 + (same & (F.col("pair") == F.col("first.pair") + 1)).cast("int")).alias("drop"))


def drop_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with later occurrences of runs of two lines or more removed from the text, and lines, removed added at the end."""

    def without(lines: list[str], drop: list[int]) -> list[str]:
        away = set()
        for k, overlaps in (divmod(x, 2) for x in drop):
            away |= {k + 1} if overlaps else {k, k + 1}
        return [x for k, x in enumerate(lines) if k not in away]

    return _rebuilt(docs, id_col, text_col, F.xxhash64, repeated_pairs, without)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = drop_repeated_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", F.col("lines").alias("n_lines"), F.col("removed").alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


QUERIES = {"op5_line_dedup": op5_line_dedup}

#: SQL has no rolling hash over XXH64; tests compare with brute force.
ORACLES: dict[str, str] = {}
