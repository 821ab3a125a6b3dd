"""Near copies by their words: operator 2 completed by an exact join, the corpus pipeline's stage after exact dedup.

Two texts are near copies if the Jaccard similarity of their sets of five-word shingles is 0.8 or more. At that
similarity 64-bit fingerprints differ in about ten bits, so links of three bits, all that an index can search, find
only the closest copies. They come first: fingerprints over five words, the Gray-order index, and each candidate
checked against its shingles. An exact join then finds all other pairs, and skips what is joined already.

The join. Shingles have one order for the whole table, roughly the rarest first; sets of n that are as similar as t
share a shingle among the first n - ceil(t n) + 1 of each. Only these travel. Sizes and places bound how much two
sets can share, and so do marks: every shingle of a set flips one of 256 bits, so sets differ in at least as many
shingles as their marks do in bits. Pairs that pass meet the same bound again, by marks as wide as the sets are large
(a quarter to half a byte for each shingle), which leaves little but near copies; those are compared by the shingles'
bytes. The order comes from counts over all texts, by class of hash; it decides the cost and never the result. Texts
that share a shingle are first paired with one of them (its hub) only. Those that are then in one component need no
more pairs among themselves; the rest are paired with all others that the bounds allow.

Of each connected component the row with the smallest id stays, one with an id before one without; of repeated rows
(same id and text) one stays. Words are cut and lower-cased as in operator 2; shorter texts are one shingle; texts
without words are equal. Null text is empty; an empty table gives an empty result; all columns are kept, whatever
their names; ids may be of any type that can be ordered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticelake.llm import simhash
from noticelake.llm.common import broadcast_if_few, dealt_checkpoint, text_of
from noticelake.llm.components import components
from noticelake.operators.membership import blocks_for, filter_of, with_possible

WIDTH = 5
SIMILARITY = 0.8
#: Blocks of 4 KB of the filter of shared shingles that are broadcast at most.
MOST_BLOCKS = 8_192
_BUCKETS = 1 << 14
_MARKS = 4
_MARK_NAMES = [f"m{k}" for k in range(_MARKS)]
_EPS = 1e-9


def shingles(text: str, width: int = WIDTH) -> set[bytes]:
    words = text.encode().translate(simhash._LOWER).split()
    width = min(width, len(words))
    return {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)} if words else {b""}


def _different(runs: list[np.ndarray]) -> np.ndarray:
    """The different hashes of a text's shingles; a text without words has one, as if its shingle were empty."""
    return np.unique(np.concatenate(runs or [np.zeros(1, np.uint64)]))


def _wide_marks(h: np.ndarray) -> np.ndarray:
    """Bits, at least two for each hash and a power of two in all; one is set if an odd number of the hashes fall on it."""
    bits = max(64 * _MARKS, 1 << int(2 * len(h) - 1).bit_length())
    return np.bincount((h >> np.uint64(24)).astype(np.int64) % bits, minlength=bits).astype(np.uint8) & 1


def _marks(wide: np.ndarray) -> np.ndarray:
    """The same marks folded to 64 * _MARKS bits, in words of 64."""
    return np.packbits(np.bitwise_xor.reduce(wide.reshape(-1, 64 * _MARKS), axis=0), bitorder="little").view(np.int64)


def _apart(a: bytes, b: bytes) -> int:
    """In how many bits wide marks differ, the wider folded to the size of the other."""
    x, y = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    return int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)).sum())


def _scan(texts: DataFrame, width: int) -> tuple[DataFrame, np.ndarray]:
    """From one pass: id, fp (fingerprints) of all texts, and in how many texts shingles fall into each class of their
    hash. The classes are of a fixed number."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(_BUCKETS, np.int64)
        for batch in batches:
            prints = []
            for t in batch["text"]:
                runs = list(simhash.shingle_hashes(t, width, 42))
                prints.append(simhash.majority(runs))
                total += np.bincount((_different(runs) % np.uint64(_BUCKETS)).astype(np.int64), minlength=_BUCKETS)
            yield pd.DataFrame({"is_text": True, "key": batch["node"], "value": np.array(prints, np.uint64).view(np.int64)})
        at = np.flatnonzero(total)
        yield pd.DataFrame({"is_text": False, "key": at, "value": total[at]})

    rows = dealt_checkpoint(texts.select("node", "text").mapInPandas(scan, "is_text boolean, key long, value long"))
    counts = rows.filter("not is_text").groupBy("key").agg(F.sum("value").alias("n"))
    found = counts.select(F.col("key").cast("int").alias("bucket"), F.least("n", F.lit(2**31 - 1)).cast("int").alias("n")).toPandas()
    out = np.zeros(_BUCKETS, np.int32)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return rows.filter("is_text").select(F.col("key").alias("id"), F.col("value").alias("fp")), out


def _may(a: str, b: str, similarity: float, first: bool = True) -> Column:
    """Whether two sets can be as similar, by sizes, marks and the places of a shingle that both have, the first such or any."""
    size, other = F.col(f"{a}.size"), F.col(f"{b}.size")
    needed = similarity / (1 + similarity) * (size + other) - _EPS
    apart = sum((F.bit_count(F.col(f"{a}.{m}").bitwiseXOR(F.col(f"{b}.{m}"))) for m in _MARK_NAMES), F.lit(0))
    most = F.least(size - F.col(f"{a}.pos"), other - F.col(f"{b}.pos"))
    if not first:
        most = most + F.least(f"{a}.pos", f"{b}.pos")
    fits = (F.least(size, other) >= similarity * F.greatest(size, other) - _EPS) & (most >= needed)
    return fits & (size + other - apart >= 2 * needed)


def _near(pairs: DataFrame, texts: DataFrame, heads: DataFrame, width: int, similarity: float) -> DataFrame:
    """Those of the pairs a, b whose texts are as similar: first by wide marks, then by the shingles' bytes."""

    @F.pandas_udf("boolean")
    def possible(n: pd.Series, m: pd.Series, first: pd.Series, second: pd.Series) -> pd.Series:
        apart = np.fromiter(map(_apart, first, second), np.int64, len(first))
        return pd.Series(apart <= (1 - similarity) / (1 + similarity) * (n + m) + _EPS)

    @F.pandas_udf("boolean")
    def similar(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for first, second in batches:
            out = []
            for s, t in zip(first, second, strict=True):
                x, y = shingles(s, width), shingles(t, width)
                out.append(len(x & y) >= similarity * len(x | y) - _EPS)
            yield pd.Series(out, dtype=bool)

    x, y = (heads.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}"), F.col("wide").alias(f"wide_{c}")) for c in ("a", "b"))
    held = pairs.distinct().join(x, "a").join(y, "b")
    pairs = dealt_checkpoint(held.filter(possible("size_a", "size_b", "wide_a", "wide_b")).select("a", "b"))
    # Few texts are left in a pair; only they are shuffled. Their keys are broadcast while they are few.
    needed = dealt_checkpoint(pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "node"))
    held = texts.join(broadcast_if_few(needed), "node", "left_semi")
    one, two = (held.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in ("a", "b"))
    return dealt_checkpoint(pairs.join(one, "a").join(two, "b").filter(similar("text_a", "text_b")).select("a", "b"))


def _by_fingerprint(prints: DataFrame) -> DataFrame:
    """Candidate pairs a, b by operator 2: texts of one fingerprint with the first of them, and first ones within three bits."""
    classes = dealt_checkpoint(prints.groupBy("fp").agg(F.min("id").alias("rep")))
    same = prints.join(classes, "fp").filter("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    return same.union(simhash.near_links(classes))


def _heads(texts: DataFrame, classes: np.ndarray, width: int, similarity: float) -> DataFrame:
    """node, tokens (hashes of the first shingles of its set, in the table's order), size (of the set), wide marks and marks."""
    counts = texts.sparkSession.sparkContext.broadcast(classes)

    @F.pandas_udf(f"struct<tokens:array<long>,size:int,wide:binary,{','.join(f'{m}:long' for m in _MARK_NAMES)}>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        often = counts.value
        for batch in batches:
            tokens, sizes, wides, marks = [], [], [], []
            for t in batch:
                h = _different(list(simhash.shingle_hashes(t, width, 42)))
                order = np.argsort(often[(h % np.uint64(_BUCKETS)).astype(np.int64)], kind="stable")
                tokens.append(h[order[: len(h) - int(np.ceil(similarity * len(h) - _EPS)) + 1]].view(np.int64))
                sizes.append(len(h))
                wide = _wide_marks(h)
                wides.append(np.packbits(wide, bitorder="little").tobytes())
                marks.append(_marks(wide))
            columns = dict(zip(_MARK_NAMES, np.array(marks, np.int64).reshape(-1, _MARKS).T, strict=True))
            yield pd.DataFrame({"tokens": pd.Series(tokens, dtype=object), "size": np.array(sizes, np.int32), "wide": pd.Series(wides, dtype=object), **columns})

    return dealt_checkpoint(texts.select("node", of("text").alias("h")).select("node", "h.*"))


def near_links(texts: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """``texts``: node (long, each once), text. Returns links a, b that join all pairs of near copies."""
    prints, classes = _scan(texts, width)
    close = _by_fingerprint(prints)
    heads = _heads(texts, classes, width, similarity)
    dealt = heads.select("node", "size", *_MARK_NAMES, F.posexplode("tokens").alias("pos", "token"))
    common = dealt_checkpoint(dealt.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("token"))
    # A filter of bounded size keeps the shingles that one text alone has from travelling; those that pass by chance are
    # alone with their token and pair with nothing. It is read anew from the heads each time, as that takes no disk.
    many = common.count()
    blocks = blocks_for(many, most=MOST_BLOCKS)
    placed = with_possible(dealt, dealt_checkpoint(filter_of(common, F.col("token"), blocks=blocks)), blocks, F.col("token"), most=MOST_BLOCKS).filter("possible").drop("possible")
    if blocks < blocks_for(many, most=1 << 40):
        placed = dealt_checkpoint(placed.join(common, "token", "left_semi"))  # the filter is crowded, so the tokens decide

    # First every text with the smallest of each shingle's texts.
    hubs = placed.groupBy("token").agg(F.min(F.struct("node", "pos", "size", *_MARK_NAMES)).alias("h")).select("token", "h.*")
    to_hub = placed.alias("x").join(hubs.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.node") != F.col("y.node")) & _may("x", "y", similarity, first=False))
    found = components(_near(close.union(to_hub.select(F.col("y.node").alias("a"), F.col("x.node").alias("b"))), texts, heads, width, similarity))

    # Then what these links leave apart: of a shingle's texts, those outside its largest component with all others.
    placed = placed.join(broadcast_if_few(found), "node", "left").withColumn("component", F.coalesce("component", "node"))
    main = placed.groupBy("token", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("token").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("parts")).filter("parts > 1").drop("parts")
    placed = dealt_checkpoint(placed.join(main, "token"))
    apart = (F.col("x.component") != F.col("y.component")) & ((F.col("y.component") == F.col("y.main")) | (F.col("x.node") < F.col("y.node")))
    more = placed.filter("component <> main").alias("x").join(placed.alias("y"), (F.col("x.token") == F.col("y.token")) & apart & _may("x", "y", similarity))
    more = more.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    return found.select(F.col("component").alias("a"), F.col("node").alias("b")).union(_near(more, texts, heads, width, similarity))


def _hash_of(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col), text_of(text_col))


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """node (a hash of id and text, different for different rows) and row; rows of one id and text come once.

    Rows with a hash that others have too are compared by id and text. Different ones draw again, so a hash that two
    rows share by chance costs none of them.
    """
    rows = docs.select(_hash_of(id_col, text_col).alias("node"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    several = lambda df: dealt_checkpoint(df.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("node"))
    shared = several(rows)
    if shared.isEmpty():
        return rows
    alone = rows.join(broadcast_if_few(shared), "node", "left_anti")
    own = F.struct(F.col(f"row.`{id_col}`").alias("id"), text_of(f"row.`{text_col}`").alias("text"))
    once = rows.join(broadcast_if_few(shared), "node", "left_semi").withColumn("own", own).dropDuplicates(["node", "own"])
    clashing = several(once)
    if not clashing.isEmpty():
        once = once.join(F.broadcast(clashing.withColumn("clash", F.lit(True))), "node", "left")
        place = F.row_number().over(Window.partitionBy("node").orderBy("own"))
        again = once.filter("clash").withColumn("place", place).withColumn("node", F.when(F.col("place") == 1, F.col("node")).otherwise(F.xxhash64("node", "place", "own")))
        once = once.filter("clash IS NULL").drop("clash").unionByName(again.drop("clash", "place"))
    return alone.unionByName(once.drop("own"))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: of each component of near copies the one with the smallest id."""
    rows = _numbered(docs, id_col, text_col)
    found = components(near_links(rows.select("node", text_of(f"row.`{text_col}`").alias("text")), width, similarity))
    ids = rows.select("node", F.col(f"row.`{id_col}`").alias("id"))
    first = F.struct(F.col("id").isNull(), "id", "node")
    best = ids.join(found, "node").groupBy("component").agg(F.min(first)["node"].alias("best"))
    gone = found.join(best, "component").filter("node <> best").select("node")
    return rows.join(gone, "node", "left_anti").select("row.*")
