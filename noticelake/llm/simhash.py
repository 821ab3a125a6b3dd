"""Operator 2, SimHash near-dedup over a Gray-order hierarchical index.

Fingerprints. A text is lower-cased (A-Z), cut at ASCII white space and shingled; every shingle is hashed
with XXH64 (seed 42) and a bit is set if more than half the hashes have it. Copies share a fingerprint, so
everything after works on one row per different fingerprint.

Links. Two fingerprints within three bits agree on at least one of four blocks of 16 bits, so each is dealt to
four groups, by the first bits of each block; as many bits as leave about ``GROUP`` fingerprints in a group (none in a
small table, which is one group). Where 16 bits no longer do, past hundreds of millions of fingerprints, they agree
on two of five blocks, and ten groups go by those. Rows of a task are sorted by group and Gray rank: neighbours in Gray
order differ in few bits, so nodes over 16 of them share a long masked bit pattern, and 16 nodes have a node above them
with what all share, level by level. The tree of a group is joined with itself from the root: a pair of nodes whose
shared patterns already differ in more than three bits is dropped with all below it, and so is a pair that lies in
one component already. Leaves compare fingerprints exactly. A task returns a spanning forest of its links, never all
pairs of a group.

A group of more than ``block`` fingerprints is cut into blocks by hash; every pair of blocks is one task
group of at most about two blocks, so no task holds a whole hot group and no pair is lost.

Components are formed across groups by distributed star rounds.

Defined cases: null text is empty; a text without words has fingerprint zero and links like any other;
shorter texts hash their whole word sequence; rows with a null id get a fingerprint and take the component
of that fingerprint, but form no component of their own (null); repeated rows each get a row; empty tables
give empty results; other columns are never read. Ids are whole numbers; others are refused.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.llm.common import checkpoint, table, text_of, whole_ids
from noticelake.llm.components import components

MAX_BITS = 3
#: The first bit and the number of bits of five blocks. Three differing bits leave two of them alike, as they leave one of four.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
LEAF = 16
BLOCK = 16_384
#: Fingerprints of a group, about.
GROUP = 8192
_PIECE = 65_536
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: str, width: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of every word shingle of a whole text, in runs of at most _PIECE; none for a text without words."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return
    width = min(width, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    first, last = (ends - lengths)[: len(words) - width + 1], ends[width - 1 :]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), _PIECE):
        spans = zip(first[at : at + _PIECE].tolist(), last[at : at + _PIECE].tolist(), strict=True)
        yield np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64)


def majority(runs: Iterable[np.ndarray]) -> int:
    """The bits that more than half of all hashes have."""
    counts, n = np.zeros(64, np.int64), 0
    for h in runs:
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
        n += len(h)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def fingerprint(text: str, width: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a whole text, unsigned."""
    return majority(shingle_hashes(text, width, seed))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """One row per document: id, fp (the fingerprint's bits as a signed long)."""

    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, width) for t in batch], np.uint64).view(np.int64))

    return docs.select(F.col(id_col).alias("id"), of(text_of(text_col)).alias("fp"))


def gray_rank(fp: Column) -> Column:
    """The place of a bit pattern in Gray order, as a long that sorts rightly as a signed number."""
    rank = fp
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(2**63)))


class _Level:
    """Nodes over consecutive items: the bits all items below share, and their values."""

    def __init__(self, first: np.ndarray, size: int, low: np.ndarray, high: np.ndarray, leaf: bool):
        self.first, self.end, self.leaf = first, np.append(first[1:], size), leaf
        self.value = np.bitwise_and.reduceat(low, first)
        self.any = np.bitwise_or.reduceat(high, first)
        self.mask = ~(self.value ^ self.any)


def _blocks(keys: np.ndarray) -> np.ndarray:
    """Where runs of at most LEAF items with one key begin."""
    new = np.append(True, keys[1:] != keys[:-1])
    begin = np.flatnonzero(new)
    place = np.arange(len(keys)) - np.repeat(begin, np.diff(np.append(begin, len(keys))))
    return np.flatnonzero(place % LEAF == 0)


def _pairs(a: np.ndarray, b: np.ndarray, level: _Level) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a child of a[i] and a child of b[i], each unordered pair once."""
    na, nb = level.end[a] - level.first[a], level.end[b] - level.first[b]
    n = na * nb
    which = np.repeat(np.arange(len(a)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    x, y = level.first[a][which] + at // nb[which], level.first[b][which] + at % nb[which]
    once = (a[which] != b[which]) | (x < y if level.leaf else x <= y)
    return x[once], y[once]


def _union(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Merge the components of x[i] and y[i]; label holds the smallest item of each component."""
    while len(x):
        x, y = label[x], label[y]
        apart = x != y
        x, y = x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, up := label[label]):
            label[:] = up


def links(keys: np.ndarray, fps: np.ndarray, bits: int = MAX_BITS, chunk: int = 4096, compared: list[int] | None = None) -> np.ndarray:
    """For items sorted by key and Gray rank: the first item of each one's component within its key.

    ``compared`` gathers how many pairs of items met below the leaves.
    """
    label = np.arange(len(fps))
    levels, low, high, ks = [], fps, fps, keys
    while True:
        first = _blocks(ks)
        level = _Level(first, len(ks), low, high, not levels)
        levels.append(level)
        low, high, ks = level.value, level.any, ks[first]
        if len(ks) == len(np.unique(ks)):
            break
    top = len(levels) - 1
    start = np.arange(len(ks))
    stack = [(top, start, start)]
    begins = [levels[0].first]  # the first item below each node
    for lv in levels[1:]:
        begins.append(begins[-1][lv.first])
    while stack:
        depth, a, b = stack.pop()
        if len(a) > chunk:
            stack.append((depth, a[chunk:], b[chunk:]))
            a, b = a[:chunk], b[:chunk]
        least, most = np.minimum.reduceat(label, begins[depth]), np.maximum.reduceat(label, begins[depth])
        joined = (least[a] == most[a]) & (least[b] == most[b]) & (least[a] == least[b])
        a, b = a[~joined], b[~joined]
        if not len(a):
            continue
        x, y = _pairs(a, b, levels[depth])
        if depth == 0:
            if compared is not None:
                compared.append(len(x))
            near = np.bitwise_count(fps[x] ^ fps[y]) <= bits
            _union(label, x[near], y[near])
            continue
        below = levels[depth - 1]
        near = np.bitwise_count((below.value[x] ^ below.value[y]) & below.mask[x] & below.mask[y]) <= bits
        x, y = x[near], y[near]
        own = x == y  # a block with itself comes first, so that its component is known to the rest
        stack.append((depth - 1, x[~own], y[~own]))
        stack.append((depth - 1, x[own], y[own]))
    return label


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by grp and Gray rank in; the links of a spanning forest of each group out."""

    def solve(df: pd.DataFrame) -> pd.DataFrame:
        key, _ = pd.factorize(df["grp"])
        keep = np.bincount(key, minlength=1)[key] > 1
        df, key = df[keep], key[keep]
        if df.empty:
            return pd.DataFrame({"a": np.array([], np.int64), "b": np.array([], np.int64)})
        rep = df["rep"].to_numpy()
        label = links(key, df["fp"].to_numpy().view(np.uint64))
        far = label != np.arange(len(label))
        return pd.DataFrame({"a": rep[far], "b": rep[label[far]]})

    held: list[pd.DataFrame] = []
    for df in batches:
        last = df["grp"].iloc[-1] if len(df) else None
        whole = df["grp"].ne(last).to_numpy().nonzero()[0]
        cut = int(whole[-1]) + 1 if len(whole) else 0
        if cut:
            yield solve(pd.concat([*held, df.iloc[:cut]]))
            held = []
        held.append(df.iloc[cut:])
    if held:
        yield solve(pd.concat(held))


def _keys(fp: Column, bits: int) -> Column:
    """array<struct<blocks, value>>: the groups of a fingerprint.

    Up to 16 bits: the first ``bits`` of each of four blocks; one group for all without bits. Beyond: two of five blocks.
    """
    if not bits:
        return F.array(F.struct(F.lit(0).alias("blocks"), F.lit(0).cast("long").alias("value")))
    if bits <= 16:
        first = [F.shiftrightunsigned(fp, 16 * k + 16 - bits).bitwiseAND((1 << bits) - 1) for k in range(4)]
        return F.array(*(F.struct(F.lit(k).alias("blocks"), v.alias("value")) for k, v in enumerate(first)))
    block = [F.shiftrightunsigned(fp, at).bitwiseAND((1 << n) - 1) for at, n in BLOCKS]
    pairs = list(combinations(range(len(BLOCKS)), 2))
    return F.array(*(F.struct(F.lit(k).alias("blocks"), (F.shiftleft(block[a], BLOCKS[b][1]) + block[b]).alias("value")) for k, (a, b) in enumerate(pairs)))


def near_links(classes: DataFrame, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """``classes``: fp, rep, one row per fingerprint. Returns links a, b between reps that join all within three bits."""
    bits = max(0, int(-(-classes.count() // group)) - 1).bit_length()
    dealt = classes.select("fp", "rep", F.inline(_keys(F.col("fp"), bits)))
    hot = dealt.groupBy("blocks", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    k = F.coalesce(F.ceil(F.col("n") / block), F.lit(1)).cast("long")
    mine = F.pmod(F.xxhash64("fp"), k)
    parts = dealt.join(hot, ["blocks", "value"], "left").select("blocks", "value", "fp", "rep", mine.alias("mine"), F.explode(F.sequence(F.lit(0).cast("long"), k - 1)).alias("other"))
    grp = F.xxhash64("blocks", "value", F.least("mine", "other"), F.greatest("mine", "other"))
    grouped = parts.select(grp.alias("grp"), "fp", "rep")
    return grouped.repartition("grp").sortWithinPartitions("grp", gray_rank(F.col("fp"))).mapInPandas(_forest, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, block: int = BLOCK) -> DataFrame:
    """One row per input row: id, fp, component_id (smallest id reachable over links of at most three bits)."""
    whole_ids(docs, id_col)
    prints = checkpoint(fingerprints(docs, id_col, text_col, width).select(F.col("id").cast("long").alias("id"), "fp"))
    classes = checkpoint(prints.groupBy("fp").agg(F.min("id").alias("rep")))
    found = components(near_links(classes.filter("rep IS NOT NULL"), block))
    named = classes.join(found, classes["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, "fp").select("id", "fp", "component_id")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op2_simhash_near_dedup": op2_simhash_near_dedup}

#: SQL has no XXH64; tests compare with brute force.
ORACLES: dict[str, str] = {}
