"""A blocked Bloom filter as a table: which keys may be in a set, told without a join on the keys.

A key falls into one block of 32,768 bits and sets ``HASHES`` of them. A filter is one row per block that holds any
key, so filters of parts of a set, or of several snapshots, merge by OR. A key whose bits are not all set is surely
absent; the others need an exact check, so a result never depends on the filter's size, only its cost does.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a block (fixed by Spark's bitmap functions), and bits that a key sets.
BLOCK_BITS = 32_768
HASHES = 4
#: Blocks of 4 KB that are broadcast; a filter has no more of them unless asked for.
MOST_BLOCKS = 4_096
FILTER = "block int, blocks int, bits binary"


def blocks_for(keys: int, bits_a_key: int = 12, most: int = MOST_BLOCKS) -> int:
    """Blocks that give each of ``keys`` keys ``bits_a_key`` bits, within the bound."""
    return max(1, min(most, -(-keys * bits_a_key // BLOCK_BITS)))


def _block(keys: list[Column], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int")


def _places(keys: list[Column]) -> list[Column]:
    own = F.xxhash64(*keys, F.lit(1))
    return [F.pmod(F.shiftright(own, 15 * k), F.lit(BLOCK_BITS)) for k in range(HASHES)]


def filter_of(rows: DataFrame, *keys: Column, blocks: int) -> DataFrame:
    """The filter of all keys of ``rows``: block, blocks, bits. Nulls are keys too."""
    each = rows.select(_block(list(keys), blocks).alias("block"), F.explode(F.array(*_places(list(keys)))).alias("place"))
    return each.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits")).select("block", F.lit(blocks).alias("blocks"), "bits")


def merged(*filters: DataFrame) -> DataFrame:
    """The filter of all the sets together; they must have equally many blocks."""
    both = reduce(DataFrame.unionByName, filters)
    one = F.count_distinct("blocks") == 1
    # A merge of unlike filters would lose keys.
    told = both.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"), F.max("blocks").alias("blocks"), one.alias("one"))
    checked = F.when(F.col("one"), F.col("blocks")).otherwise(F.raise_error(F.lit("filters of different sizes")).cast("int"))
    return told.select("block", checked.alias("blocks"), "bits")


def with_possible(rows: DataFrame, known: DataFrame, blocks: int, *keys: Column, name: str = "possible", most: int = MOST_BLOCKS) -> DataFrame:
    """``rows`` with the boolean ``name``: false if the key is surely not in the set of the filter ``known``."""
    at, bits = "_filter_block", "_filter_bits"
    table = known.select(F.col("block").alias(at), F.col("bits").alias(bits))
    joined = rows.join(F.broadcast(table) if blocks <= most else table, _block(list(keys), blocks) == F.col(at), "left")
    byte = lambda p: F.conv(F.hex(F.substring(bits, F.shiftright(p, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = [F.getbit(byte(p), (p % 8).cast("int")) == 1 for p in _places(list(keys))]
    found = F.coalesce(reduce(lambda a, b: a & b, held), F.lit(False))
    return joined.withColumn(name, found).drop(at, bits)
