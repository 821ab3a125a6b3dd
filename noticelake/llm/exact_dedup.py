"""Operator 10, exact dedup by skew-safe combining (DataFrame functions only).

Texts are equal when identical after lower-casing A-Z. Digests are counted first. Those that occur more than once go
into a Bloom filter of bounded size, which is broadcast; a row whose digest is surely not among them needs no
comparison and its text never travels. (A digest that passes by chance does: the filter saves work and decides
nothing.) The other rows pass three merges, each of which groups by the digest *and* the full normalised text, so
equal digests never stand in for equal texts:

1. inside each input partition, before any shuffle: all copies that a partition holds become one row,
2. per (digest, salt), where the salt comes from the number of the partition, so a text that holds a third of all
   rows arrives at ``salts`` tasks, as one row per input partition,
3. per digest, over at most ``salts`` winners of a text.

What leaves the third merge carries no text, only digest, winner, size and the number of different
texts seen under the digest. Documents then find their winner by digest. Should a digest ever cover
two texts, its documents take a second path that joins on the text itself.

Defined cases: a null text counts as empty and empty texts form one group; null ids lose against any id and in a
group with null ids only all are ``kept``, as are rows that repeat the winner's id and text (``drop_duplicates``
leaves one row of these too, whichever); an empty table gives an empty result; other columns are never read, and
``drop_duplicates`` keeps them, whatever their names. Ids may be of any type that can be ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.llm.common import LOWER, UPPER, ascii_lower, broadcast_if_few, checkpoint, table, text_of
from noticelake.operators.membership import MOST_BLOCKS, blocks_for, filter_of, with_possible

SALTS = 16


def _normalised(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    norm = docs.select(F.col(id_col).alias("id"), ascii_lower(text_of(text_col)).alias("norm"))
    return norm.select("id", "norm", F.unhex(F.sha2("norm", 256)).alias("digest"))


def _merge(rows: DataFrame, salts: int) -> DataFrame:
    """One row per different text: digest, norm, keep_id, group_size."""
    # Rows of one partition share their salt, so the partial aggregate makes one row of all copies there.
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    salted = salted.groupBy("digest", "salt", "norm").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Repartitioning by digest alone serves the merge per text, and the count of texts per digest after it.
    return salted.repartition("digest").groupBy("digest", "norm").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def held_rows(rows: DataFrame, repeated: DataFrame, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """The rows whose digest is, or by chance seems to be, among ``repeated``; they are filtered where they are read."""
    blocks = blocks_for(repeated.count(), most=most_blocks)
    return with_possible(rows, filter_of(repeated, F.col("digest"), blocks=blocks), blocks, F.col("digest")).filter("possible").drop("possible")


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, digest (binary SHA-256 of the normalised text)."""
    rows = _normalised(docs, id_col, text_col)
    keys = checkpoint(rows.select("id", "digest"))
    repeated = checkpoint(keys.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest"))
    held = held_rows(rows, repeated, most_blocks)
    digests = _merge(held, salts).groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    digests = checkpoint(digests)
    clashing = digests.filter("texts > 1").select("digest")
    joined = keys.join(broadcast_if_few(digests), "digest", "left")
    alone = F.col("texts").isNull()
    out = joined.filter(alone | (F.col("texts") == 1)).select("id", "digest", F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"), F.when(alone, F.lit(1).cast("long")).otherwise(F.col("group_size")).alias("group_size"))
    if not clashing.isEmpty():
        mixed = held_rows(rows, checkpoint(clashing), most_blocks).join(broadcast_if_few(clashing), "digest", "left_semi")
        out = out.unionByName(mixed.join(_merge(mixed, salts), ["digest", "norm"]).drop("norm"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: of each group of equal texts one row, of the largest id."""
    groups = checkpoint(duplicate_groups(docs, id_col, text_col, salts).filter("group_size > 1").groupBy("id", "digest", "kept").agg(F.count(F.lit(1)).alias("n")))
    norm = ascii_lower(text_of(text_col))
    rows = docs.select(F.col(id_col).alias("own_id"), F.unhex(F.sha2(norm, 256)).alias("own_digest"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    same = F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_digest") == F.col("digest"))
    away = checkpoint(groups.filter("NOT kept OR n > 1").select("id", "digest"))
    blocks = blocks_for(away.count())
    key = [F.col("own_id"), F.col("own_digest")]
    told = with_possible(rows, filter_of(away, F.col("id"), F.col("digest"), blocks=blocks), blocks, *key)
    # Rows that surely stay are not joined with anything; the rest are few more than those that go.
    stay = told.filter("NOT possible").select("row.*").unionByName(told.filter("possible").join(broadcast_if_few(away), same, "left_anti").select("row.*"))
    more = groups.filter("kept AND n > 1").select("id", "digest")
    if more.isEmpty():
        return stay
    # Only repeated rows take this path; each input partition merges its own before the shuffle.
    blocks = blocks_for(more.count())
    held = with_possible(rows, filter_of(more, F.col("id"), F.col("digest"), blocks=blocks), blocks, *key).filter("possible")
    once = held.withColumn("own_norm", ascii_lower(text_of(f"row.`{text_col}`"))).dropDuplicates(["own_id", "own_norm"])
    return stay.unionByName(once.join(broadcast_if_few(more), same, "left_semi").select("row.*"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = duplicate_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


QUERIES = {"op10_exact_dedup": op10_exact_dedup}

ORACLES = {
    "op10_exact_dedup": f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM n
""",
}
