"""What is new since the last snapshot, upserts, and what must be made again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.text import LEAST_OUTPUT
from noticelake.operators.membership import filter_of, with_possible
from noticelake.operators.nest import flatten, regroup


def new_rows(new: DataFrame, old: DataFrame, key: str = "url", null_matches_null: bool = True) -> DataFrame:
    """Rows of ``new`` whose key ``old`` lacks; order columns and repeated rows stay. A null key is a key like any other, or else always new."""
    known = old.select(F.col(key).alias("_known"))
    same = F.col(key).eqNullSafe(F.col("_known")) if null_matches_null else F.col(key) == F.col("_known")
    return new.join(known, same, "left_anti")


def new_items(new: DataFrame, old: DataFrame, key: str = "url") -> DataFrame:
    """New items of a flat listing; items without a key are dropped."""
    return new_rows(new.filter(F.col(key).isNotNull()), old, key)


def new_items_by_filter(new: DataFrame, old: DataFrame, known: DataFrame, blocks: int, key: str = "url", prune_old: bool = False) -> DataFrame:
    """As ``new_items``, with ``known``, a filter of all keys of ``old`` (or of more) that was stored with it.

    Items that the filter does not know are new without a look at ``old``; only the others meet it in a join. With
    ``prune_old``, the rows of ``old`` pass a filter of these others' keys before they are shuffled.
    """
    told = with_possible(new.filter(F.col(key).isNotNull()), known, blocks, F.col(key), name="_possible")
    sure, maybe = told.filter("NOT _possible").drop("_possible"), told.filter("_possible").drop("_possible")
    if prune_old:
        old = with_possible(old, filter_of(maybe, F.col(key), blocks=blocks), blocks, F.col(key), name="_possible").filter("_possible").drop("_possible")
    return sure.unionByName(new_rows(maybe, old, key))


def new_on_boards(new: DataFrame, old: DataFrame, carry_board: bool = False, share: Column | None = None) -> DataFrame:
    """The boards of ``new`` with only the documents whose URL no board of ``old`` has; emptied levels vanish.

    Flat rows are compared by URL over all districts and grouped again, so the size of ``old`` has no bound.
    ``share`` (of a document's columns) deals the result into pieces of bounded size, as ``regroup`` has it.
    """
    rows = flatten(new).withColumn("_place", F.monotonically_increasing_id())
    fresh = new_items(rows, flatten(old))
    return regroup(fresh, ordinal="_place", carry_board=carry_board, share=share)


def prune_boards(boards: DataFrame, keep) -> DataFrame:
    """Boards with only the documents for which ``keep`` (a document's struct to a condition) holds, without a shuffle."""
    category = lambda k: k.withField("dokumenty", F.filter(k["dokumenty"], keep))
    full = lambda ks: F.filter(F.transform(ks, category), lambda k: F.size(k["dokumenty"]) > 0)
    district = lambda o: o.withField("dokumenty_zivotne_prostredie", full(o["dokumenty_zivotne_prostredie"]))
    districts = F.filter(F.transform("okresy", district), lambda o: F.size(o["dokumenty_zivotne_prostredie"]) > 0)
    return boards.withColumn("okresy", districts).filter(F.size("okresy") > 0)


def merge_maps(left: DataFrame, right: DataFrame) -> DataFrame:
    """Upsert of rows kept as maps, where a key that is absent differs from one that is null.

    Both: ord long, m map<string,string> with its key under 'url'. Returns part (0: left's rows, 1: rows of right
    alone), ord, m. Of right's rows with one URL the last wins, at the first one's place; every key that it has
    overwrites left's. Rows of left are all kept; rows of right without URL are dropped.
    """
    key = F.try_element_at("m", F.lit("url"))
    r = right.withColumn("u", key).filter("u IS NOT NULL").groupBy("u").agg(F.min("ord").alias("r_ord"), F.max_by("m", "ord").alias("r_m"))
    l = left.withColumn("u", key)  # noqa: E741
    overlaid = F.map_concat(F.map_filter("m", lambda k, _: ~F.map_contains_key("r_m", k)), F.col("r_m"))
    matched = l.join(r, "u", "left").select(F.lit(0).alias("part"), "ord", F.when(F.col("r_m").isNull(), F.col("m")).otherwise(overlaid).alias("m"))
    alone = r.join(l.select("u"), "u", "left_anti").select(F.lit(1).alias("part"), F.col("r_ord").alias("ord"), F.col("r_m").alias("m"))
    return matched.unionByName(alone)


def merge_columns(left: DataFrame, right: DataFrame, key: str, order: str) -> DataFrame:
    """Upsert of typed rows: right's last row per key overwrites all columns it shares with left's, and adds rows of its own.

    Rows of left without a key pass beside the join, so that they do not meet in one task; those of right are dropped.
    """
    row = F.struct(*right.columns)
    last = right.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max_by(row, order).alias("_r"))
    r = last.select(*(F.col(f"_r.`{c}`").alias(f"_r_{c}") for c in right.columns), F.lit(True).alias("_hit"))
    joined = left.filter(F.col(key).isNotNull()).join(r, F.col(key) == F.col(f"_r_{key}"), "full")
    keyless = left.filter(F.col(key).isNull()).select("*", *(F.lit(None).cast(r.schema[c].dataType).alias(c) for c in r.columns))
    joined = joined.unionByName(keyless)
    names = list(dict.fromkeys([*left.columns, *right.columns]))

    def value(c: str) -> Column:
        if c not in right.columns:
            return F.col(c)
        return F.when(F.col("_hit"), F.col(f"_r_{c}")).otherwise(F.col(c) if c in left.columns else F.lit(None))

    return joined.select(*(value(c).alias(c) for c in names))


def stages_to_run(wanted: DataFrame, done: DataFrame, key: str = "doc_id", stages: tuple[str, ...] = ("original", "text", "analysis_raw", "analysis")) -> DataFrame:
    """``done`` has the length of each stage's stored result. Adds run_<stage>: its result is missing or too short, or an earlier stage runs."""
    prior = done.select(F.col(key), *(F.col(s).alias(f"_len_{s}") for s in stages))
    out, earlier = wanted.join(prior, key, "left"), F.lit(False)
    for s in stages:
        earlier = earlier | F.coalesce(F.col(f"_len_{s}") < LEAST_OUTPUT, F.lit(True))
        out = out.withColumn(f"run_{s}", earlier)
    return out.drop(*(f"_len_{s}" for s in stages))
