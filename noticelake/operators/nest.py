"""Flattening and regrouping of the three-level boards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CONTEXT = ("kraj", "kraj_url", "okres", "okres_url", "okres_url_tabule", "doc_kategoria")


def flatten(boards: DataFrame) -> DataFrame:
    """One row per document with its context before it; empty levels vanish. A document's own field wins over context of that name."""
    okres = boards.select(F.col("kraj"), F.col("url").alias("kraj_url"), F.explode("okresy").alias("o")).filter("o IS NOT NULL")
    has = set(okres.schema["o"].dataType.names)
    extra = F.col("o.url_tabule") if "url_tabule" in has else F.lit(None).cast("string")
    kategoria = okres.select(
        "kraj", "kraj_url", F.col("o.nazov").alias("okres"), F.col("o.url").alias("okres_url"), extra.alias("okres_url_tabule"), F.explode("o.dokumenty_zivotne_prostredie").alias("k")
    ).filter("k IS NOT NULL")
    docs = kategoria.select("kraj", "kraj_url", "okres", "okres_url", "okres_url_tabule", F.col("k.kategoria").alias("doc_kategoria"), F.explode("k.dokumenty").alias("d")).filter("d IS NOT NULL")
    return spread(docs, CONTEXT, "d")


def spread(df: DataFrame, context: tuple[str, ...], struct: str) -> DataFrame:
    """Context columns, then a struct's fields; a field takes the place of a context column of its name."""
    own = df.schema[struct].dataType.names
    return df.select(*(F.col(f"{struct}.{c}").alias(c) if c in own else F.col(c) for c in context), *(F.col(f"{struct}.{c}").alias(c) for c in own if c not in context))


def regroup(rows: DataFrame, document: tuple[str, ...] = ("datum", "nazov", "url"), ordinal: str | None = None, carry_board: bool = False, share: Column | None = None) -> DataFrame:
    """The boards of flat rows: documents by date, categories, districts and regions by name; the first URL of each stays.

    ``ordinal`` is the rows' place in their source, which breaks ties. A region is one row, which is meant for exports.
    Where regions outgrow a row, ``share`` deals the documents into numbered pieces of a size that its maker bounds:
    every region then has a row for each piece, and ``flatten`` gives the same rows as for the whole.
    """
    place = F.col(ordinal) if ordinal else F.struct(*document)
    rows = rows.withColumn("_at", place).withColumn("_share", F.lit(0) if share is None else share)
    doc = F.struct(F.col("datum").alias("_by"), F.col("_at"), F.struct(*document).alias("d"))
    first = lambda c: F.min_by(c, "_at")
    kept = ["kraj_url", "okres_url", *(["okres_url_tabule"] if carry_board else [])]
    kat = rows.groupBy("_share", "kraj", "okres", "doc_kategoria").agg(F.sort_array(F.collect_list(doc)).alias("docs"), *(first(c).alias(c) for c in kept), F.min("_at").alias("_at"))
    kat = kat.withColumn("k", F.struct(F.col("doc_kategoria").alias("kategoria"), F.transform("docs", lambda x: x["d"]).alias("dokumenty")))
    okr = kat.groupBy("_share", "kraj", "okres").agg(F.sort_array(F.collect_list("k")).alias("ks"), *(first(c).alias(c) for c in kept), F.min("_at").alias("_at"))
    fields = [F.col("okres").alias("nazov"), F.col("okres_url").alias("url"), *([F.col("okres_url_tabule").alias("url_tabule")] if carry_board else []), F.col("ks").alias("dokumenty_zivotne_prostredie")]
    okr = okr.withColumn("o", F.struct(*fields))
    return okr.groupBy("_share", "kraj").agg(F.sort_array(F.collect_list("o")).alias("okresy"), first("kraj_url").alias("url")).select("kraj", "url", "okresy")


def ranked(rows: DataFrame, ordinal: str, names: tuple[str, ...] = ("kraj", "okres", "doc_kategoria")) -> DataFrame:
    """Flat rows with ``rank``: their place among the documents of their category, by date, then ``ordinal``.

    Rows are numbered within a month, and months by their counts, so that a category of any size meets in no one task.
    """
    month = F.coalesce(F.substring("datum", 1, 7), F.lit(""))
    rows = rows.withColumn("_month", month)
    counts = rows.groupBy(*names, "_month").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*names).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*(F.col(c).alias(f"_{c}") for c in names), F.col("_month").alias("_m"), before.alias("_before"))
    same = F.col("_month") == F.col("_m")
    for c in names:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    own = F.row_number().over(Window.partitionBy(*names, "_month").orderBy("datum", ordinal))
    return rows.withColumn("_own", own).join(counts, same).withColumn("rank", (F.col("_own") + F.col("_before")).cast("long")).select(*(c for c in rows.columns if c != "_month"), "rank")


def without_empty_categories(categories: Column) -> Column:
    return F.filter(categories, lambda k: F.size(k["dokumenty"]) > 0)


def with_iso_dates(boards: DataFrame) -> DataFrame:
    """Every date of the nested documents as yyyy-MM-dd, in place."""
    from noticelake.functions.dates import iso_date

    dated = lambda d: d.withField("datum", iso_date(d["datum"]))
    category = lambda k: k.withField("dokumenty", F.transform(k["dokumenty"], dated))
    district = lambda o: o.withField("dokumenty_zivotne_prostredie", F.transform(o["dokumenty_zivotne_prostredie"], category))
    return boards.withColumn("okresy", F.transform("okresy", district))


def appended(first: Column, second: Column) -> Column:
    """Two arrays in a row; a null array counts as empty."""
    return F.when(first.isNull(), second).when(second.isNull(), first).otherwise(F.concat(first, second))
