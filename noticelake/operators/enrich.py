"""Joining documents to their stored analyses and status entries, and uniting sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.dates import stamp
from noticelake.functions.text import strict_json
from noticelake.functions.urls import absolute, board_link, doc_id

KEY = ("source", "kraj", "okres", "doc_id")
STATUS_TYPE = "array<struct<date:string,type:string,text:string>>"
FLAT_REGION_URL = "https://www.minzp.sk/uradna-tabula/priroda/"
NESTED_HOST = "https://www.minv.sk"


def status_entry(level: str, text: Column, at: Column) -> Column:
    return F.array(F.struct(stamp(at).alias("date"), F.lit(level).alias("type"), text.alias("text")))


def enrich(docs: DataFrame, store: DataFrame, source: str, at: Column) -> DataFrame:
    """Flat documents with doc_id, status (array) and analysis (JSON text) from the store, and what went wrong as status entries.

    ``store``: source, kraj, okres, doc_id, file_name, content; status.json and analysis.json are used. ``at`` is the
    time of the entries that are added. Links are completed by the source's rules, except for documents without
    region or district.
    """
    nothing = F.lit(None).cast(STATUS_TYPE)
    found = store.filter((F.col("source") == source) & F.col("file_name").isin("status.json", "analysis.json"))
    found = found.groupBy(*(F.col(k).alias(f"_{k}") for k in KEY[1:])).agg(
        F.max(F.when(F.col("file_name") == "status.json", F.col("content"))).alias("_status"),
        F.max(F.when(F.col("file_name") == "analysis.json", F.col("content"))).alias("_analysis"),
    )
    found = found.withColumn("_parsed", F.when(F.col("_analysis").isNotNull(), strict_json("_analysis")))
    rows = docs.withColumn("doc_id", doc_id(F.col("url")))
    placed = (F.coalesce("kraj", F.lit("")) != "") & (F.coalesce("okres", F.lit("")) != "")
    join = placed & (F.col("kraj") == F.col("_kraj")) & (F.col("okres") == F.col("_okres")) & (F.col("doc_id") == F.col("_doc_id"))
    rows = rows.join(found, join, "left")
    loaded = F.from_json("_status", STATUS_TYPE)
    broken = F.col("_status").isNotNull() & loaded.isNull()
    error = (
        F.when(F.coalesce("url", F.lit("")) == "", F.lit("The document has no link."))
        .when(~placed, F.lit("Missing region or district name; cannot load the analysis."))
        .when(F.coalesce("doc_id", F.lit("")) == "", F.lit("No id can be made of the link."))
        .when(F.col("_analysis").isNull(), F.lit("No analysis is stored for the document."))
        .when(F.col("_parsed.error").isNotNull(), F.concat(F.lit("Failed to parse the analysis: "), F.col("_parsed.error")))
    )
    none = F.array().cast(STATUS_TYPE)
    entries = F.concat(
        F.coalesce(loaded, none),
        F.when(broken, status_entry("error", F.lit("Failed to parse the status entries."), at)).otherwise(none),
        F.when(error.isNotNull(), status_entry("error", error, at)).otherwise(none),
    )
    own = F.col("status") if "status" in docs.columns else nothing
    rows = rows.withColumn("status", F.concat(F.coalesce(own, none), entries)).withColumn("analysis", F.col("_parsed.value"))
    rows = complete_links(rows, source, placed | (F.coalesce("url", F.lit("")) == ""))
    return rows.drop(*(c for c in rows.columns if c.startswith("_")))


def complete_links(rows: DataFrame, source: str, where: Column) -> DataFrame:
    """Region, district and board links made absolute, by the rules of a source."""
    have = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    if source == "minzp":
        return rows.withColumn("kraj_url", F.when(where & (F.coalesce(have("kraj_url"), F.lit("")) == ""), FLAT_REGION_URL).otherwise(have("kraj_url")))
    for c, full in (("kraj_url", absolute(have("kraj_url"), NESTED_HOST)), ("okres_url", absolute(have("okres_url"), NESTED_HOST)), ("okres_url_tabule", board_link(have("okres_url_tabule"), NESTED_HOST))):
        rows = rows.withColumn(c, F.when(where, full).otherwise(have(c)))
    return rows


def unite(*sources: DataFrame) -> DataFrame:
    """Rows of all sources, repeated ones too; columns that a source lacks are null."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def fold_results(docs: DataFrame, results: DataFrame, key: str = "url") -> DataFrame:
    """Processing results put into their documents' rows: a result's column takes the place of one of its name."""
    r = results.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_r_{c}") for c in results.columns if c != key), F.lit(True).alias("_hit"))
    joined = docs.join(r, F.col(key) == F.col("_key"), "left")
    names = list(dict.fromkeys([*docs.columns, *results.columns]))
    value = lambda c: F.col(c) if c == key or c not in results.columns else F.when(F.col("_hit"), F.col(f"_r_{c}")).otherwise(F.col(c) if c in docs.columns else F.lit(None))
    return joined.select(*(value(c).alias(c) for c in names))


def district_status(boards: DataFrame, store: DataFrame, source: str = "minv") -> DataFrame:
    """Status entries of districts as rows: kraj, okres, okres_url_tabule, datum, typ, sprava."""
    okres = boards.select("kraj", F.explode("okresy").alias("o")).filter("kraj <> '' AND o.nazov <> ''")
    okres = okres.select("kraj", F.col("o.nazov").alias("okres"), board_link(F.col("o.url"), NESTED_HOST).alias("okres_url_tabule"))
    logs = store.filter((F.col("source") == source) & (F.col("file_name") == "status.json") & F.col("doc_id").isNull())
    entries = logs.select("kraj", "okres", F.explode(F.from_json("content", STATUS_TYPE)).alias("e")).filter("e IS NOT NULL")
    rows = okres.join(entries, ["kraj", "okres"])
    return rows.select("kraj", "okres", "okres_url_tabule", F.col("e.date").alias("datum"), F.col("e.type").alias("typ"), F.col("e.text").alias("sprava"))
