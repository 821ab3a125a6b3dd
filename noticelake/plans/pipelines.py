"""The whole flows, each one composition of operators: nested boards, flat listing, report."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from noticelake.functions.text import is_blank, strict_json, without_fences
from noticelake.functions.urls import doc_id, join_url
from noticelake.operators import convert, delta, enrich, nest, present, status
from noticelake.sources import fetch, files, html


@dataclass
class Report:
    documents: DataFrame
    districts: DataFrame


def recent_new_documents(new: DataFrame, old: DataFrame, oldest: str) -> DataFrame:
    """Documents of the new boards that the old ones lack, dated from ``oldest`` on, with their ids, newest first."""
    fresh = delta.new_items(nest.flatten(new), nest.flatten(old))
    return present.newest_first(present.recent(fresh, oldest).withColumn("doc_id", doc_id(F.col("url"))))


#: What follows a district's address on its environmental and on its general board, and the former's heading (fixed values).
BOARD_SUFFIX = "&odbor=10&sekcia=uradna-tabula"
GENERAL_SUFFIX = "&sekcia=uradna-tabula"
BOARD_HEADING = "životné prostredie / úradná tabuľa"
HOST = "https://www.minv.sk"

Save = Callable[[DataFrame, str], DataFrame]


def scrape_boards(directory: DataFrame, fetcher: fetch.Fetcher, save: Save, delays: tuple[int, ...] = fetch.RETRY_DELAYS, sleep: Callable[[float], None] = time.sleep, host: str = HOST) -> DataFrame:
    """``directory``: kraj, url, okresy. The same boards with url_tabule, their documents by category, and error.

    A district's own board is asked first; where it is absent (404) the general one, which has another heading. Districts
    whose page cannot be fetched or read are tried again in rounds. ``save`` stores a round's rows and returns them read
    back, so that no page is asked for twice in a round.
    """
    places = directory.select("kraj", F.col("url").alias("kraj_url"), F.posexplode_outer("okresy").alias("at", "o"))
    rows = places.select("kraj", "kraj_url", "at", F.col("o.nazov").alias("okres"), F.col("o.url").alias("okres_url"))
    full = lambda suffix: F.when(F.col("okres_url") != "", join_url(F.lit(host), F.concat("okres_url", F.lit(suffix))))
    asked = rows.filter("okres IS NOT NULL").withColumn("url", full(BOARD_SUFFIX)).withColumn("fallback_url", full(GENERAL_SUFFIX))

    def attempt(left: DataFrame) -> DataFrame:
        got = fetch.fetch_with_fallback(left, fetcher).withColumnRenamed("error", "fetch_error")
        general = F.col("used_fallback")
        parts = html.board_parts(F.decode("body", "UTF-8"), F.when(~general, F.lit(BOARD_HEADING)), F.when(general, F.lit(html.GENERAL_HEADING)))
        read = got.withColumn("b", F.when(F.col("fetch_error").isNull(), parts))
        board = F.when(general, F.col("fallback_url")).otherwise(F.col("url"))
        error = F.when(F.col("url").isNull(), F.lit("district without URL")).otherwise(F.coalesce("fetch_error", "b.error"))
        return read.select(*left.columns, "b", error.alias("error"), F.when(error.isNull(), board).alias("url_tabule"))

    tried = fetch.in_rounds(asked, attempt, lambda df, n: save(df, f"boards-{n}"), delays, sleep)
    keys = ["kraj", "at"]
    docs, _ = html.documents_of(tried.filter("error IS NULL").select(*keys, "b"), keys, host)
    # A district's documents come from one page, and a region's from its districts' pages.
    one = F.struct("place", F.struct("datum", "nazov", "url").alias("d"))
    kinds = docs.groupBy(*keys, "kategoria").agg(F.min("place").alias("place"), F.sort_array(F.collect_list(one)).alias("ds"))
    kind = F.struct("place", F.struct("kategoria", F.transform("ds", lambda x: x["d"]).alias("dokumenty")).alias("k"))
    boards = kinds.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(kind)), lambda x: x["k"]).alias("dokumenty_zivotne_prostredie"))
    none = F.array().cast(boards.schema["dokumenty_zivotne_prostredie"].dataType)
    found = rows.join(tried.select(*keys, "url_tabule", "error"), keys, "left").join(boards, keys, "left")
    okres = F.struct(F.col("okres").alias("nazov"), F.col("okres_url").alias("url"), "url_tabule", "error", F.coalesce("dokumenty_zivotne_prostredie", none).alias("dokumenty_zivotne_prostredie"))
    listed = F.collect_list(F.when(F.col("okres").isNotNull(), F.struct("at", okres.alias("o"))))
    return found.groupBy("kraj", F.col("kraj_url").alias("url")).agg(F.transform(F.sort_array(listed), lambda x: x["o"]).alias("okresy"))


def crawl_listing(first: DataFrame, fetcher: fetch.Fetcher, save: Save, base: str) -> DataFrame:
    """``first``: url of the list's first page. The items of all its pages, in order."""
    pages = fetch.crawl(first, fetcher, lambda df, n: save(df, f"pages-{n}"), base)
    return html.listing(pages.filter("error IS NULL").select("page", "html"), ["page"], base).orderBy("page", "place").select("nazov", "url", "datum", "popis")


RESULTS = "url string, file_name string, body binary, text string, analysis_raw string, analysis string"


def process_documents(docs: DataFrame, fetcher: fetch.Fetcher, converters: convert.Converters, extractor: Callable[[str], str], save: Save, done: DataFrame | None = None, skip_analysis: bool = False, asked: Callable[[Column], Column] = lambda text: text) -> DataFrame:
    """Flat documents of boards (kraj, okres, url and others): adds doc_id, file_name, body, text, analysis_raw, analysis, error.

    ``save`` stores a stage's rows and returns them read back: a URL is fetched, converted and extracted once, however
    often it is listed. ``done`` has what earlier runs made (columns of RESULTS); a stage runs again only where its
    result is missing or too short or an earlier stage ran. ``asked`` makes what the extractor gets of a text.
    """
    rows = docs.withColumn("doc_id", F.when(F.trim("url") != "", doc_id(F.col("url"))))
    bad = rows.filter("doc_id IS NULL").withColumn("error", F.lit("Invalid or empty URL"))
    done = docs.sparkSession.createDataFrame([], RESULTS) if done is None else done.select(*StructType.fromDDL(RESULTS).names).dropDuplicates(["url"])
    sizes = done.select("url", *(F.length(c).alias(c) for c in ("body", "text", "analysis_raw", "analysis")))
    once = rows.filter("doc_id IS NOT NULL").select("url").distinct()
    todo = save(delta.stages_to_run(once, sizes, "url", ("body", "text", "analysis_raw", "analysis")), "todo")
    run = lambda stage, df: df.join(todo.filter(f"run_{stage}").select("url"), "url", "left_semi")
    keep = lambda stage, *columns: done.join(todo.filter(f"NOT run_{stage}").select("url"), "url", "left_semi").select("url", *columns)

    got = save(fetch.stored_name(fetch.fetch(run("body", once), fetcher)), "fetched")
    files = got.filter("error IS NULL").select("url", "file_name", "body").unionByName(keep("body", "file_name", "body"))
    failed = got.filter("error IS NOT NULL").select("url", "error")
    made = save(convert.document_texts(run("text", files), converters, ["url"]), "texts")
    told = made.select("url", "text", F.get("errors", F.lit(0)).alias("convert_error"))
    texts = told.unionByName(keep("text", "text"), allowMissingColumns=True)
    new = save(convert.extracted(run("analysis_raw", texts), extractor, asked(F.col("text")), skip_analysis), "analyses")
    again = keep("analysis_raw", "analysis_raw").join(texts, "url")
    again = again.select("url", "text", "convert_error", "analysis_raw", strict_json(without_fences(F.col("analysis_raw"))).alias("j"))
    again = again.select("url", "text", "convert_error", "analysis_raw", F.col("j.value").alias("analysis"), F.col("j.error").alias("error"))
    results = new.unionByName(again).withColumn("error", F.coalesce("convert_error", "error")).drop("convert_error").join(files, "url", "left")
    results = enrich.unite(results, failed)
    return enrich.unite(rows.filter("doc_id IS NOT NULL").join(results, "url", "left"), bad)


def status_of(done: DataFrame, at: Column, run_id: int, source: str, skip_analysis: bool = False) -> DataFrame:
    """Status rows of processed documents: errors, archives that gave no text, and with ``skip_analysis`` a note for each of the others."""
    thin = F.col("file_name").rlike(r"\.(?:zip|rar)$") & is_blank(F.col("text")) if "file_name" in done.columns else F.lit(False)
    note = F.lit("analysis skipped") if skip_analysis else F.lit(None).cast("string")
    text = F.coalesce("error", F.when(thin, F.lit("the archive gave no text")), note)
    level = F.when(F.col("error").isNotNull(), "error").when(thin, "warning").otherwise("info")
    said = done.withColumn("_text", text).filter("_text IS NOT NULL")
    return status.entries(said, level, F.col("_text"), at, run_id, source)


def process_listing(items: DataFrame, fetcher: fetch.Fetcher, extractor: Callable[[str], str], save: Save, skip_analysis: bool = False, asked: Callable[[Column], Column] = lambda text: text) -> DataFrame:
    """New items of the flat listing: adds kraj, okres, doc_id, text, analysis_raw, analysis, error, all from the item's page."""
    once = items.filter("url IS NOT NULL").select("url").distinct()
    got = save(fetch.fetch(once, fetcher).withColumnRenamed("error", "_fetch_error"), "fetched")
    pages = got.withColumn("html", F.decode("body", "UTF-8")).drop("http_status", "content_type", "body")
    placed = save(html.placed(pages).withColumnRenamed("error", "_place_error").drop("html"), "placed")
    rows = items.join(placed, "url", "left").withColumn("_fetch_error", F.when(F.col("url").isNull(), F.lit("no URL")).otherwise(F.col("_fetch_error")))
    fine = F.col("_place_error").isNull() & F.col("_fetch_error").isNull()
    done = save(convert.extracted(rows, extractor, F.when(fine, asked(convert.described(F.col("popis"), F.col("text")))), skip_analysis), "analyses")
    return done.withColumn("error", F.coalesce("_fetch_error", "_place_error", "error")).drop("_fetch_error", "_place_error")


def merge_listing(master: DataFrame, processed: DataFrame) -> DataFrame:
    """The master list with processed items put in, by URL, typed form."""
    return delta.merge_columns(master, processed, "url", "ord")


def report(boards: DataFrame, listing: DataFrame, store: DataFrame, oldest: str, at: Column) -> Report:
    """Recent documents of both sources with status and analysis, and the districts' status rows."""
    nested = enrich.enrich(present.recent(nest.flatten(boards), oldest), store, "minv", at)
    flat = enrich.enrich(present.recent(listing, oldest), store, "minzp", at)
    return Report(enrich.unite(nested, flat), enrich.district_status(boards, store))


def rotate(rows: DataFrame, root: str, version: str) -> None:
    files.write_snapshot(rows, root, version)
