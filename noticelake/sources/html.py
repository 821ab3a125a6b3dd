"""Pages to rows. Arrow functions take a page apart; what follows from the order of its parts is window work in Spark."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import parse_qs, urljoin, urlparse

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from noticelake.functions.arrow import arrow
from noticelake.functions.dates import is_date_like, iso_date
from noticelake.functions.urls import MINISTRY, district_name, file_id, join_url, region_name
from noticelake.sources.markup import Element, markdown, parse

#: Heading, menu entry and default category of the boards (fixed values).
GENERAL_HEADING = "úradná tabuľa"
MENU_ITEM = "menu-item-12224"
UNNAMED_CATEGORY = "Nezaradené (tabuľka)"

_DATE = re.compile(r"\d{1,2}\.\s*\d{1,2}\.\s*\d{2,4}")


def _rows(values, columns):
    return pd.Series([[dict(zip(columns, v, strict=True)) for v in row] for row in values], dtype=object)


def _menu(html: str) -> list[dict]:
    at: Element | None = parse(html)
    steps = (lambda e: e.find("div", "sidemenu_list"), lambda e: e.find("div", "small-nav -alt"), lambda e: e.find("ul", direct=True), lambda e: e.find("li", id=MENU_ITEM), lambda e: e.find("ul", "sub-menu", direct=True))
    for step in steps:
        at = step(at) if at is not None else None
    out = []
    for li in at.find_all("li", "menu-item-has-children") if at is not None else []:
        link = li.find("a", direct=True)
        if link is None or not link.text():
            continue
        below = li.find("ul", "sub-menu", direct=True)
        found = [x.find("a", direct=True) for x in below.find_all("li")] if below is not None else []
        out.append({"kraj": link.text(), "url": link.attrs.get("href"), "okresy": [{"nazov": a.text(), "url": a.attrs.get("href")} for a in found if a is not None]})
    return out


@arrow("array<struct<kraj:string,url:string,okresy:array<struct<nazov:string,url:string>>>>")
def menu_tree(pages: pd.Series) -> pd.Series:
    """The regions and districts of the menu; empty if any level of it is missing."""
    return pd.Series([_menu(p) for p in pages], dtype=object)


def _board(html: str, specific: str | None, general: str | None) -> tuple[str | None, str | None, list[tuple]]:
    section = parse(html).find("div", id="popis")
    if section is None:
        return "section #popis not found", None, []
    titles = [(h, h.only_string()) for h in section.find_all("h2")]
    heading = next((h for h, t in titles if specific and t and specific in t.lower()), None)
    heading = heading or next((h for h, t in titles if general and t and t.strip().lower() == general), None)
    if heading is None:
        return "heading not found", None, []
    after = heading.following()
    table = next((e for e in after if e.tag == "table" and e.has_class("tabdoc")), None)
    rows: list[tuple] = []
    if table is not None:
        for tr in table.find_all("tr"):
            if (cell := tr.find("td", "tddocup")) is not None:
                rows.append(("category", cell.text(), None, None))
            elif (cell := tr.find("td", "document-name")) is not None and (link := cell.find("a", "govuk-link")) is not None:
                name, whole = link.text(), cell.text()
                rows.append(("document", name, link.attrs.get("href"), whole[: max(0, whole.find(name))]))
        return None, "table", rows
    for e in after:
        if e.tag == "h2":
            break
        if e.tag == "p" and (link := e.find("a")) is not None:
            rows.append(("document", link.text(), link.attrs.get("href"), None))
        elif e.tag == "p" and _DATE.fullmatch(e.text()) and len(e.text()) < 15:
            rows.append(("date", e.text(), None, None))
    return None, "paragraphs", rows


@arrow("struct<error:string,layout:string,parts:array<struct<kind:string,text:string,href:string,before:string>>>")
def board_parts(pages: pd.Series, specific: pd.Series, general: pd.Series) -> pd.DataFrame:
    found = [_board(*x) for x in zip(pages, specific, general, strict=True)]
    return pd.DataFrame({"error": [e for e, _, _ in found], "layout": [x for _, x, _ in found], "parts": _rows([r for _, _, r in found], ("kind", "text", "href", "before"))})


def carried(value: Column, keys: list[str], order: str) -> Column:
    """The last value that is not null, at or before each row."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))


class Boards(NamedTuple):
    """documents: keys, place, kategoria, datum, nazov, url, warning. failed: keys, error. linkless: documents without a link, which are left out."""

    documents: DataFrame
    failed: DataFrame
    linkless: DataFrame


def documents_of(parts: DataFrame, keys: list[str], base: str) -> tuple[DataFrame, DataFrame]:
    """``parts``: keys and b, what ``board_parts`` found. Documents, and those without a link."""
    rows = parts.filter("b.error IS NULL").select(*keys, "b.layout", F.posexplode("b.parts").alias("place", "p")).select(*keys, "layout", "place", "p.*")
    kind = F.col("kind")
    named = carried(F.when((kind == "category") & (F.col("text") != ""), F.col("text")), keys, "place")
    opened = carried(F.when(kind == "category", F.lit(UNNAMED_CATEGORY)), keys, "place")
    dated = carried(F.when(kind == "date", F.col("text")), keys, "place")
    before = F.trim(F.regexp_replace(F.trim("before"), r"\|$", ""))
    rows = rows.withColumn("kategoria", F.when(F.col("layout") == "table", F.coalesce(named, opened)).otherwise(""))
    rows = rows.withColumn("datum", F.when(F.col("layout") == "table", F.when(is_date_like(before), before)).otherwise(dated))
    docs = rows.filter("kind = 'document' AND kategoria IS NOT NULL").withColumn("url", join_url(F.lit(base), F.col("href")))
    warning = F.when(F.col("url").isNull(), "link without href").when(F.col("datum").isNull(), "document without date")
    docs = docs.select(*keys, "place", "kategoria", iso_date(F.col("datum")).alias("datum"), F.col("text").alias("nazov"), "url", warning.alias("warning"))
    return docs.filter("url IS NOT NULL"), docs.filter("url IS NULL")


def board_documents(pages: DataFrame, keys: list[str], base: str = "https://www.minv.sk", specific: str | Column | None = None, general: str | Column | None = GENERAL_HEADING) -> Boards:
    """``pages``: the keys and html. The headings may be columns, as pages of a fallback have another.

    In a table, a category holds until the next named one and an unnamed first one gets a name; in paragraphs, a
    date holds until the next. A document without a date is kept with a warning, one without a link is left out.
    """
    heading = lambda h: h if isinstance(h, Column) else F.lit(h).cast("string")
    parts = pages.select(*keys, board_parts("html", heading(specific), heading(general)).alias("b"))
    docs, linkless = documents_of(parts, keys, base)
    return Boards(docs, parts.filter("b.error IS NOT NULL").select(*keys, "b.error"), linkless)


def _news(html: str, base: str) -> list[tuple]:
    box = parse(html).find("div", "news")
    out = []
    for item in box.find_all("div", "news_content", direct=True) if box is not None else []:
        link, title, body = item.find("a", direct=True), item.find("h4"), item.find("div", "news_text")
        url = urljoin(base, link.attrs["href"]) if link is not None and "href" in link.attrs else ""
        name = title.text() if title is not None else link.text() if url else ""
        date, rest = "", ""
        if body is not None:
            if (span := body.find("span", "news_date")) is not None:
                date = span.text()
                span.parent.children.remove(span)
            rest = body.text(" ")
        out.append((name, url, date, rest))
    return out


@arrow("array<struct<nazov:string,url:string,datum:string,popis:string>>")
def news_items(pages: pd.Series, base: pd.Series) -> pd.Series:
    return _rows([_news(p, b) for p, b in zip(pages, base, strict=True)], ("nazov", "url", "datum", "popis"))


def listing(pages: DataFrame, keys: list[str], base: str) -> DataFrame:
    """Documents of list pages (keys, html): keys, place, nazov, url, datum, popis."""
    rows = pages.select(*keys, F.posexplode(news_items("html", F.lit(base))).alias("place", "d")).select(*keys, "place", "d.*")
    return rows.withColumn("datum", iso_date(F.col("datum")))


def _next(html: str, number: int, base: str) -> str | None:
    box = parse(html).find("div", "news_pages_bottom")
    for link in box.find_all("a") if box is not None else []:
        page = parse_qs(urlparse(link.attrs.get("href", "")).query).get("page", [""])[0]
        if page.isdigit() and int(page) == number + 1:
            return urljoin(base, link.attrs["href"])
    return None


@arrow("string")
def next_page(pages: pd.Series, number: pd.Series, base: pd.Series) -> pd.Series:
    """The link to the page after this one, null on the last."""
    return pd.Series([_next(*x) for x in zip(pages, number, base, strict=True)], dtype=object)


def contiguous(pages: DataFrame, number: str = "page", keys: list[str] | None = None) -> DataFrame:
    """Pages up to the first gap in their numbers, from 1."""
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(number)
    return pages.withColumn("_n", F.row_number().over(w)).filter(F.col(number) == F.col("_n")).drop("_n")


@arrow("array<string>")
def breadcrumb(pages: pd.Series) -> pd.Series:
    """The link texts of the page's breadcrumb; null without one."""

    def one(html):
        box = parse(html).find("div", "breadcrumb")
        return None if box is None else [a.text() for a in box.find_all("a")]

    return pd.Series([one(p) for p in pages], dtype=object)


#: Characters of Markdown in one batch of results, about.
_HELD = 1_000_000


def _one_markdown(page: str | None) -> str | None:
    e = parse(page).find("main")
    return None if e is None else markdown(e)


def main_markdown(pages: Column | str) -> Column:
    """The <main> element as Markdown; null without one."""
    return F.arrow_udf(lambda array: pa.array((_one_markdown(page.as_py()) for page in array), pa.string()), "string")(pages)


def _markdown_batches(batches: Iterator[pa.RecordBatch], keep: list[str], html: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, told, size, begin = batch.select(keep), [], 0, 0
        for at in range(batch.num_rows):
            told.append(_one_markdown(batch[html][at].as_py()))
            size += len(told[-1] or "")
            if size >= _HELD or at + 1 == batch.num_rows:
                yield pa.RecordBatch.from_arrays([*kept.slice(begin, len(told)).columns, pa.array(told, pa.string())], schema=schema)
                told, size, begin = [], 0, at + 1


def with_markdown(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """``keep`` and ``text``, the <main> element as Markdown; results leave a task in small batches, so it holds one batch of pages and one tree."""
    schema = T.StructType([pages.schema[c] for c in keep]).add("text", "string")
    wanted = to_arrow_schema(schema)
    return pages.select(*keep, html).mapInArrow(lambda batches: _markdown_batches(batches, keep, html, wanted), schema)


def placed(pages: DataFrame) -> DataFrame:
    """``pages``: url, html. Adds kraj, okres, doc_id, text and error: what a page says of its place and content."""
    links = F.col("_links")
    third, fourth = F.get(links, F.lit(2)), F.get(links, F.lit(3))
    raw_region = F.when(third.startswith("Kraj ") | (third == MINISTRY), third)
    raw_district = F.when(fourth.startswith("Okresný úrad "), fourth)
    kraj = F.nullif(region_name(raw_region), F.lit(""))
    okres = F.when(kraj == MINISTRY, F.lit(MINISTRY)).otherwise(F.nullif(district_name(raw_district), F.lit("")))
    rows = pages.withColumn("_links", breadcrumb("html")).withColumn("text", main_markdown("html"))
    rows = rows.withColumn("kraj", kraj).withColumn("okres", okres).withColumn("doc_id", file_id(F.col("url")))
    error = F.when(F.col("kraj").isNull(), "region not found in the breadcrumb").when(F.col("okres").isNull(), "district not found in the breadcrumb").when(F.col("doc_id").isNull(), "no document id in the URL").when(F.col("text").isNull(), "no main element")
    rows = rows.withColumn("error", error)
    blank = lambda c: F.when(F.col("error").isNull(), F.col(c)).alias(c)
    return rows.select(*(c for c in pages.columns), blank("kraj"), blank("okres"), blank("doc_id"), blank("text"), "error")
