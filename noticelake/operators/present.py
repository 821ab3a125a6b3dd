"""Views for reports: recency, display values, sorting, filters, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.dates import as_date
from noticelake.functions.urls import status_icon


def recent(docs: DataFrame, oldest: str | Column, strict: bool = False) -> DataFrame:
    """Documents dated from ``oldest`` on, compared as text; with ``strict``, as dates, so unreadable ones go."""
    since = F.lit(oldest) if isinstance(oldest, str) else oldest
    if strict:
        return docs.filter(as_date(F.col("datum")) >= since.cast("date"))
    return docs.filter((F.col("datum") != "") & (F.col("datum") >= since))


def has_analysis(analysis: Column) -> Column:
    """True for any stored analysis, one that holds an error as well."""
    return analysis.isNotNull()


def has_valid_analysis(analysis: Column) -> Column:
    return analysis.isNotNull() & F.get_json_object(analysis, "$.error").isNull()


def shown(value: Column, analysis: Column, without: str) -> Column:
    """An array's entries joined; ``without`` if there is no analysis, N/A for null."""
    return F.when(analysis.isNull(), F.lit(without)).otherwise(F.coalesce(F.array_join(value, ", "), F.lit("N/A")))


def escaped(text: Column) -> Column:
    """A text that stands for itself in HTML, in attributes too."""
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(sign), F.lit(entity))
    return text


def _link(url: Column, text: Column) -> Column:
    """A link, or the text alone without an address or with one of another kind than the web's or the site's own."""
    safe = F.coalesce(url.rlike(r"^(?i:https?:)?/") | (F.coalesce(url, F.lit("")).rlike(r"^[^:]+$")), F.lit(False))
    return F.when(safe, F.concat(F.lit('<a href="'), escaped(url), F.lit('">'), escaped(text), F.lit("</a>"))).otherwise(escaped(text))


def title_cell(status: Column, category: Column, title: Column, url: Column) -> Column:
    """The first status icon, the category if any, and the title as a link; what was scraped is escaped."""
    icon = status_icon(F.get(status, F.lit(0))["type"])
    return F.concat_ws(" ", escaped(icon), escaped(F.nullif(category, F.lit(""))), _link(url, title))


def place_cell(name: Column, url: Column) -> Column:
    """A region or district as a link where it has one; both are escaped."""
    return _link(url, name)


def summary(text: Column, doc_id: Column, status: Column, default: str = "Súhrn chýba") -> Column:
    """The summary or a default, the document's id and its status lines."""
    lines = F.transform(status, lambda s: F.concat_ws(" ", s["date"], status_icon(s["type"]), s["text"]))
    return F.concat_ws("\n", F.coalesce(F.nullif(text, F.lit("")), F.lit(default)), F.concat(F.lit("ID: "), F.coalesce(doc_id, F.lit("N/A"))), F.nullif(F.array_join(lines, "\n"), F.lit("")))


def newest_first(docs: DataFrame) -> DataFrame:
    return docs.orderBy(F.desc_nulls_last("datum"), "url")


def newest_first_by_date(docs: DataFrame) -> DataFrame:
    """By the date itself, unreadable ones last."""
    return docs.orderBy(F.desc_nulls_last(as_date(F.col("datum"))), "url")


def collation_key(value: Column, is_array: bool = False) -> Column:
    """Sorts without regard to case and accents; null like an empty text, arrays by their joined entries."""
    text = F.array_join(value, ", ") if is_array else value
    return F.collate(F.coalesce(text, F.lit("")), "UNICODE_CI_AI")


def matching(docs: DataFrame, **parts: str) -> DataFrame:
    """Rows whose columns hold the given texts, in either case; an empty text matches all."""
    for name, part in parts.items():
        if part:
            docs = docs.filter(F.contains(F.lower(F.col(name)), F.lower(F.lit(part))))
    return docs


def of_level(status: DataFrame, level: str = "") -> DataFrame:
    return status.filter(F.col("typ") == level) if level else status


def page(ordered: DataFrame, number: int, size: int = 100) -> DataFrame:
    """A page of rows in a total order; the first page is 1."""
    return ordered.offset((number - 1) * size).limit(size)


def embedded_rows(text: Column, schema: str) -> Column:
    """Rows read from a JSON text; an empty array if it is none."""
    return F.coalesce(F.from_json(text, schema, {"mode": "PERMISSIVE"}), F.from_json(F.lit("[]"), schema))
