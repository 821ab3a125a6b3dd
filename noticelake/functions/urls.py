"""URL, id and name expressions. All are Column to Column and run inside code generation."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelake.functions.arrow import arrow

#: Region names as one source writes them, and as the other does (fixed values).
REGIONS = {
    "Kraj Bratislava": "Bratislavský kraj",
    "Kraj Trnava": "Trnavský kraj",
    "Kraj Trenčín": "Trenčiansky kraj",
    "Kraj Nitra": "Nitriansky kraj",
    "Kraj Banská Bystrica": "Banskobystrický kraj",
    "Kraj Žilina": "Žilinský kraj",
    "Kraj Košice": "Košický kraj",
    "Kraj Prešov": "Prešovský kraj",
}
MINISTRY = "Ministerstvo"

#: File suffixes of MIME types (fixed values).
SUFFIXES = {
    "application/pdf": ".pdf",
    "application/msword": ".doc",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": ".docx",
    "application/vnd.ms-excel": ".xls",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": ".xlsx",
    "text/plain": ".txt",
    "application/xml": ".xml",
    "application/json": ".json",
    "image/jpeg": ".jpg",
    "image/png": ".png",
    "image/gif": ".gif",
    "application/vnd.ms-powerpoint": ".ppt",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": ".pptx",
    "application/rtf": ".rtf",
    "text/csv": ".csv",
    "application/zip": ".zip",
    "application/vnd.rar": ".rar",
}
#: Input formats of the office converter by file suffix (fixed values).
OFFICE_FORMATS = {".docx": "docx", ".doc": "rtf", ".rtf": "rtf", ".pptx": "pptx", ".ppt": "ppt", ".xlsx": "xlsx", ".xls": "xls"}
#: Icons of status levels (fixed values).
ICONS = {"error": "❌", "warning": "⚠️", "info": "ℹ️"}

PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
STEM = r"^(.*[^.].*)\.[^.]*$"


def lookup(key: Column, pairs: dict[str, str]) -> Column:
    """The pair's value, null for other keys."""
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv)), key)


def path_stem(url: Column) -> Column:
    """The last path segment without its suffix; empty if the path ends in a slash."""
    base = F.regexp_extract(F.regexp_extract(url, PATH, 1), "([^/]*)$", 1)
    return F.regexp_replace(base, STEM, "$1")


def query_value(url: Column, name: str) -> Column:
    """The first value of a query parameter that is not blank, decoded; empty without one."""
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    raw = F.regexp_extract(query, f"(?:^|&){name}=([^&]+)", 1)
    return F.coalesce(F.try_url_decode(raw), F.replace(raw, F.lit("+"), F.lit(" ")))


def url_hash(url: Column) -> Column:
    return F.concat(F.lit("urlhash_"), F.substring(F.sha2(url, 256), 1, 16))


def doc_id(url: Column, parameter: str = "subor", stem_host: str = "www.minzp.sk", stem_prefix: str = "ou-") -> Column:
    """A document's id: file stem on one host, else a query parameter, else the stem of a marked file, else a hash."""
    value, stem = query_value(url, parameter), path_stem(url)
    base = F.regexp_extract(F.regexp_extract(url, PATH, 1), "([^/]*)$", 1)
    return (
        F.when(url.isNull() | (url == ""), F.lit(None).cast("string"))
        .when(url.contains(stem_host), stem)
        .when(value != "", value)
        .when(F.lower(base).startswith(stem_prefix), stem)
        .otherwise(url_hash(url))
    )


def file_id(url: Column) -> Column:
    """The stem of the URL's path, null if empty."""
    return F.nullif(path_stem(url), F.lit(""))


def parameter_id(url: Column, parameter: str = "subor") -> Column:
    """The query parameter alone, null if absent."""
    return F.nullif(query_value(url, parameter), F.lit(""))


def district_name(name: Column) -> Column:
    """Without the office's prefix; empty for null."""
    return F.coalesce(F.trim(F.regexp_replace(name, r"(?iu)^Okresný úrad\s+", "")), F.lit(""))


def region_name(name: Column) -> Column:
    """Known regions renamed, others as they are; empty for null."""
    return F.coalesce(lookup(name, REGIONS), name, F.lit(""))


def file_suffix(content_type: Column) -> Column:
    return F.coalesce(lookup(F.trim(F.split(content_type, ";")[0]), SUFFIXES), F.lit(".bin"))


def office_format(file_name: Column) -> Column:
    """The converter's format for a file name, null for others."""
    return lookup(F.regexp_extract(F.lower(file_name), r"(\.[^.]+)$", 1), OFFICE_FORMATS)


def status_icon(level: Column) -> Column:
    """The icon of a level; other levels as they are."""
    return F.coalesce(lookup(F.lower(level), ICONS), level)


def absolute(url: Column, host: str) -> Column:
    return F.when(url.startswith("/"), F.concat(F.lit(host), url)).otherwise(url)


def board_link(url: Column, host: str = "https://www.minv.sk", anchor: str = "#popis") -> Column:
    full = absolute(url, host)
    return F.when((full != "") & ~full.endswith(anchor), F.concat(full, F.lit(anchor))).otherwise(full)


@arrow("string")
def join_url(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """A link resolved against a base; null without a link."""
    for base, link in pairs:
        yield pd.Series([urljoin(b or "", x) if x else None for b, x in zip(base, link, strict=True)], dtype=object)


def safe_file_name(name: Column) -> Column:
    """Accents dropped, everything but word characters to single underscores, none at the ends."""
    plain = F.octet_length(name) == F.char_length(name)
    # Names of ASCII characters need no Python: the others only are sent there.
    return F.when(plain, F.trim(F.regexp_replace(name, "[^A-Za-z0-9]+", "_"), F.lit("_"))).otherwise(_safe_file_name(F.when(~plain, name)))


@arrow("string")
def _safe_file_name(names: pd.Series) -> pd.Series:
    import re
    import unicodedata

    def one(name):
        if name is None:
            return None
        plain = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
        return re.sub(r"[\W_]+", "_", plain).strip("_")

    return names.map(one)
