"""Loosely written dates. Results stay strings, as unreadable dates are kept as they are."""

from __future__ import annotations

import json
import re
from datetime import date

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelake.functions.arrow import arrow

DAY_FIRST = "^([0-9]{1,2})\\.[\\s ]*([0-9]{1,2})\\.[\\s ]*([0-9]{4})$"
YEAR_FIRST = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
DATE_LIKE = r"^[0-9]{1,2}\.\s*[0-9]{1,2}\.\s*[0-9]{2,4}$"


def iso_date(text: Column) -> Column:
    """d. m. yyyy, with or without spaces, or y-m-d as yyyy-MM-dd; anything else unchanged, null stays null."""
    part = lambda k: F.regexp_extract(text, DAY_FIRST, k)
    plain = F.when(text.rlike(DAY_FIRST), F.concat_ws("-", part(3), part(2), part(1))).when(text.rlike(YEAR_FIRST), text)
    return F.coalesce(F.date_format(F.try_to_timestamp(plain, F.lit("y-M-d")), "yyyy-MM-dd"), text)


def is_date_like(text: Column) -> Column:
    """Short and written as a date; false for null."""
    trimmed = F.trim(text)
    return F.coalesce(trimmed.rlike(DATE_LIKE) & (F.length(trimmed) < 15), F.lit(False))


def as_date(text: Column) -> Column:
    """A DATE, null if the text is none."""
    return F.try_to_date(iso_date(text), "yyyy-MM-dd")


def days_before(as_of: Column, days: int) -> Column:
    """yyyy-MM-dd of a day before ``as_of``, which is always given and never the clock."""
    return F.date_format(F.date_sub(as_of, days), "yyyy-MM-dd")


def stamp(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss")


def shown_date(text: Column, with_time: bool = False) -> Column:
    """A date for readers, N/A for null or empty, unreadable text as it is."""
    at = F.try_to_timestamp(text)
    shown = F.date_format(at, "d. M. yyyy HH:mm:ss" if with_time else "d. M. yyyy")
    return F.when(text.isNull() | (text == ""), F.lit("N/A")).otherwise(F.coalesce(shown, text))


def _iso(text):
    """One value as ``iso_date`` has it, for dates inside JSON of unknown shape."""
    if not isinstance(text, str):
        return text
    if m := re.fullmatch(r"(\d{1,2})\.\s*(\d{1,2})\.\s*(\d{4})", text):
        day, month, year = map(int, m.groups())
    elif m := re.fullmatch(r"(\d{4})-(\d{1,2})-(\d{1,2})", text):
        year, month, day = map(int, m.groups())
    else:
        return text
    try:
        return date(year, month, day).isoformat()
    except ValueError:
        return text


@arrow("string")
def json_dates(texts: pd.Series, key: pd.Series) -> pd.Series:
    """JSON texts with every string under a key, at any depth, as yyyy-MM-dd. Text that is no JSON stays."""

    def walk(value, name):
        if isinstance(value, list):
            return [walk(v, name) for v in value]
        if isinstance(value, dict):
            return {k: _iso(v) if k == name and isinstance(v, str) else walk(v, name) for k, v in value.items()}
        return value

    def one(text, name):
        try:
            return json.dumps(walk(json.loads(text), name), ensure_ascii=False)
        except (TypeError, ValueError):
            return text

    return pd.Series([one(*x) for x in zip(texts, key, strict=True)], dtype=object)
