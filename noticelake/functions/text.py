"""Gates and clean-up for converted and extracted text."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from noticelake.functions.arrow import arrow

#: Below so many characters a converted file counts as a picture.
OCR_BELOW = 32
#: Stage results shorter than this are made again.
LEAST_OUTPUT = 10
DOCUMENT_SEPARATOR = "\n\n---\n\n"
ARCHIVE_SEPARATOR = "\n\n--- Nový Súbor v Archíve ---\n\n"

#: The characters that count as white space at the ends of a text (fixed by Unicode, with the separators 1C to 1F).
_WHITE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(text: Column) -> Column:
    """White space of every kind removed from both ends."""
    return F.trim(text, F.lit(_WHITE))


def needs_ocr(text: Column) -> Column:
    return F.length(strip(F.coalesce(text, F.lit("")))) < OCR_BELOW


def is_blank(text: Column) -> Column:
    return strip(F.coalesce(text, F.lit(""))) == ""


def without_fences(text: Column) -> Column:
    """A fenced code block's content; other text only stripped."""
    body = strip(F.regexp_replace(strip(text), r"^```(?:markdown)?", ""))
    return strip(F.regexp_replace(body, r"```$", ""))


def decoded(content: Column) -> Column:
    """UTF-8 text of bytes, undecodable ones replaced."""
    return _decode(content)


@arrow("string")
def _decode(content: pd.Series) -> pd.Series:
    return content.map(lambda b: None if b is None else bytes(b).decode("utf-8", "replace"))


@arrow("struct<value:string,error:string>")
def strict_json(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """value: the JSON text written anew if the whole of it is JSON; error: why not. Null is an error.

    Built-in JSON functions read the first value and ignore what follows it, so they cannot judge validity.
    """
    for batch in texts:
        rows = []
        for text in batch:
            try:
                rows.append((json.dumps(json.loads(text), ensure_ascii=False), None))
            except (TypeError, ValueError) as e:
                rows.append((None, f"{type(e).__name__}: {e}"))
        yield pd.DataFrame(rows, columns=["value", "error"])
