"""Files to text and text to records, through converters and an extractor that the caller supplies.

Each step is an Arrow function over the rows that need it; a failure is that row's error and no one else's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.functions.text import ARCHIVE_SEPARATOR, is_blank, needs_ocr, strict_json, strip, without_fences
from noticelake.functions.urls import office_format
from noticelake.operators.prompts import joined
from noticelake.sources.files import unpacked


@dataclass
class Converters:
    """pdf: bytes to text; ocr: bytes of a PDF to text; office: (bytes, input format) to Markdown. None: not available."""

    pdf: Callable[[bytes], str] | None = None
    ocr: Callable[[bytes], str] | None = None
    office: Callable[[bytes, str], str] | None = None


def _guarded(f, name: str):
    """An Arrow function struct<value, error> around ``f``, which gets a row's arguments."""

    @F.pandas_udf("struct<value:string,error:string>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for wanted, body, extra in batches:
            rows = []
            for w, b, x in zip(wanted, body, extra, strict=True):
                try:
                    if not w:
                        rows.append((None, None))
                    elif f is None:
                        rows.append((None, f"no {name} converter"))
                    else:
                        rows.append((f(bytes(b), x), None))
                except Exception as e:  # contained in the row
                    rows.append((None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["value", "error"])

    # Not deterministic, so that no rewriting of the plan converts a file twice.
    return run.asNondeterministic()


def _plain(data: bytes, _) -> str:
    return data.decode("utf-8", "replace")


def file_texts(files: DataFrame, converters: Converters) -> DataFrame:
    """``files``: file_name, content. Adds text and error. PDFs with hardly any text go to OCR, whose answer loses its fences."""
    name = F.lower("file_name")
    suffix, office = F.regexp_extract(name, r"(\.[^.]+)$", 1), office_format(name)
    pdf = _guarded(converters.pdf and (lambda b, _: converters.pdf(b)), "PDF")
    ocr = _guarded(converters.ocr and (lambda b, _: converters.ocr(b)), "OCR")
    doc = _guarded(converters.office and (lambda b, x: converters.office(b, x)), "office")
    plain, none = _guarded(_plain, "text"), F.lit(None).cast("string")
    rows = files.withColumn("_pdf", pdf(suffix == ".pdf", "content", none)).withColumn("_office", doc(office.isNotNull(), "content", office)).withColumn("_plain", plain(suffix == ".txt", "content", none))
    thin = (suffix == ".pdf") & F.col("_pdf.error").isNull() & needs_ocr(F.col("_pdf.value"))
    rows = rows.withColumn("_ocr", ocr(thin, "content", none))
    text = F.when(thin, without_fences(F.col("_ocr.value"))).when(suffix == ".pdf", strip(F.col("_pdf.value"))).when(office.isNotNull(), F.col("_office.value")).when(suffix == ".txt", F.col("_plain.value"))
    known = (suffix == ".pdf") | office.isNotNull() | (suffix == ".txt")
    error = F.coalesce(F.col("_pdf.error"), F.col("_office.error"), F.col("_ocr.error"), F.when(~known, F.concat(F.lit("unsupported file type: "), F.col("file_name"))), F.when(office.isNotNull() & is_blank(F.col("_office.value")), "conversion gave no text"))
    return rows.select(*files.columns, F.when(error.isNull(), text).alias("text"), error.alias("convert_error"))


def document_texts(files: DataFrame, converters: Converters, keys: list[str]) -> DataFrame:
    """``files``: keys, file_name, body. One row per document: keys, text, errors. Archives give their members' texts joined."""
    # A part that could not be unpacked has no name to be converted by. One grouping reads each conversion once.
    parts = unpacked(files).withColumn("member", F.coalesce("member", "file_name"))
    texts = file_texts(parts.withColumn("file_name", F.when(F.col("error").isNull(), F.col("member"))), converters)
    errors = F.sort_array(F.collect_list(F.coalesce("error", "convert_error")))
    text = F.nullif(joined(F.col("text"), F.col("member"), ARCHIVE_SEPARATOR), F.lit(""))
    told = texts.groupBy(*keys).agg(text.alias("text"), errors.alias("errors")).withColumn("errors", F.when(F.size("errors") > 0, F.col("errors")))
    return files.select(*keys).distinct().join(told, keys, "left")


def extracted(docs: DataFrame, extractor: Callable[[str], str], text: Column, skip: bool = False) -> DataFrame:
    """``docs`` with analysis_raw, analysis (strict JSON text) and error, by ``extractor`` (text to model output).

    Documents without text are errors and never sent; with ``skip`` none is sent and there is no error.
    """
    none = F.lit(None).cast("string")
    if skip:
        return docs.select("*", none.alias("analysis_raw"), none.alias("analysis"), none.alias("error"))

    @F.pandas_udf("struct<value:string,error:string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                try:
                    rows.append((extractor(t), None) if t is not None else (None, "no text to analyse"))
                except Exception as e:  # contained in the row
                    rows.append((None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["value", "error"])

    rows = docs.withColumn("_out", run.asNondeterministic()(F.when(~is_blank(text), text)))
    rows = rows.withColumn("_json", strict_json(without_fences(F.col("_out.value"))))
    error = F.coalesce(F.col("_out.error"), F.col("_json.error"))
    return rows.select(*docs.columns, F.col("_out.value").alias("analysis_raw"), F.when(error.isNull(), F.col("_json.value")).alias("analysis"), error.alias("error"))


def described(popis: Column, text: Column) -> Column:
    """A listed document's text after its description."""
    return F.concat_ws("\n\n", F.nullif(popis, F.lit("")), text)


def analysis_fields(analysis: Column, schema) -> Column:
    """A stored analysis as typed fields; keys of other versions are read where the schema names them."""
    return F.from_json(analysis, schema)
