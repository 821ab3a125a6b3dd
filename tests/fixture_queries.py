"""Cases over a few literal pages, files and answers, each with the rows that it must give."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.functions import dates
from noticelake.operators import convert, nest, present, prompts
from noticelake.sources import fetch, html

QUERIES: dict = {}
EXPECTED: dict[str, list[tuple]] = {}


def expected(columns: str, *rows: tuple):
    """A case and the rows that it must give."""

    def add(f):
        QUERIES[f.__name__] = f
        EXPECTED[f.__name__] = [dict(zip(columns.split(", "), r, strict=True)) for r in rows]
        return f

    return add


def _pages(spark: SparkSession, **pages: str | None) -> DataFrame:
    return spark.createDataFrame(list(pages.items()), "page string, html string")


_MENU = """<div class="sidemenu_list"><div class="small-nav -alt"><ul><li id="menu-item-12224"><a>Odbory</a><ul class="sub-menu">
<li class="menu-item-has-children"><a href="/sever">Sever</a><ul class="sub-menu"><li><a href="/s1"> Prvý </a></li><li>bez odkazu</li><li><a href="/s2">Druhý</a></li></ul></li>
<li class="menu-item-has-children"><a href="/bez-mena"></a><ul class="sub-menu"><li><a href="/x">X</a></li></ul></li>
<li class="menu-item-has-children"><a href="/juh">Juh</a></li></ul></li></ul></div></div>"""


@expected("page, kraj, url, okres, okres_url", ("menu", "Sever", "/sever", "Prvý", "/s1"), ("menu", "Sever", "/sever", "Druhý", "/s2"), ("menu", "Juh", "/juh", None, None))
def menu_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _pages(spark, menu=_MENU, other=_MENU.replace("small-nav", "big-nav"), none=None).select("page", F.inline(html.menu_tree("html")))
    return found.select("page", "kraj", "url", F.explode_outer("okresy").alias("o")).select("page", "kraj", "url", F.col("o.nazov").alias("okres"), F.col("o.url").alias("okres_url"))


_TABLE = """<div id="popis"><h2>O nás</h2><h2> Úradná tabuľa </h2><table class="tabdoc">
<tr><td class="document-name">1. 1. 2025 | <a class="govuk-link" href="/pred">pred kategóriou</a></td></tr>
<tr><td class="tddocup"></td></tr>
<tr><td class="document-name">30. 4. 2025 | <a class="govuk-link" href="/d?subor=1">Prvý</a></td></tr>
<tr><td class="tddocup">Lesy</td></tr>
<tr><td class="document-name"><a class="govuk-link" href="https://h/2">Druhý</a></td></tr>
<tr><td class="tddocup"></td></tr>
<tr><td class="document-name">čoskoro | <a class="govuk-link" href="/3">Tretí</a></td></tr>
<tr><td class="document-name">1. 6. 2025 | <a class="govuk-link">bez odkazu</a></td></tr>
<tr><td class="document-name">2.5.2025<a class="govuk-link" href="4">Štvrtý</a></td></tr></table></div>"""
_PARAGRAPHS = """<div id="popis"><h2>Životné prostredie / Úradná tabuľa</h2><p>30. 4. 2025</p><p><a href="/a">A</a></p><hr><p>úvod</p><p>1.5.2025</p>
<p>k <a href="/b">B</a></p><p><a>bez odkazu</a></p><h2>ďalšie</h2><p><a href="/c">C</a></p></div>"""
_BOARDS = {"table": _TABLE, "paragraphs": _PARAGRAPHS, "no_section": "<p>nič</p>", "no_heading": '<div id="popis"><h2>Iné</h2></div>', "none": None}


@expected(
    "page, kategoria, datum, nazov, url, warning",
    ("table", html.UNNAMED_CATEGORY, "2025-04-30", "Prvý", "https://www.minv.sk/d?subor=1", None),
    ("table", "Lesy", None, "Druhý", "https://h/2", "document without date"),
    ("table", "Lesy", None, "Tretí", "https://www.minv.sk/3", "document without date"),
    ("table", "Lesy", "2025-05-02", "Štvrtý", "https://www.minv.sk/4", None),
    ("paragraphs", "", "2025-04-30", "A", "https://www.minv.sk/a", None),
    ("paragraphs", "", "2025-05-01", "B", "https://www.minv.sk/b", None),
)
def board_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.board_documents(_pages(spark, **_BOARDS), ["page"], specific="životné prostredie").documents.drop("place")


@expected("page, error", ("no_section", "section #popis not found"), ("no_heading", "heading not found"), ("none", "section #popis not found"), ("table", "link without href: bez odkazu"), ("paragraphs", "link without href: bez odkazu"))
def board_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.board_documents(_pages(spark, **_BOARDS), ["page"], specific="životné prostredie")
    return found.failed.unionByName(found.linkless.select("page", F.concat_ws(": ", "warning", "nazov").alias("error")))


def _news(number: int, last: int) -> str:
    more = "" if number == last else f'<a href="/zoznam?page={number + 1}">ďalej</a>'
    return f"""<div class="news"><div class="news_content"><a href="/doc/{number}.html">odkaz</a><h4>Správa {number}</h4><div class="news_text"><span class="news_date">{number}. 2. 2025</span> o <b>lese</b></div></div>
<div><div class="news_content"><h4>vnorená</h4></div></div></div><div class="news_pages_bottom"><a href="/zoznam?page=1">1</a>{more}</div>"""


@expected("page, nazov, url, datum, popis", *((n, f"Správa {n}", f"https://h/doc/{n}.html", f"2025-02-0{n}", "o lese") for n in (1, 2, 3)))
def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list followed to its last page, without storing the rounds, as its pages are literals."""
    site = {f"https://h/zoznam?page={n}": (200, "text/html", _news(n, 3).encode()) for n in (1, 2, 3)}
    pages = fetch.crawl(spark.createDataFrame([("https://h/zoznam?page=1",)], "url string"), site.__getitem__, lambda rows, n: rows, "https://h")
    return html.listing(pages.select("page", "html"), ["page"], "https://h").drop("place")


_PAGE = '<div class="breadcrumb"><a>D</a><a>U</a><a>Kraj Žilina</a><a>Okresný úrad Martin</a></div><main><h1>Názov</h1><p>Text <b>tučný</b> a <i>šikmý</i> <a href="/x">odkaz</a>.</p><ul><li>a</li><li>b</li></ul><ol><li>c</li></ol></main>'


@expected(
    "url, kraj, okres, doc_id, text, error",
    ("https://h/a.html", "Žilinský kraj", "Martin", "a", "# Názov\n\nText **tučný** a *šikmý* [odkaz](/x).\n\n* a\n* b\n\n1. c", None),
    ("https://h/b.html", "Ministerstvo", "Ministerstvo", "b", "# Názov\n\nText **tučný** a *šikmý* [odkaz](/x).\n\n* a\n* b\n\n1. c", None),
    ("https://h/c.html", None, None, None, None, "district not found in the breadcrumb"),
    ("https://h/d.html", None, None, None, None, "region not found in the breadcrumb"),
    ("https://h/", None, None, None, None, "no document id in the URL"),
    ("https://h/e.html", None, None, None, None, "no main element"),
)
def item_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [("https://h/a.html", _PAGE), ("https://h/b.html", _PAGE.replace("Kraj Žilina", "Ministerstvo")), ("https://h/c.html", _PAGE.replace("Okresný úrad ", "")), ("https://h/d.html", "<main></main>"), ("https://h/", _PAGE), ("https://h/e.html", _PAGE.replace("main", "div"))]
    return html.placed(spark.createDataFrame(rows, "url string, html string")).drop("html")


def _zip(**members: bytes) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), data)
    return out.getvalue()


def _office(data: bytes, kind: str) -> str:
    if data == b"broken":
        raise RuntimeError("cannot convert")
    return f"{kind}: {data.decode()}"


@expected(
    "url, text, errors",
    ("archive", "prvý\n\n--- Nový Súbor v Archíve ---\n\ndruhý", "unsupported file type: b/c.bin"),
    ("broken", None, "BadZipFile: File is not a zip file"),
    ("rar", None, "RAR archives are not supported"),
    ("plain", "text �", None),
    ("pdf", "a page with more text than the limit", None),
    ("picture", "read by eye", None),
    ("office", "docx: D", None),
    ("old", "rtf: D", None),
    ("bad", None, "RuntimeError: cannot convert"),
    ("empty", None, "conversion gave no text"),
    ("none", None, "unsupported file type: orig.bin"),
)
def converted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [
        ("archive", "orig.zip", _zip(b__c_dot_bin=b"?", d_dot_txt="druhý".encode(), a_dot_txt="prvý".encode())), ("broken", "orig.zip", b"broken"), ("rar", "orig.rar", b""), ("plain", "orig.txt", b"text \xff"), ("pdf", "orig.pdf", b" a page with more text than the limit \n"),
        ("picture", "orig.PDF", b"scan"), ("office", "orig.docx", b"D"), ("old", "orig.doc", b"D"), ("bad", "orig.xlsx", b"broken"), ("empty", "orig.pptx", b""), ("none", "orig.bin", b"x"),
    ]
    tools = convert.Converters(pdf=bytes.decode, ocr=lambda b: "```markdown\nread by eye\n```", office=lambda b, kind: " " if kind == "pptx" else _office(b, kind))
    done = convert.document_texts(spark.createDataFrame(rows, "url string, file_name string, body binary"), tools, ["url"])
    return done.withColumn("errors", F.array_join("errors", "; "))


@expected("k, raw, analysis, failed", (1, '```json\n{"a": 1}\n```', None, 1), (2, '```\n{"a": [1, null]}\n```', '{"a": [1, null]}', 0), (3, '{"a": 1} and more', None, 1), (4, None, None, 1), (5, None, None, 1), (6, "null", "null", 0))
def extracted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = {"one": '```json\n{"a": 1}\n```', "two": '```\n{"a": [1, null]}\n```', "three": '{"a": 1} and more', "six": "null"}
    docs = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three"), (4, "four"), (5, " \n"), (6, "six")], "k int, t string")
    done = convert.extracted(docs, answers.__getitem__, F.col("t"))
    return done.select("k", F.col("analysis_raw").alias("raw"), "analysis", F.col("error").isNotNull().cast("int").alias("failed"))


@expected("url, http_status, error, used_fallback, file_name", ("h/1", "200", None, 0, "orig.pdf"), ("h/404", "200", None, 1, "orig.txt"), ("h/none/404", "404", "HTTP 404", 0, "orig.bin"), ("h/500", "500", "HTTP 500", 0, "orig.bin"), ("h/slow", None, "TimeoutError: late", 0, "orig.bin"), (None, None, "ValueError: no URL", 0, "orig.bin"))
def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    def get(url: str):
        if url == "h/slow":
            raise TimeoutError("late")
        return (404, "", b"") if url.endswith("404") else (500, "", b"") if url == "h/500" else (200, "application/pdf; q" if url == "h/1" else "text/plain", b"x")

    rows = spark.createDataFrame([("h/1", None), ("h/404", "h/2"), ("h/none/404", None), ("h/500", "h/2"), ("h/slow", "h/2"), (None, None)], "url string, fallback_url string")
    got = fetch.stored_name(fetch.fetch_with_fallback(rows, get))
    return got.select("url", F.col("http_status").cast("string").alias("http_status"), "error", F.col("used_fallback").cast("int").alias("used_fallback"), "file_name")


@expected("url, attempts, error", ("h/0", 1, None), ("h/1", 2, None), ("h/2", 3, None), ("h/9", 3, "attempt 3"), (None, 1, "no URL"))
def retried_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds over rows that fail as often as their number says; the third and last is the end of the others."""
    rounds: list[int] = []

    def attempt(left: DataFrame) -> DataFrame:
        rounds.append(len(rounds) + 1)
        fails = F.substring("url", 3, 1).cast("int") >= rounds[-1]
        error = F.when(F.col("url").isNull(), "no URL").when(fails, f"attempt {rounds[-1]}")
        return left.withColumn("attempts", F.lit(rounds[-1])).withColumn("error", error)

    rows = spark.createDataFrame([("h/0",), ("h/1",), ("h/2",), ("h/9",), (None,)], "url string")
    return fetch.in_rounds(rows, attempt, lambda df, n: df, (1, 1), lambda seconds: None)


@expected("place, url", (1, "b"), (2, "a"), (3, "c"))
def typed_date_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted by the date itself: as text, the second would come first."""
    rows = spark.createDataFrame([("9. 1. 2025", "a"), ("10. 2. 2025", "b"), ("soon", "c"), (None, "d"), ("", "e")], "datum string, url string")
    page = present.page(present.newest_first_by_date(rows), 1, 3)
    return page.select(F.when(F.col("url") == "b", 1).when(F.col("url") == "a", 2).otherwise(3).alias("place"), "url")


@expected("k, n", (1, 2), (2, 0), (3, 0), (4, 0))
def embedded_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([(1, '[{"a": 1}, {"a": 2}]'), (2, "[]"), (3, ""), (4, None)], "k int, t string")
    return rows.select("k", F.size(present.embedded_rows(F.col("t"), "array<struct<a:int>>")).alias("n"))


@expected("k, kept", (1, "a"), (2, ""))
def full_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([(1, [("a", ["x"]), ("b", [])]), (2, [])], "k int, c array<struct<kategoria:string,dokumenty:array<string>>>")
    return rows.select("k", F.array_join(nest.without_empty_categories(F.col("c"))["kategoria"], ",").alias("kept"))


@expected("k, t", (1, '{"datum": "2025-04-30", "d": [{"datum": "2025-05-01"}, {"datum": "31. 2. 2025"}, {"nazov": "1. 5. 2025"}, {"datum": null}]}'), (2, "no json"), (3, None))
def dates_in_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(1, '{"datum": "30. 4. 2025", "d": [{"datum": "1.5.2025"}, {"datum": "31. 2. 2025"}, {"nazov": "1. 5. 2025"}, {"datum": null}]}'), (2, "no json"), (3, None)]
    return spark.createDataFrame(rows, "k int, t string").select("k", dates.json_dates("t", F.lit("datum")).alias("t"))


@expected("kind, row", ("found", "K/O/1/text.txt: hello"), ("missing", "K/O/2"))
def sampled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.createDataFrame([("K", "O", "1"), ("K", "O", "2")], "kraj string, okres string, doc_id string")
    store = spark.createDataFrame([("K", "O", "1", "text.txt", "hello"), ("K", "O", "1", "analysis.json", "{}"), ("K", "P", "2", "text.txt", "other")], "kraj string, okres string, doc_id string, file_name string, content string")
    found, missing = prompts.examples(docs, store)
    told = found.select(F.lit("found").alias("kind"), F.concat_ws(": ", "path", "content").alias("row"))
    return told.union(missing.select(F.lit("missing"), F.concat_ws("/", "kraj", "okres", "doc_id")))
