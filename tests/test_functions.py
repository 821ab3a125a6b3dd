import pytest
from pyspark.sql import functions as F

from noticelake.functions import dates, text, urls


def column(spark, values, f):
    df = spark.createDataFrame(list(enumerate(values)), "k int, v string")
    return [r[0] for r in df.orderBy("k").select(f(F.col("v"))).collect()]


#: URLs and their ids (fixed values).
IDS = [
    (None, None),
    ("", None),
    ("https://example.com/?subor=fileid123", "fileid123"),
    ("https://example.com/path?subor=anotherID&other=val", "anotherID"),
    ("https://example.com/?subor=ID%20%26%3D", "ID &="),
    ("https://example.com/?subor=", "urlhash_728ef0369b7e3a10"),
    ("https://example.com/?subor=first&subor=second", "first"),
    ("https://example.com/path/to/OU-document.pdf", "OU-document"),
    ("https://example.com/path/to/OU-file_no_ext", "OU-file_no_ext"),
    ("https://example.com/path/to/someOU-document.pdf", "urlhash_4c6f77701238357b"),
    ("https://example.com/OU-.pdf", "OU-"),
    ("https://example.com/some/other/file.txt", "urlhash_3cf6329e2978883b"),
    ("https://example.com/some/path/", "urlhash_5982a8272c315256"),
    ("http://example.com", "urlhash_f0e6a6a97042a4f1"),
    ("https://example.com/?param=value", "urlhash_05773612f50be9ba"),
    ("htp://invalid-url", "urlhash_a3416524142d2783"),
    ("://", "urlhash_5a5e2bae0f508e87"),
    ("https://example.com/doc.pdf#page=2", "urlhash_d156c65b1d2e3524"),
    ("https://example.com/file.pdf?query=OU-test", "urlhash_25150f3caeb099ca"),
    ("https://OU-example.com/file.pdf", "urlhash_74d92587a495bd16"),
    ("http://[::1]:8080/path", "urlhash_16d2708252bb8faa"),
    ("/path/to/document.pdf", "urlhash_dde0eea691f15807"),
    ("document.pdf", "urlhash_5cf35f3f6ff897f2"),
    ("https://www.minzp.sk/ou-zilina/ou-za-oszp1-2025-049674-bra.html", "ou-za-oszp1-2025-049674-bra"),
    ("https://www.minzp.sk/ochrana-prirody/spravne-konania/kraj-trnava/ou-trnava/nova-web-stranka.html", "nova-web-stranka"),
    ("http://a.sk/x y.pdf?subor=1", "1"),
    ("http://a.sk/?subor=&subor=x", "x"),
    ("http://a.sk/?subor=a+b%zz", "a b%zz"),
    ("http://a.sk/OU-a|b.pdf", "OU-a|b"),
    ("http://a.sk/ou-x.tar.gz", "ou-x.tar"),
    ("http://a.sk/OU-č.pdf", "OU-č"),
    ("https://www.minzp.sk/.hidden", ".hidden"),
    ("http://a.sk/p?xsubor=1&subor=2#f?subor=3", "2"),
]


def test_doc_id(spark):
    assert column(spark, [u for u, _ in IDS], urls.doc_id) == [i for _, i in IDS]
    assert column(spark, ["http://a.sk/uradna/"], urls.doc_id)[0].startswith("urlhash_")
    assert column(spark, ["http://x.sk/a.html", "http://x.sk/", None], urls.file_id) == ["a", None, None]
    assert column(spark, ["http://x.sk/?subor=q", "http://x.sk/", None], urls.parameter_id) == ["q", None, None]


def test_names(spark):
    assert column(spark, ["Okresný úrad Žilina", "okresný ÚRAD  Nitra ", None, ""], urls.district_name) == ["Žilina", "Nitra", "", ""]
    assert column(spark, ["Kraj Žilina", "Ministerstvo", None], urls.region_name) == ["Žilinský kraj", "Ministerstvo", ""]
    assert column(spark, ["application/pdf; charset=x", "text/csv", "x/y", None, ""], urls.file_suffix) == [".pdf", ".csv", ".bin", ".bin", ".bin"]
    assert column(spark, ["A.DOC", "b.docx", "c.pdf", None], urls.office_format) == ["rtf", "docx", None, None]
    assert column(spark, ["Error", "INFO", "critical", None], urls.status_icon) == ["❌", "ℹ️", "critical", None]
    assert column(spark, ["Žltá  skala / č. 5!", "__a__", None], urls.safe_file_name) == ["Zlta_skala_c_5", "a", None]
    assert column(spark, ["/x", "https://y#popis", "", None], urls.board_link) == ["https://www.minv.sk/x#popis", "https://y#popis", "", None]
    assert column(spark, ["?a=1", "//h/p", "", None], lambda c: urls.join_url(F.lit("https://b.sk/d/e"), c)) == ["https://b.sk/d/e?a=1", "https://h/p", None, None]


def test_dates(spark):
    nbsp = chr(0xA0)
    good = {"30. 4. 2025": "2025-04-30", "30.4.2025": "2025-04-30", "30.4. 2025": "2025-04-30", "30. 4.2025": "2025-04-30", "30.  4.  2025": "2025-04-30", "2025-04-30": "2025-04-30", "2025-4-3": "2025-04-03", f"1.{nbsp}5.{nbsp}2025": "2025-05-01"}
    kept = ["31. 2. 2025", "1.5.25", "", "4. máj 2025", " 30.4.2025", "30.4.2025 ", "30. 4 .2025", "25-4-3", "02025-4-3", "2025-13-1", "0.4.2025", "99999-1-1", None]
    assert column(spark, [*good, *kept], dates.iso_date) == [*good.values(), *kept]
    assert column(spark, ["1.5.25", " 30. 4. 2025 ", "4. máj 2025", "30. 4. 2025 10:00", None], dates.is_date_like) == [True, True, False, False, False]
    assert column(spark, ["2025-12-31 10:00:01", "x", "", None], lambda c: dates.shown_date(c, True)) == ["31. 12. 2025 10:00:01", "x", "N/A", "N/A"]
    assert column(spark, ["2025-01-05"], lambda c: dates.days_before(c.cast("date"), 7)) == ["2024-12-29"]


def test_text(spark):
    nbsp = chr(0xA0)
    assert column(spark, [f" {nbsp}\n ab c\t", None], text.strip) == ["ab c", None]
    assert column(spark, ["x" * 31 + "   ", "x" * 32, None], text.needs_ocr) == [True, False, True]
    assert column(spark, [" \n", None, "a"], text.is_blank) == [True, True, False]
    assert column(spark, ["```markdown\na\n```", "```\nb```", " c ", "d ``` e"], text.without_fences) == ["a", "b", "c", "d ``` e"]
    got = column(spark, ['{"a":1}', "null", "[1]", '{"a":1} trailing', "```{}```", "", None], text.strict_json)
    assert [r["error"] is None for r in got] == [True, True, True, False, False, False, False] and got[0]["value"] == '{"a": 1}'
    df = spark.createDataFrame([(bytes([97, 255]),)], "b binary")
    assert df.select(text.decoded(F.col("b"))).first()[0] == "a�"


@pytest.mark.parametrize("f", [urls.doc_id, urls.file_suffix, dates.iso_date, text.strip])
def test_expressions_stay_in_the_jvm(spark, f):
    df = spark.createDataFrame([("x",)], "v string").select(f(F.col("v")))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
