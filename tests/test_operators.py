import pytest
from pyspark.sql import functions as F

from noticelake.operators import convert, delta, enrich, nest, present, prompts, sample, schema, status


def doc(n, url, datum="2025-01-01"):
    return {"datum": datum, "nazov": n, "url": url}


BOARDS = [
    {"kraj": "B", "url": "/b", "okresy": [
        {"nazov": "b1", "url": "/b1", "url_tabule": "/t1", "error": None, "dokumenty_zivotne_prostredie": [{"kategoria": "k2", "dokumenty": [doc("x", "u1", "2025-02-01"), doc("y", "u2")]}, {"kategoria": "k1", "dokumenty": [doc("z", None)]}]},
        {"nazov": "b2", "url": "/b2", "url_tabule": None, "error": "e", "dokumenty_zivotne_prostredie": []},
    ]},
    {"kraj": "A", "url": "/a", "okresy": [{"nazov": "a1", "url": "/a1", "url_tabule": "/t", "error": None, "dokumenty_zivotne_prostredie": [{"kategoria": "", "dokumenty": [doc("v", "u1", None)]}, {"kategoria": "empty", "dokumenty": []}]}]},
    {"kraj": "C", "url": "/c", "okresy": []},
]


@pytest.fixture
def boards(spark):
    return spark.createDataFrame(BOARDS, schema.BOARD)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_flatten_and_regroup(boards):
    flat = nest.flatten(boards)
    assert flat.columns == [*nest.CONTEXT, "datum", "nazov", "url"]
    assert rows(flat, "kraj", "okres", "doc_kategoria", "nazov") == [("A", "a1", "", "v"), ("B", "b1", "k1", "z"), ("B", "b1", "k2", "x"), ("B", "b1", "k2", "y")]
    again = nest.flatten(nest.regroup(flat, carry_board=True))
    assert rows(again, *flat.columns) == rows(flat, *flat.columns)
    nested = {r["kraj"]: r for r in nest.regroup(flat).collect()}
    assert [k["kategoria"] for k in nested["B"]["okresy"][0]["dokumenty_zivotne_prostredie"]] == ["k1", "k2"]
    assert [d["nazov"] for d in nested["B"]["okresy"][0]["dokumenty_zivotne_prostredie"][1]["dokumenty"]] == ["y", "x"]


def test_document_fields_win(spark):
    df = spark.createDataFrame([("ctx", ("own", 1))], "kraj string, d struct<kraj:string,n:int>")
    assert rows(nest.spread(df, ("kraj",), "d"), "kraj", "n") == [("own", 1)]


def test_nested_diff(spark, boards):
    none = spark.createDataFrame([], schema.BOARD)
    assert delta.new_on_boards(boards, boards).count() == 0
    assert rows(nest.flatten(delta.new_on_boards(boards, none)), "nazov") == [("v",), ("x",), ("y",)]
    old = spark.createDataFrame([BOARDS[2] | {"okresy": [BOARDS[1]["okresy"][0]]}], schema.BOARD)
    assert rows(nest.flatten(delta.new_on_boards(boards, old)), "kraj", "nazov") == [("B", "y")]
    kept = delta.prune_boards(boards, lambda d: d["url"] == "u2").collect()
    assert len(kept) == 1 and [len(o["dokumenty_zivotne_prostredie"]) for o in kept[0]["okresy"]] == [1]


def test_flat_diff(spark):
    new = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "url string")
    old = spark.createDataFrame([("a",), (None,)], "url string")
    assert rows(delta.new_items(new, old), "url") == [("b",), ("b",)]
    assert rows(delta.new_rows(new, old), "url") == [("b",), ("b",)]
    assert rows(delta.new_rows(new, old, null_matches_null=False), "url") == [("None",)] or rows(delta.new_rows(new, old, null_matches_null=False), "url") == [("b",), ("b",), (None,)]
    plan = delta.new_items(new, old)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan


def test_merge_maps(spark):
    left = [(0, {"url": "a", "x": "1", "y": "2"}), (1, {"url": "a", "x": "3"}), (2, {"x": "no url"}), (3, {"url": "only left"})]
    right = [(0, {"url": "a", "x": "old"}), (1, {"url": "new", "z": "1"}), (2, {"url": "a", "x": None, "w": "5"}), (3, {"q": "dropped"}), (4, {"url": "new", "z": "2"})]
    frame = lambda v: spark.createDataFrame(v, "ord long, m map<string,string>")
    got = sorted(((r["part"], r["ord"], r["m"]) for r in delta.merge_maps(frame(left), frame(right)).collect()), key=lambda x: x[:2])
    assert got == [
        (0, 0, {"url": "a", "x": None, "y": "2", "w": "5"}),
        (0, 1, {"url": "a", "x": None, "w": "5"}),
        (0, 2, {"x": "no url"}),
        (0, 3, {"url": "only left"}),
        (1, 1, {"url": "new", "z": "2"}),
    ]
    once = delta.merge_maps(frame(left), frame([])).collect()
    assert sorted((r["ord"], r["m"]) for r in once) == left


def test_stages(spark):
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "doc_id string")
    done = spark.createDataFrame([("a", 50, 50, 50, 50), ("b", 50, 9, 50, 50)], "doc_id string, original int, text int, analysis_raw int, analysis int")
    got = {r[0]: tuple(r)[1:] for r in delta.stages_to_run(wanted, done).collect()}
    assert got == {"a": (False,) * 4, "b": (False, True, True, True), "c": (True,) * 4}


def test_enrich(spark):
    docs = spark.createDataFrame(
        [("K", "/k", "O", "https://h/?subor=1", "2025"), ("K", "/k", "O", "https://h/?subor=2", "2025"), ("K", "/k", "O", "https://h/?subor=3", "2025"), (None, "/k", "O", "https://h/?subor=1", "2025"), ("K", "/k", "O", None, "2025")],
        "kraj string, kraj_url string, okres string, url string, datum string",
    )
    log = '[{"date":"d","type":"info","text":"t"}]'
    store = spark.createDataFrame([("minv", "K", "O", "1", "analysis.json", '{"a": 1}'), ("minv", "K", "O", "1", "status.json", log), ("minv", "K", "O", "2", "analysis.json", "{} x"), ("minv", "K", "O", "2", "status.json", "broken"), ("minzp", "K", "O", "3", "analysis.json", "{}"), ("minv", "K", "O", None, "status.json", log)], schema.STORED)
    got = enrich.enrich(docs, store, "minv", F.lit("2025-01-02 03:04:05").cast("timestamp"))
    by = {(r["kraj"], r["url"]): r for r in got.collect()}
    one = by["K", "https://h/?subor=1"]
    assert one["analysis"] == '{"a": 1}' and [s["type"] for s in one["status"]] == ["info"] and one["kraj_url"] == "https://www.minv.sk/k"
    assert [s["text"].split(":")[0] for s in by["K", "https://h/?subor=2"]["status"]] == ["Failed to parse the status entries.", "Failed to parse the analysis"]
    assert [s["text"] for s in by["K", "https://h/?subor=3"]["status"]] == ["No analysis is stored for the document."]
    assert by[None, "https://h/?subor=1"]["kraj_url"] == "/k" and by["K", None]["status"][0]["text"] == "The document has no link."
    nested = spark.createDataFrame([("K", "/k", [("O", "/o")])], "kraj string, url string, okresy array<struct<nazov:string,url:string>>")
    assert rows(enrich.district_status(nested, store), "okres", "okres_url_tabule", "typ", "sprava") == [("O", "https://www.minv.sk/o#popis", "info", "t")]


def test_present(spark):
    df = spark.createDataFrame([("2025-01-02", "b"), ("4. máj 2025", "a"), (None, "c"), ("", "d"), ("2024-12-31", "e")], "datum string, url string")
    assert rows(present.recent(df, "2025-01-01"), "url") == [("a",), ("b",)]
    assert rows(present.recent(df, "2025-01-01", strict=True), "url") == [("b",)]
    assert [r["url"] for r in present.newest_first_by_date(df).collect()][:2] == ["b", "e"]
    assert [r["url"] for r in present.page(present.newest_first(df), 2, 2).collect()] == ["e", "d"]
    names = spark.createDataFrame([("žena",), ("Zebra",), ("zebra",), (None,), ("Ábel",)], "n string")
    assert [r["n"] for r in names.orderBy(present.collation_key(F.col("n")), "n").collect()] == [None, "Ábel", "Zebra", "zebra", "žena"]
    js = spark.createDataFrame([('[{"a":1}]',), ("bad",)], "t string")
    assert [len(r[0]) for r in js.select(present.embedded_rows(F.col("t"), "array<struct<a:int>>")).collect()] in ([1, 0], [1, 1])


def test_sample_and_prompt(spark, boards):
    df = spark.range(100).select(F.col("id").cast("string").alias("url"))
    one = rows(sample.sample(df, 10, seed=1), "url")
    assert len(set(one)) == 10 and one == rows(sample.sample(df.repartition(7), 10, seed=1), "url") and one != rows(sample.sample(df, 10, seed=2), "url")
    assert sample.sample(df, 1000).count() == 100
    with pytest.raises(ValueError, match="positive"):
        sample.sample(df, 0)
    assert nest.flatten(sample.sample_boards(boards, 2)).count() == 2
    docs = spark.createDataFrame([("K", "O", "1"), ("K", "O", "2")], "kraj string, okres string, doc_id string")
    store = spark.createDataFrame([("s", "K", "O", "1", "text.txt", "hello")], schema.STORED)
    found, missing = prompts.examples(docs, store)
    assert prompts.prompt(found, "<{examples}>").first()["prompt"] == "<Príklad dokumentu (z K/O/1/text.txt):\n\nhello>"
    assert missing.count() == 1 and prompts.prompt(found.limit(0), "<{examples}>").count() == 0


def test_status(spark, tmp_path):
    at = F.lit("2025-01-02 03:04:05").cast("timestamp")
    docs = spark.createDataFrame([("K", "O", "1")], "kraj string, okres string, doc_id string")
    for run in (1, 2):
        status.append(status.entries(docs, "error" if run == 1 else "info", F.lit("t"), at, run, "minv"), str(tmp_path / "s"))
    log = spark.read.parquet(str(tmp_path / "s"))
    assert log.count() == 2 and rows(status.latest_run(log), "type", "date") == [("info", "2025-01-02 03:04:05")]
    bad = spark.createDataFrame([(" ", "K", "O"), ("u", None, "O"), ("u", "K", ""), ("u", "K", "O")], "url string, kraj string, okres string")
    assert rows(status.faults(bad), "fault") == [("Invalid or empty URL",), ("Missing district",), ("Missing region",)]


def test_strip_is_linear(spark):
    from noticelake.functions import text

    long = "a" + " " * 1_000_000 + "b"
    df = spark.createDataFrame([(" \t\u00a0\u2003x y\u3000\x1c\n",), (long,), (" " * 1_000_000,), (None,)], "t string")
    assert [r[0] for r in df.select(text.strip(F.col("t"))).collect()] == ["x y", long, "", None]
    assert [r[0] for r in df.select(text.without_fences(F.concat(F.lit("```\n"), "t", F.lit("```")))).collect()] == ["x y", long, "", None]


def test_extraction_prompt(spark):
    asked = spark.createDataFrame([("the text",), (None,)], "t string").select(prompts.extraction(F.col("t"))).collect()
    template = asked[0][0].split("\n\n")[1]
    import json

    assert json.loads(template)["miesto_realizacie"]["katastralne_uzemia"][0]["parcely"] == [{"typ": None, "cisla": []}] and asked[0][0].endswith("the text") and asked[1][0] is None
    with pytest.raises(ValueError, match="exactly once"):
        prompts.prompt(spark.createDataFrame([("p", "c")], "path string, content string"), "no place")


def test_convert(spark):
    files = spark.createDataFrame([("a.pdf", b"thin"), ("b.pdf", b"x" * 40), ("c.docx", b"D"), ("d.txt", b"t\xff"), ("e.exe", b""), ("f.xls", b"boom")], "file_name string, content binary")

    def office(b, kind):
        if b == b"boom":
            raise RuntimeError("broken")
        return f"{kind}:{b.decode()}"

    conv = convert.Converters(pdf=lambda b: b.decode(), ocr=lambda b: "```markdown\nread\n```", office=office)
    got = {r["file_name"]: (r["text"], r["convert_error"]) for r in convert.file_texts(files, conv).collect()}
    assert got["a.pdf"] == ("read", None) and got["b.pdf"] == ("x" * 40, None) and got["c.docx"] == ("docx:D", None) and got["d.txt"] == ("t�", None)
    assert got["e.exe"][1].startswith("unsupported") and got["f.xls"][1] == "RuntimeError: broken"
    docs = spark.createDataFrame([(1, "ok"), (2, " "), (3, "bad"), (4, "fail")], "k int, t string")

    def model(t):
        if t == "fail":
            raise ValueError("x")
        return '```\n{"a": 1}\n```' if t == "ok" else "not json"

    out = {r["k"]: (r["analysis"], r["error"] is None) for r in convert.extracted(docs, model, F.col("t")).collect()}
    assert out == {1: ('{"a": 1}', True), 2: (None, False), 3: (None, False), 4: (None, False)}
    assert convert.extracted(docs, model, F.col("t"), skip=True).filter("error IS NOT NULL").count() == 0
    typed = spark.createDataFrame([('{"typ_zasahu": ["a"], "je_v_chranenom_uzemi": null, "miesto_realizacie": {"katastralne_uzemia": [{"nazov": "n", "parcely": [{"typ": "C", "cisla": ["1"]}]}]}}',)], "j string").select(convert.analysis_fields(F.col("j"), schema.ANALYSIS).alias("a")).first()["a"]
    assert typed["typ_zasahu"] == ["a"] and typed["je_v_chranenom_uzemi"] is None and typed["miesto_realizacie"]["katastralne_uzemia"][0]["parcely"][0]["cisla"] == ["1"]
