import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from noticelake import cli
from noticelake.operators import convert, prompts, schema
from noticelake.plans import pipelines
from noticelake.sources import fetch, files, html
from noticelake.streaming import new_documents

TABLE = """<div id="popis"><h2>Úvod</h2><h2> Úradná tabuľa </h2><p>x</p><table class="tabdoc">
<tr><td class="document-name">1. 1. 2025 | <a class="govuk-link" href="/early">early</a></td></tr>
<tr><td class="tddocup"></td></tr>
<tr><td class="document-name">30. 4. 2025 | <a class="govuk-link" href="/d1?subor=1">One</a></td></tr>
<tr><td class="tddocup">Lesy</td></tr>
<tr><td class="document-name"><a class="govuk-link" href="https://h/2">Two</a></td></tr>
<tr><td class="tddocup"></td></tr>
<tr><td class="document-name">soon | <a class="govuk-link">Three</a></td></tr>
<tr><td class="document-name">2.5.2025<a class="govuk-link" href="4">Four</a></td></tr></table></div>"""
PARAGRAPHS = """<div id="popis"><h2>Životné prostredie / Úradná tabuľa</h2><p>30. 4. 2025</p><p><a href="/a">A</a></p><hr><p>intro</p>
<p>1.5.2025</p><p>x <a href="/b">B</a></p><p><a>no link</a></p><h2>next</h2><p><a href="/c">C</a></p></div>"""


def test_boards(spark):
    pages = spark.createDataFrame([("t", TABLE), ("p", PARAGRAPHS), ("x", "<p>none</p>"), ("h", '<div id="popis"><h2>Iné</h2></div>'), ("n", None)], "page string, html string")
    docs, failed, linkless = html.board_documents(pages, ["page"], specific="životné prostredie")
    got = [tuple(r) for r in docs.orderBy("page", "place").select("page", "kategoria", "datum", "nazov", "url", "warning").collect()]
    assert got == [
        ("p", "", "2025-04-30", "A", "https://www.minv.sk/a", None),
        ("p", "", "2025-05-01", "B", "https://www.minv.sk/b", None),
        ("t", html.UNNAMED_CATEGORY, "2025-04-30", "One", "https://www.minv.sk/d1?subor=1", None),
        ("t", "Lesy", None, "Two", "https://h/2", "document without date"),
        ("t", "Lesy", "2025-05-02", "Four", "https://www.minv.sk/4", None),
    ]
    assert sorted((r["page"], r["nazov"], r["warning"]) for r in linkless.collect()) == [("p", "no link", "link without href"), ("t", "Three", "link without href")]
    assert {r["page"]: r["error"] for r in failed.collect()} == {"x": "section #popis not found", "h": "heading not found", "n": "section #popis not found"}


MENU = """<div class="sidemenu_list"><div class="small-nav -alt"><ul><li id="menu-item-12224"><a>O</a><ul class="sub-menu">
<li class="menu-item-has-children"><a href="/k1">Kraj 1</a><ul class="sub-menu"><li><a href="/o1">Okres 1</a></li><li>x</li></ul></li>
<li class="menu-item-has-children"><a href="/k2"></a></li></ul></li></ul></div></div>"""


def test_menu(spark):
    df = spark.createDataFrame([(MENU,), ("<ul></ul>",), (None,)], "html string")
    got = [r[0] for r in df.select(html.menu_tree("html")).collect()]
    assert [(x["kraj"], x["url"], [(o["nazov"], o["url"]) for o in x["okresy"]]) for x in got[0]] == [("Kraj 1", "/k1", [("Okres 1", "/o1")])]
    assert got[1:] == [[], []]


def news(n, last=False):
    link = "" if last else f'<a href="/list?page={n + 1}">next</a>'
    return f"""<div class="news"><div class="news_content"><a href="/doc/{n}.html">link</a><h4>Title {n}</h4><div class="news_text"><span class="news_date">{n}. 2. 2025</span> about <b>it</b></div></div>
<div class="news_content"><h4>No link</h4></div></div><div class="news_pages_bottom"><a href="/list?page=1">1</a>{link}</div>"""


PAGE = '<div class="breadcrumb"><a>D</a><a>K</a><a>Kraj Žilina</a><a>Okresný úrad Martin</a></div><main><h1>Head</h1><p>Some <b>bold</b> <a href="/x">link</a>.</p><ul><li>a</li><li>b</li></ul></main>'


def write_to(tmp_path, spark):
    def write(df, n):
        df.write.parquet(f"{tmp_path}/{n}")
        return spark.read.parquet(f"{tmp_path}/{n}")

    return write


def test_crawl_and_listing(spark, tmp_path):
    site = {f"https://h/list?page={n}": news(n, n == 3).encode() for n in (1, 2, 3)}
    fetcher = lambda url: (200, "text/html", site[url])
    first = spark.createDataFrame([("https://h/list?page=1",)], "url string")
    pages = fetch.crawl(first, fetcher, write_to(tmp_path, spark), "https://h")
    assert sorted(r["page"] for r in pages.collect()) == [1, 2, 3]
    rows = html.listing(pages.select("page", "html"), ["page"], "https://h").orderBy("page", "place").collect()
    assert [(r["nazov"], r["url"], r["datum"], r["popis"]) for r in rows[:2]] == [("Title 1", "https://h/doc/1.html", "2025-02-01", "about it"), ("No link", "", "", "")]
    gaps = spark.createDataFrame([(1,), (2,), (4,)], "page int")
    assert [r[0] for r in html.contiguous(gaps).collect()] == [1, 2]


def test_placed_pages(spark):
    rows = [("https://h/a.html", PAGE), ("https://h/b.html", PAGE.replace("Kraj Žilina", "Ministerstvo")), ("https://h/c.html", PAGE.replace("Okresný úrad ", "")), ("https://h/", PAGE), ("https://h/e.html", "<main></main>"), ("https://h/f.html", PAGE.replace("main", "div"))]
    got = {r["url"][-6:]: (r["kraj"], r["okres"], r["doc_id"], r["error"]) for r in html.placed(spark.createDataFrame(rows, "url string, html string")).collect()}
    assert got["a.html"[-6:]] == ("Žilinský kraj", "Martin", "a", None) and got["b.html"] == ("Ministerstvo", "Ministerstvo", "b", None)
    assert [got[k][3] is None for k in ("c.html", "s://h/", "e.html", "f.html")] == [False] * 4
    one = html.placed(spark.createDataFrame(rows[:1], "url string, html string")).first()["text"]
    assert one == "# Head\n\nSome **bold** [link](/x).\n\n* a\n* b"


def test_fetch_fallback_and_retries(spark, tmp_path):
    def fetcher(url):
        if url.endswith("404"):
            return 404, "text/plain", b""
        if "slow" in url:
            raise TimeoutError("late")
        return 200, "application/pdf; q", b"body"

    rows = spark.createDataFrame([("h/1", None), ("h/404", "h/2"), ("h/404", None), ("slow", None), (None, None)], "url string, fallback_url string")
    got = {(r["url"], r["fallback_url"]): (r["http_status"], r["error"], r["used_fallback"]) for r in fetch.fetch_with_fallback(rows, fetcher).collect()}
    assert got["h/404", "h/2"] == (200, None, True) and got["h/404", None][:2] == (404, "HTTP 404") and got["slow", None][1] == "TimeoutError: late" and got["h/1", None] == (200, None, False)
    assert fetch.stored_name(fetch.fetch(rows.limit(1), fetcher)).first()["file_name"] == "orig.pdf"
    waits = []
    done = fetch.fetch_with_retries(rows, fetcher, write_to(tmp_path, spark), sleep=waits.append)
    assert done.count() == 5 and waits == list(fetch.RETRY_DELAYS) and done.filter("error IS NULL").count() == 1


def test_files(spark, tmp_path):
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "ok.json").write_text(json.dumps([{"nazov": "č", "url": "u"}]))
    (tmp_path / "obj.json").write_text('{"a": 1}')
    (tmp_path / "bad.json").write_text('[{"a": 1}, oops')
    (tmp_path / "none.json").write_text("")
    assert files.read_json_array(spark, str(tmp_path / "empty.json"), schema.LISTING).count() == 0
    assert files.read_json_array(spark, str(tmp_path / "ok.json"), schema.LISTING).first()["nazov"] == "č"
    assert [files.input_faults(spark, str(tmp_path / n)) and files.input_faults(spark, str(tmp_path / n))[0][0] for n in ("ok.json", "obj.json", "no.json", "bad.json", "none.json")] == [[], "error", "critical", "critical", "critical"]
    assert files.read_json_array(spark, str(tmp_path / "obj.json"), schema.LISTING, lenient=True).count() == 0
    for name in ("obj.json", "bad.json", "no.json"):
        with pytest.raises(ValueError, match="input"):
            files.read_json_array(spark, str(tmp_path / name), schema.LISTING)
    assert files.read_json_text(spark, '[{"url": "u"}]', schema.LISTING).first()["url"] == "u"
    with pytest.raises(ValueError, match="no input"):
        files.read_json_text(spark, " ", schema.LISTING)
    d = tmp_path / "data/minv/docs/Kraj A/O/1"
    d.mkdir(parents=True)
    (d / "text.txt").write_text("a\nb")
    (d.parent / "status.json").write_text("[]")
    assert sorted((r["source"], r["kraj"], r["okres"], r["doc_id"], r["file_name"], r["content"]) for r in files.read_store(spark, str(tmp_path / "data")).collect() if r["doc_id"]) == [("minv", "Kraj A", "O", "1", "text.txt", "a\nb")]
    assert files.read_store(spark, str(tmp_path / "data")).filter("doc_id IS NULL AND file_name = 'status.json'").count() == 1
    files.write_json_array(spark.createDataFrame([("b", "č"), ("a", None)], "url string, n string"), str(tmp_path / "out"), ["url"])
    text = next((tmp_path / "out").glob("part-*")).read_text()
    assert json.loads(text) == [{"url": "a", "n": None}, {"url": "b", "n": "č"}] and "č" in text
    frame = spark.createDataFrame([("u",)], "url string")
    assert [x.count() for x in files.read_snapshots(spark, str(tmp_path / "none"), "url string")] == [0, 0]
    for v in ("2025-01-01", "2025-01-02"):
        files.write_snapshot(frame.union(frame) if v[-1] == "2" else frame, str(tmp_path / "snap"), v)
    assert [x.count() for x in files.read_snapshots(spark, str(tmp_path / "snap"), "url string")] == [2, 1]


def archive(**members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, data in members.items():
            z.writestr(name.replace("__", "/"), data)
    return buffer.getvalue()


def test_archives(spark):
    rows = [("1", "orig.zip", archive(a__x="nope", **{"b.txt": "second", "a.txt": "first"})), ("2", "orig.zip", b"broken"), ("3", "orig.rar", b""), ("4", "orig.txt", b"plain")]
    df = spark.createDataFrame(rows, "url string, file_name string, body binary")
    got = {r["url"]: (r["text"], r["errors"]) for r in convert.document_texts(df, convert.Converters(), ["url"]).collect()}
    assert got["1"] == ("first\n\n--- Nový Súbor v Archíve ---\n\nsecond", ["unsupported file type: a/x"])
    assert got["2"][0] is None and "BadZipFile" in got["2"][1][0] and "RAR" in got["3"][1][0] and got["4"] == ("plain", None)


def counted(f, log):
    """``f`` with a line in a file for every call, as calls happen in other processes."""

    def call(x):
        with open(log, "a") as out:
            out.write(f"{str(x)[:60]}\n".replace("\n", " ") + "\n")
        return f(x)

    return call


def calls(log):
    found = sorted(x.strip() for x in open(log).read().splitlines()) if log.exists() else []
    log.unlink(missing_ok=True)
    return found


def test_each_document_is_processed_once(spark, tmp_path):
    site = {"https://h/?subor=1": ("text/plain", b"text one, long enough"), "https://h/?subor=2": ("application/zip", archive(**{"a.txt": "in a zip file"})), "https://h/?subor=5": ("application/pdf", b"pdf of some length"), "https://h/?subor=6": ("application/zip", b"broken archive")}

    def get(url):
        if url not in site:
            raise OSError("gone")
        return 200, *site[url]

    fetched, converted, extracted = (tmp_path / n for n in ("f", "c", "e"))
    conv = convert.Converters(pdf=counted(lambda b: "the text of a page, longer than the limit", converted))
    tools = (counted(get, fetched), conv, counted(lambda t: json.dumps({"t": t}), extracted))
    docs = spark.createDataFrame([("K", "O", "https://h/?subor=1"), ("K", "P", "https://h/?subor=1"), ("K", "O", "https://h/?subor=2"), ("K", "O", "https://h/3"), ("K", "O", " "), ("K", "O", "https://h/?subor=5"), ("K", "O", "https://h/?subor=6")], "kraj string, okres string, url string")
    got = pipelines.process_documents(docs, *tools, files.saver(str(tmp_path / "w")))
    got.write.parquet(str(tmp_path / "r1"))
    rows = [(r["okres"], str(r["doc_id"])[:8], r["text"], r["analysis"], r["error"]) for r in spark.read.parquet(str(tmp_path / "r1")).collect()]
    by = {(o, d): x for o, d, *x in rows}
    assert len(rows) == 7 and by["O", "1"] == by["P", "1"] == ["text one, long enough", '{"t": "text one, long enough"}', None]
    assert by["O", "2"][0] == "in a zip file" and by["O", "None"] == [None, None, "Invalid or empty URL"] and by["O", "urlhash_"][2] == "OSError: gone" and "BadZipFile" in by["O", "6"][2]
    assert calls(fetched) == sorted([*site, "https://h/3"]) and len(calls(converted)) == 1 and len(calls(extracted)) == 3

    # The second run asks again only for what failed; a text that is missing is made again, and its analysis.
    done = spark.read.parquet(str(tmp_path / "r1")).filter("body IS NOT NULL").withColumn("text", F.when(F.col("doc_id") != "1", F.col("text")))
    pipelines.process_documents(docs, *tools, files.saver(str(tmp_path / "w2")), done).write.parquet(str(tmp_path / "r2"))
    assert calls(fetched) == ["https://h/3"] and len(calls(extracted)) == 1
    again = {(r["okres"], str(r["doc_id"])[:8]): [r["text"], r["analysis"], r["error"]] for r in spark.read.parquet(str(tmp_path / "r2")).collect()}
    assert again == by | {("O", "6"): again["O", "6"]} and again["O", "6"][2]
    store = files.stored_files(spark.read.parquet(str(tmp_path / "r2")), "minv")
    files.append_store(store, str(tmp_path / "store"), 1)
    files.append_store(store.withColumn("content", F.lit("new")).filter("file_name = 'text.txt' AND doc_id = '2'"), str(tmp_path / "store"), 2)
    kept = {(r["okres"], r["doc_id"], r["file_name"]): r["content"] for r in files.latest_stored(spark, str(tmp_path / "store")).collect()}
    assert kept["O", "2", "text.txt"] == "new" and kept["P", "1", "analysis.json"] == by["P", "1"][1] and len(kept) == 12
    log = pipelines.status_of(spark.read.parquet(str(tmp_path / "r2")), F.lit("2025-01-02 03:04:05").cast("timestamp"), 1, "minv")
    assert sorted((str(r["doc_id"])[:8], r["type"]) for r in log.collect()) == [("6", "error"), ("None", "error"), ("urlhash_", "error")]
    skipped = pipelines.process_documents(docs, *tools, files.saver(str(tmp_path / "w3")), skip_analysis=True)
    said = pipelines.status_of(skipped, F.lit("2025-01-02 03:04:05").cast("timestamp"), 1, "minv", True).collect()
    assert sum(r["text"] == "analysis skipped" for r in said) == 4 and not calls(extracted)


def test_boards_flow(spark, tmp_path):
    fine = TABLE.replace(" Úradná tabuľa ", "Životné prostredie / Úradná tabuľa")
    fails = tmp_path / "fails"

    def get(url):
        if "/late" in url and not fails.exists():
            fails.write_text("x")
            raise TimeoutError("late")
        if "/general" in url:
            return (404, "text/html", b"") if "odbor" in url else (200, "text/html", TABLE.encode())
        if "/odd" in url:
            return 200, "text/html", TABLE.encode()
        return 200, "text/html", fine.encode()

    directory = spark.createDataFrame([("B", "/b", [("own", "/own"), ("general", "/general"), ("late", "/late")]), ("A", "/a", [("odd", "/odd"), ("none", None)]), ("C", "/c", [])], schema.DIRECTORY)
    waits = []
    found = pipelines.scrape_boards(directory, get, files.saver(str(tmp_path / "w")), delays=(1, 2), sleep=waits.append)
    assert [c.split(":")[0] for c in found.columns] == ["kraj", "url", "okresy"] and waits == [1, 2]
    by = {(r["kraj"], o["nazov"]): o for r in found.collect() for o in r["okresy"]}
    assert list(by) and {k: (o["error"], o["url_tabule"]) for k, o in by.items()} == {
        ("B", "own"): (None, "https://www.minv.sk/own&odbor=10&sekcia=uradna-tabula"), ("B", "general"): (None, "https://www.minv.sk/general&sekcia=uradna-tabula"),
        ("B", "late"): (None, "https://www.minv.sk/late&odbor=10&sekcia=uradna-tabula"), ("A", "odd"): ("heading not found", None), ("A", "none"): ("district without URL", None),
    }
    assert [(k["kategoria"], [d["nazov"] for d in k["dokumenty"]]) for k in by["B", "late"]["dokumenty_zivotne_prostredie"]] == [(html.UNNAMED_CATEGORY, ["One"]), ("Lesy", ["Two", "Four"])]
    assert by["A", "odd"]["dokumenty_zivotne_prostredie"] == [] and [r["okresy"] for r in found.collect() if r["kraj"] == "C"] == [[]]


def test_listing_flow(spark, tmp_path):
    pages = {f"https://h/list?page={n}": news(n, n == 12).encode() for n in range(1, 13)}
    get = lambda url: (200, "text/html", pages[url]) if "list" in url else (200, "text/html", PAGE.encode()) if url.endswith("doc.html") else (404, "text/html", b"")
    items = pipelines.crawl_listing(spark.createDataFrame([("https://h/list?page=1",)], "url string"), get, files.saver(str(tmp_path / "c")), "https://h")
    assert [r["nazov"] for r in items.collect()][::2] == [f"Title {n}" for n in range(1, 13)]
    items = spark.createDataFrame([("n", "https://h/doc.html", "2025-01-01", "about"), ("n", "https://h/gone", "", ""), ("n", None, "", "")], "nazov string, url string, datum string, popis string")
    asked = tmp_path / "asked"
    done = pipelines.process_listing(items, get, counted(lambda t: json.dumps({"n": len(t)}), asked), files.saver(str(tmp_path / "w")), asked=prompts.extraction)
    rows = {r["url"]: r for r in done.collect()}
    assert rows["https://h/doc.html"]["doc_id"] == "doc" and rows["https://h/doc.html"]["okres"] == "Martin" and rows["https://h/doc.html"]["error"] is None
    assert rows["https://h/gone"]["error"] == "HTTP 404" and rows[None]["error"] == "no URL" and calls(asked) == [prompts.INSTRUCTION[:60].strip()]


def test_stream(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "table")
    source.mkdir()
    for k, urls in enumerate((["a", "b", "b"], ["b", "c", None])):
        (source / f"{k}.json").write_text(json.dumps([{"url": u, "nazov": str(k)} for u in urls]))
        q = new_documents.append_new(new_documents.read(spark, str(source), schema.LISTING), table, str(tmp_path / "check"))
        q.awaitTermination()
    assert sorted((r["url"], r["nazov"]) for r in spark.read.parquet(table).collect()) == [("a", "0"), ("b", "0"), ("c", "1")]
    q = new_documents.first_seen(new_documents.read(spark, str(source), schema.LISTING)).writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r["url"] for r in spark.table("seen").collect()) == ["a", "b", "c"]


def test_commands(spark, tmp_path, capsys):
    for name, urls in (("old", ["a"]), ("new", ["a", "b"])):
        (tmp_path / f"{name}.json").write_text(json.dumps([{"url": u, "nazov": "n", "datum": "", "popis": ""} for u in urls]))
    assert cli.main(["diff", "--old", str(tmp_path / "old.json"), "--new", str(tmp_path / "new.json")]) == 0
    assert [x["url"] for x in json.loads(capsys.readouterr().out)] == ["b"]
    (tmp_path / "menu.html").write_text(MENU)
    cli.main(["directory", "--pages", str(tmp_path / "menu.html"), "--output", str(tmp_path / "o")])
    assert json.loads(next((tmp_path / "o").glob("part-*")).read_text())[0]["kraj"] == "Kraj 1"
    with pytest.raises(SystemExit):
        cli.main(["merge", "--in", "one", "--out", "x"])
    assert cli.main(["merge", "--in", str(tmp_path / "old.json"), "--in", str(tmp_path / "new.json"), "--out", str(tmp_path / "m")]) == 0
    assert [r["url"] for r in json.loads(next((tmp_path / "m").glob("part-*")).read_text())] == ["a", "b"]


def test_commands_with_tools(spark, tmp_path, capsys, monkeypatch):
    (tmp_path / "own_tools.py").write_text(
        "from noticelake.operators.convert import Converters\n"
        "fetcher = lambda url: (200, 'text/plain', b'body')\n"
        "converters = Converters(pdf=lambda b: 'text of the page, longer than the limit')\n"
        "extractor = lambda t: '{}'\n"
    )
    monkeypatch.syspath_prepend(str(tmp_path))
    monkeypatch.setitem(spark.sparkContext.environment, "PYTHONPATH", str(tmp_path))
    doc = {"datum": "1. 2. 2025", "nazov": "n", "url": "https://h/?subor=7"}
    board = [{"kraj": "K", "url": "/k", "okresy": [{"nazov": "O", "url": "/o", "dokumenty_zivotne_prostredie": [{"kategoria": "c", "dokumenty": [doc]}]}]}]
    (tmp_path / "boards.json").write_text(json.dumps(board))
    (tmp_path / "bad.json").write_text("{}")
    assert cli.main(["process-boards", "--input", str(tmp_path / "boards.json"), "--tools", "own_tools", "--work", str(tmp_path / "w"), "--store", str(tmp_path / "s"), "--status", str(tmp_path / "l")]) == 0
    (row,) = json.loads(capsys.readouterr().out)
    assert (row["doc_id"], row["text"], row["analysis"]) == ("7", "body", "{}")
    assert cli.main(["process-listing", "--input", str(tmp_path / "bad.json"), "--tools", "own_tools", "--work", str(tmp_path / "w2"), "--status", str(tmp_path / "l")]) == 1
    assert [r["type"] for r in spark.read.parquet(str(tmp_path / "l")).collect()] == ["error"] and files.latest_stored(spark, str(tmp_path / "s")).count() == 3
    (tmp_path / "x.pdf").write_bytes(b"pdf")
    assert cli.main(["pdf-text", "--input", str(tmp_path / "x.pdf"), "--tools", "own_tools"]) == 0
    monkeypatch.setattr("sys.stdin", io.StringIO(json.dumps(board)))
    assert cli.main(["dates"]) == 0
    assert "2025-02-01" in capsys.readouterr().out


def test_markdown_leaves_in_small_batches(spark, monkeypatch):
    """A batch of many pages: the results leave bit by bit, in order, beside the columns kept; nulls stay."""
    import pyarrow as pa

    monkeypatch.setattr(html, "_HELD", 50)
    pages = [None if k % 7 == 0 else "<p>none</p>" if k % 5 == 0 else f"<main><h1>N {k}</h1></main>" for k in range(100)]
    want = [(k, f"# N {k}" if k % 7 and k % 5 else None) for k in range(100)]
    batch = pa.RecordBatch.from_pydict({"k": list(range(100)), "html": pages})
    got = list(html._markdown_batches(iter([batch, batch.slice(0, 0)]), ["k"], "html", pa.schema({"k": pa.int64(), "text": pa.string()})))
    assert max(b.num_rows for b in got) < 20 and [tuple(r.values()) for b in got for r in b.to_pylist()] == want
    rows = html.with_markdown(spark.createDataFrame(list(enumerate(pages)), "k long, html string"), ["k"])
    assert sorted(map(tuple, rows.collect())) == want
