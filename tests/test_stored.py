"""Sites, keyed state, histories, records, sketches, indexes and archives beyond what the queries show."""

import io
import json
import zipfile
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from noticelake.operators import delta, history, present, rankindex, sketches, status, textindex
from noticelake.sources import archives, files, records, site
from noticelake.streaming import new_documents, state


# Sites ---------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("last", [0, 1, 2, 3, 7, 8, 100, 1023])
def test_last_page(last):
    asked = []
    found = site.last_page(lambda n: asked.append(n) or n <= last)
    assert found == last and len(asked) <= 2 * last.bit_length() + 2
    assert site.last_page(lambda n: n <= last, known=last) == last


def counting(folder, pages, fail=None):
    """A fetcher that leaves a file for every request."""

    def get(url):
        import os
        import uuid

        n = int(url.rsplit("=", 1)[1])
        (folder / f"{n}-{uuid.uuid4().hex}").write_text("")
        if n == fail and len([x for x in os.listdir(folder) if x.startswith(f"{n}-")]) == 1:
            raise SystemError("lost")
        return (200, "text/html", f"page {n}".encode()) if (folder.parent / "pages").exists() and n <= int((folder.parent / "pages").read_text()) else (404, "", b"")

    (folder.parent / "pages").write_text(str(pages))
    return get


def test_site_partitions_read_their_own_pages(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()
    name = site.register(spark, counting(asked, 23, fail=17), "counted")
    rows = spark.read.format(name).option("address", "x?page={page}").option("run", "5").option("last", "23").load()
    assert rows.rdd.getNumPartitions() == 5 and list(asked.iterdir()) == []
    got = {r["page"]: (r["http_status"], r["error"]) for r in rows.collect()}
    assert sorted(got) == list(range(1, 24)) and got[17] == (None, "SystemError: lost") and got[16] == (200, None)
    assert sorted(int(p.name.split("-")[0]) for p in asked.iterdir()) == list(range(1, 24))


def test_a_partition_that_is_read_again_asks_for_its_pages_only(tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()
    reader = site._Reader(counting(asked, 23), {"address": "x?page={page}", "run": "5", "last": "23"})
    runs = reader.partitions()
    first = [b.to_pylist() for b in reader.read(runs[2])]
    assert [b.to_pylist() for b in reader.read(runs[2])] == first and [r["page"] for r in first[0]] == [11, 12, 13, 14, 15]
    assert sorted({int(p.name.split("-")[0]) for p in asked.iterdir()}) == [11, 12, 13, 14, 15]


def test_site_stream_goes_on_after_its_offset(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()
    name = site.register(spark, counting(asked, 4), "growing")

    def run():
        rows = spark.readStream.format(name).option("address", "x?page={page}").option("run", "3").load()
        rows.writeStream.format("parquet").option("path", str(tmp_path / "t")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
        return sorted(r["page"] for r in spark.read.parquet(str(tmp_path / "t")).collect())

    assert run() == [1, 2, 3, 4]
    (tmp_path / "pages").write_text("9")
    assert run() == list(range(1, 10))


# State ---------------------------------------------------------------------------------------------------------------


def drive(spark, tmp_path, query, schema, batches, mode="append"):
    """Each batch as a file that arrives; the rows of every batch's output."""
    (tmp_path / "in").mkdir(exist_ok=True)
    out = []
    for k, rows in enumerate(batches):
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(json.dumps(r) for r in rows))
        stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        state.to_table(query(stream), str(tmp_path / "t"), str(tmp_path / "c"), mode).awaitTermination()
        done = spark.read.parquet(str(tmp_path / "t"))
        out.append(done)
    return out[-1]


def test_first_seen_forgets_by_event_time(spark, tmp_path):
    schema = "url string, ts timestamp, n int"
    row = lambda url, day, n: {"url": url, "ts": f"2025-{day}T00:00:00Z", "n": n}
    batches = [[row("a", "01-02", 2), row("a", "01-01", 1), row("b", "01-01", 3), row(None, "01-01", 4)], [row("a", "01-05", 5), row("c", "01-06", 6)], [row("d", "03-01", 7)], [row("a", "03-02", 8), row("b", "03-02", 9), row("d", "03-02", 10)]]
    done = drive(spark, tmp_path, lambda s: state.first_seen(s, "url", "ts", timedelta(days=20), "1 day"), schema, batches)
    assert sorted((r["url"], r["n"]) for r in done.collect()) == [("a", 1), ("a", 8), ("b", 3), ("b", 9), ("c", 6), ("d", 7)]


def test_latest_runs_over_batches(spark, tmp_path):
    batches = [[{"k": "a", "run_id": 1}, {"k": "a", "run_id": 1}, {"k": "b", "run_id": 3}], [{"k": "a", "run_id": 2}, {"k": "b", "run_id": 2}, {"k": "b", "run_id": 3}], [{"k": "a", "run_id": 2}]]
    done = drive(spark, tmp_path, lambda s: state.latest_runs(s, ["k"]), "k string, run_id long", batches, "update")
    assert sorted((r["k"], r["run_id"], r["n"]) for r in state.latest_of(done, ["k"]).collect()) == [("a", 2, 2), ("b", 3, 2)]


def test_new_documents_reads_no_earlier_rows(spark, tmp_path):
    """What was appended is not needed for later batches."""
    schema, source = "url string, nazov string", tmp_path / "in"
    source.mkdir()
    for k, urls in enumerate((["a", "b", "b"], ["b", "c", None])):
        (source / f"{k}.json").write_text(json.dumps([{"url": u, "nazov": str(k)} for u in urls]))
        new_documents.append_new(new_documents.read(spark, str(source), schema), str(tmp_path / f"t{k}"), str(tmp_path / "c")).awaitTermination()
    assert [sorted(r["url"] for r in spark.read.parquet(str(tmp_path / f"t{k}")).collect()) for k in (0, 1)] == [["a", "b"], ["c"]]


# Histories -----------------------------------------------------------------------------------------------------------


def test_history_grows_by_snapshots(spark):
    listed = {1: [("a", "x"), ("b", None), (None, "n")], 2: [("a", "x"), ("a", "x"), ("b", None)], 3: [("a", "y"), (None, "n")], 4: [("a", "x"), ("b", None), (None, "n")]}
    rows = spark.createDataFrame([(v, *r) for v, own in listed.items() for r in own], "version int, url string, t string")
    want = {("a", "x", 1, 2), ("a", "x", 4, 4), ("a", "y", 3, 3), ("b", None, 1, 2), ("b", None, 4, 4), (None, "n", 1, 1), (None, "n", 3, 4)}
    assert {tuple(r) for r in history.intervals(rows).select("url", "t", "since", "until").collect()} == want
    grown = history.intervals(rows.filter("version = 1"))
    for v in (2, 3, 4):
        grown = history.extended(grown, rows.filter(f"version = {v}").drop("version"), v)
    assert {tuple(r) for r in grown.select("url", "t", "since", "until").collect()} == want and grown.count() == len(want)
    for v, own in listed.items():
        assert {tuple(r) for r in history.as_of(grown, v).select("url", "t").collect()} == set(own)
    asked = spark.createDataFrame([("a", v) for v in (0, 1, 2, 3, 4, 9)] + [("z", 1), ("b", 3)], "url string, at int")
    told = {(r["url"], r["at"]): r["t"] for r in history.as_of_each(grown.filter("url IS NOT NULL"), asked, "at").collect()}
    assert told == {("a", 0): None, ("a", 1): "x", ("a", 2): "x", ("a", 3): "y", ("a", 4): "x", ("a", 9): None, ("z", 1): None, ("b", 3): None}


# Records -------------------------------------------------------------------------------------------------------------


def test_entries_of_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"url": "u", "n": 1}, 5, null, "x", {"url": {"no": 1}, "n": "many"}, {"n": 2}]')
    (tmp_path / "b.json").write_text('{"url": "u"}')
    (tmp_path / "c.json").write_text("[{]")
    (tmp_path / "d.json").write_text("[]")
    found = records.read_json_entries(spark, str(tmp_path), "url string, n int")
    assert {tuple(r) for r in found.rows.collect()} == {("u", 1), (None, 2)}
    faults = sorted((r["name"], r["place"] if r["place"] is not None else -1, r["fault"]) for r in found.refused.collect())
    assert faults == [("a.json", 1, "no object"), ("a.json", 2, "no object"), ("a.json", 3, "no object"), ("a.json", 4, "field of another type"), ("b.json", -1, "no list"), ("c.json", -1, "no JSON")]
    assert ("warning", "skipped entry 1 (no object)") in {tuple(r) for r in records.warnings(found.refused).collect()}


def test_drift_and_common_schema(spark):
    rows = spark.createDataFrame([("a", '{"k": 1, "x": "s"}'), ("a", '{"k": 2.5}'), ("b", '{"k": null}'), ("b", "no"), ("b", "[1]")], "g string, t string")
    assert sorted(map(tuple, records.drift(rows, "t", "g").collect())) == [("a", "k", "BIGINT", 1), ("a", "k", "DECIMAL(2,1)", 1), ("a", "x", "STRING", 1), ("b", "k", "VOID", 1)]
    assert rows.filter("t LIKE '{%'").agg(records.common_schema(F.col("t"))).first()[0].startswith("OBJECT<k: ")


def test_board_entries(spark):
    """What is damaged on one level costs nothing beside it."""
    doc = {"datum": "d", "nazov": "n", "url": "u"}
    whole = {"kraj": "K", "url": "/k", "okresy": [{"nazov": "O", "url": "/o", "url_tabule": "/t", "dokumenty_zivotne_prostredie": [{"kategoria": "", "dokumenty": [doc, 5, {"nazov": "no url"}, None, []]}, "c", {"dokumenty": [doc]}, {"kategoria": "x", "dokumenty": {}}]}, None, {"url": "/p"}, {"nazov": "P"}]}
    texts = [("a", json.dumps([whole, 1, {"okresy": [1]}, {"kraj": "L", "okresy": "none"}])), ("b", "{}"), ("c", "["), ("d", "[]"), ("e", json.dumps([whole]))]
    found = records.flat_boards(spark.createDataFrame(texts, "name string, text string"))
    rows = [(r["kraj"], r["kraj_url"], r["okres"], r["okres_url_tabule"], r["doc_kategoria"], r["nazov"], r["url"]) for r in found.rows.collect()]
    assert sorted(rows, key=str) == sorted([("K", "/k", "O", "/t", "", "n", "u"), ("K", "/k", "O", "/t", "", "no url", None)] * 2, key=str)
    told = sorted((r["place"], r["fault"]) for r in found.refused.filter("name = 'a'").collect())
    assert told == [
        ("0/0/0/1", "document is no object"), ("0/0/0/3", "document is no object"), ("0/0/0/4", "document is no object"), ("0/0/1", "category is no object"), ("0/0/2", "category without a name"), ("0/0/3", "documents are no list"),
        ("0/1", "district is no object"), ("0/2", "district without a name"), ("1", "region is no object"), ("2", "region without a name"), ("3", "districts are no list"),
    ]
    assert sorted((r["name"], r["fault"]) for r in found.refused.filter("name IN ('b', 'c', 'd')").collect()) == [("b", "regions are no list"), ("c", "no JSON")]


# Sketches, indexes ---------------------------------------------------------------------------------------------------


def test_sketches_add_up(spark):
    rows = spark.range(60_000).select((F.col("id") % 20_000).alias("user"), F.when(F.col("id") < 30_000, "a").otherwise("b").alias("run"))
    stored = sketches.sketched(rows, F.col("user"), "run")
    both = sketches.added(stored.withColumn("all", F.lit(1)), "all").select(sketches.different().alias("d"), "n").first()
    assert abs(both["d"] - 20_000) < 20_000 * sketches.error_bound() and both["n"] == 60_000
    thetas = {r["run"]: r["theta"] for r in stored.collect()}
    pair = spark.createDataFrame([(bytes(thetas["a"]), bytes(thetas["b"]))], "a binary, b binary")
    assert abs(pair.select(sketches.shared("a", "b")).first()[0] - 20_000) < 40_000 * sketches.error_bound()


def test_text_index(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = docs.unionByName(spark.createDataFrame([(10**9, None), (10**9 + 1, "ab"), (10**9 + 2, "Straße İx")], "doc_id long, text string"))
    postings = textindex.index(rows, "doc_id", "text").cache()
    counts = textindex.sizes(postings)
    word = docs.filter("length(text) > 300").orderBy("doc_id").first()["text"][100:112]
    for part in (word, word.upper(), "zzzq", "ab", "", "Straße", "the "):
        want = {r["doc_id"] for r in rows.collect() if r["text"] is not None and part.lower() in r["text"].lower()} if part else {r["doc_id"] for r in rows.collect()}
        assert {r["doc_id"] for r in textindex.containing(rows, postings, counts, "doc_id", "text", part).collect()} == want, part
    assert textindex.candidates(postings, counts, word).count() < docs.count() / 4 and textindex.candidates(postings, counts, "zz") is None


def test_rank_index(spark, tmp_path):
    rows = spark.range(10_000).select((F.col("id") * 7919 % 10_007).alias("v"))
    found = rankindex.write(rows, [F.desc("v")], str(tmp_path / "r"), 900)
    assert found.count() >= 10 and found.agg(F.sum("rows")).first()[0] == 10_000
    order = sorted((r["v"] for r in rows.collect()), reverse=True)
    for number, size in ((1, 100), (50, 100), (100, 100), (7, 1300), (101, 100), (1, 10_000)):
        page = rankindex.page(spark, str(tmp_path / "r"), number, size)
        assert [(r["rank"], r["v"]) for r in page.collect()] == [(k + 1, order[k]) for k in range((number - 1) * size, min(number * size, 10_000))]
    plan = rankindex.page(spark, str(tmp_path / "r"), 50)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(share" in plan or "share#" in plan.split("PartitionFilters")[1][:80]


def test_rank_index_of_many_files(spark, tmp_path, monkeypatch):
    """The shares, of which each sends a sample to the driver, are bounded; the files stay short, and a page reads those it lies in."""
    monkeypatch.setattr(rankindex, "SHARES", 3, raising=False)
    rows = spark.range(10_000).select((F.col("id") * 7919 % 10_007).alias("v"))
    found = rankindex.write(rows, [F.desc("v")], str(tmp_path / "r"), 100)
    assert found.select("share").distinct().count() <= 3 and found.count() >= 100 and found.agg(F.max("rows")).first()[0] <= 100
    order = sorted((r["v"] for r in rows.collect()), reverse=True)
    for number, size in ((1, 100), (50, 70), (100, 100), (101, 100)):
        page = rankindex.page(spark, str(tmp_path / "r"), number, size)
        assert [(r["rank"], r["v"]) for r in page.collect()] == [(k + 1, order[k]) for k in range((number - 1) * size, min(number * size, 10_000))]
        assert len(page.inputFiles()) <= 3


# Archives ------------------------------------------------------------------------------------------------------------


def zipped(*members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members:
            z.writestr(name, data)
    return out.getvalue()


def test_archives_inside_archives(spark):
    deep = zipped(("x.txt", b"deep"))
    for _ in range(5):
        deep = zipped(("in.zip", deep))
    good = zipped(("d/", b""), ("d/long.txt", "é".encode() * 1000), ("empty.txt", b""), ("in.zip", zipped(("a.txt", b"inner"))), ("bad.zip", b"no archive"))
    broken = bytearray(zipped(("t.txt", b"some text " * 50)))
    broken[60] ^= 0xFF
    df = spark.createDataFrame([(1, good, "m"), (2, b"none", "m"), (3, None, "m"), (4, bytes(broken), "m"), (5, deep, "m")], "k int, body binary, mark string")
    parts = archives.members(df, part=300)
    assert parts.columns == ["k", "mark", "member", "part", "content", "error"] and parts.filter("length(content) > 300").isEmpty()
    assert parts.filter("member = 'd/long.txt'").count() == 7
    whole = {(r["k"], r["member"]): (r["text"], (r["error"] or "").split(":")[0]) for r in archives.whole_texts(parts, ["k"]).collect()}
    assert whole[1, "d/long.txt"] == ("é" * 1000, "") and whole[1, "empty.txt"] == ("", "") and whole[1, "in.zip/a.txt"] == ("inner", "")
    assert whole[1, "bad.zip"] == (None, "BadZipFile") and whole[2, None] == (None, "BadZipFile") and whole[3, None] == (None, "no archive")
    assert whole[4, "t.txt"][0] is None and whole[4, "t.txt"][1] and whole[5, "in.zip/in.zip/in.zip/in.zip"] == (None, "archives too deep inside one another")


# One file, cells, status, upserts ------------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_one_json_file(spark, tmp_path, n):
    rows = spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit('č "q"\n'), F.col("id")).alias("t"), F.when(F.col("id") % 2 == 0, F.struct(F.lit(1).alias("a"))).alias("s")).repartition(7)
    path = tmp_path / "out.json"
    for _ in range(2):
        files.write_json_file(rows, str(path), ["k"])
    got = json.loads(path.read_text(encoding="utf-8"))
    assert got == [{"k": k, "t": f'č "q"\n{k}', "s": {"a": 1} if k % 2 == 0 else None} for k in range(n)]
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["out.json"]


def test_cells_are_escaped(spark):
    df = spark.createDataFrame([("<b>T & 'q'</b>", 'https://h/?a=1&b="x"', "K<"), ("t", "javascript:alert(1)", ""), ("t", None, None), ("t", "/rel", ""), ("t", "page.html", "")], "t string, u string, c string")
    none = F.array().cast("array<struct<type:string>>")
    got = [r[0] for r in df.select(present.title_cell(none, F.col("c"), F.col("t"), F.col("u"))).collect()]
    assert got == ['K&lt; <a href="https://h/?a=1&amp;b=&quot;x&quot;">&lt;b&gt;T &amp; &#x27;q&#x27;&lt;/b&gt;</a>', "t", "t", '<a href="/rel">t</a>', '<a href="page.html">t</a>']
    assert df.select(present.place_cell(F.col("t"), F.lit(None).cast("string"))).first()[0] == "&lt;b&gt;T &amp; &#x27;q&#x27;&lt;/b&gt;"


def test_a_repeated_run_says_nothing_twice(spark, tmp_path):
    rows = spark.createDataFrame([("K", "O", "1")], "kraj string, okres string, doc_id string")
    entry = lambda run, text: status.entries(rows, "info", F.lit(text), F.lit("2025-01-01 00:00:00").cast("timestamp"), run, "minv")
    for run, text, step in ((1, "a", "run"), (1, "a", "run"), (1, "in", "input"), (2, "b", "run")):
        status.append(entry(run, text), str(tmp_path / "s"), step)
    told = spark.read.parquet(str(tmp_path / "s"))
    assert sorted((r["run_id"], r["text"]) for r in told.collect()) == [(1, "a"), (1, "in"), (2, "b")]
    assert [r["text"] for r in status.latest_run(told).collect()] == ["b"]


def test_upsert_keeps_rows_without_a_key(spark):
    left = spark.createDataFrame([(None, "x", 1), (None, "y", 2), ("a", "z", 3)], "url string, a string, n int")
    right = spark.createDataFrame([(1, "a", "old"), (2, "a", None), (3, "b", "new"), (4, None, "gone")], "ord int, url string, a string")
    got = [(r["url"], r["a"], r["n"]) for r in delta.merge_columns(left, right, "url", "ord").collect()]
    assert len(got) == 4 and set(got) == {(None, "x", 1), (None, "y", 2), ("a", None, 3), ("b", "new", None)}
