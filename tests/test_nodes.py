"""Node tables against the element tree, and their selectors against the functions that walk it."""

import fixture_queries as fx
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from noticelake.sources import html, nodes
from noticelake.sources.markup import HIDDEN, Element, parse

PARTS = ["<p>", "</p>", "<div class='a b'>", "</div>", "<b>", "</b>", "<br>", "<br/>", "<x/>", "text ", " &amp; ", "</x>", "<ul>", "<li>", "</li>", "</ul>", "<!-- c -->", "<script>a<b</script>", "<style>x</style>", "<"]


def numbered(page):
    parser = nodes._Numbering()
    for k in range(0, len(page), 7):
        parser.feed(page[k : k + 7])
    parser.close()
    return sorted(x[:5] for x in parser.done), {x[0]: x[6] for x in parser.done if x[4][0] == "#"}


def walked(page):
    """The same numbers by walking the tree."""
    out, texts = [], {}

    def walk(e, level, parent, at, hidden):
        for c in e.children:
            if isinstance(c, Element):
                own = at
                inner = walk(c, level + 1, own, at + 1, hidden or c.tag in HIDDEN)
                out.append((own, inner - 1, level, parent, c.tag))
                at = inner
            else:
                out.append((at, at, level, parent, "#hidden" if hidden else "#text"))
                texts[at] = c
                at += 1
        return at

    walk(parse(page), 1, 0, 1, False)
    return sorted(out), texts


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30).map("".join))
def test_numbers_match_the_tree(page):
    assert numbered(page) == walked(page)


def rows_of(df):
    return sorted((tuple(sorted((k, str(v)) for k, v in r.asDict(recursive=True).items())) for r in df.collect()))


@pytest.mark.parametrize("block", [2, nodes.BLOCK])
def test_boards_match_the_tree(spark, monkeypatch, block):
    monkeypatch.setattr(nodes, "BLOCK", block)
    more = {"nested": fx._TABLE.replace("Lesy", "Les<b>y</b>"), "two": fx._PARAGRAPHS + fx._TABLE, "split": fx._PARAGRAPHS.replace("1.5.2025", "1.5.<i>2025</i>")}
    pages = spark.createDataFrame([*fx._BOARDS.items(), *more.items()], "page string, html string")
    own = nodes.board_documents(pages, ["page"], specific="životné prostredie")
    want = html.board_documents(pages, ["page"], specific="životné prostredie")
    for a, b in zip(own, want, strict=True):
        drop = [c for c in ("place",) if c in a.columns]
        assert rows_of(a.drop(*drop)) == rows_of(b.drop(*drop))


def test_menu_and_news_match_the_tree(spark):
    pages = spark.createDataFrame([("m", fx._MENU), ("other", fx._MENU.replace("small-nav", "big")), ("n", fx._news(1, 3)), ("last", fx._news(3, 3).replace("<h4>Správa 3</h4>", "")), ("null", None)], "page string, html string")
    every = nodes.nodes(pages, ["page"])
    want = pages.select("page", F.inline(html.menu_tree("html"))).select("page", "kraj", "url", F.explode_outer("okresy").alias("o")).select("page", "kraj", "url", F.col("o.nazov").alias("okres"), F.col("o.url").alias("okres_url"))
    assert rows_of(nodes.menu(every, ["page"]).drop("place", "okres_place")) == rows_of(want)
    want = pages.filter("html IS NOT NULL").select("page", F.inline(html.news_items("html", F.lit("https://h"))))
    assert rows_of(nodes.news(every, ["page"], "https://h").drop("place")) == rows_of(want)


def test_places_match_the_tree(spark):
    rows = [("https://h/a.html", fx._PAGE), ("https://h/b.html", fx._PAGE.replace("Kraj Žilina", "Ministerstvo")), ("https://h/c.html", fx._PAGE.replace("Okresný úrad ", "")), ("https://h/d.html", "<main></main>"), ("https://h/", fx._PAGE)]
    pages = spark.createDataFrame(rows, "url string, html string")
    own = nodes.places(pages.select("url"), nodes.nodes(pages, ["url"]), ["url"])
    want = html.placed(pages).drop("html", "text")
    blank = lambda df: df.select("url", *(F.when(F.col("error").isNull(), F.col(c)).alias(c) for c in ("kraj", "okres", "doc_id")), "error")
    assert rows_of(blank(own)) == rows_of(blank(want))


def test_a_page_longer_than_a_batch_and_axes(spark):
    page = "<ul id='u'>" + "<li>x<b>y</b></li>" * 9000 + "</ul><p>after</p><p>more</p>"
    pages = spark.createDataFrame([(1, page), (None, "<p>a</p><i></i><p>b</p>"), (2, None), (3, "")], "k int, html string")
    every = nodes.nodes(pages, ["k"]).cache()
    assert every.groupBy("k").count().collect() and {r["k"]: r["count"] for r in every.groupBy("k").count().collect()} == {1: 1 + 4 * 9000 + 4, None: 5}
    items = nodes.path(every, ["k"], ("child", nodes.is_("ul", id="u")), ("child", nodes.is_("li")), ("child", nodes.is_("b")))
    assert items.count() == 9000 and nodes.path(every, ["k"], ("descendant", nodes.is_("ul")), ("descendant", nodes.is_("b"))).count() == 9000
    first = nodes.path(every, ["k"], ("child", nodes.is_("p")))
    after = nodes.step(first, "node", "following", every.filter(nodes.is_("p")), ["k"], "next")
    assert sorted((r["k"] or 0) for r in after.collect()) == [0, 1]
    whole = nodes.texts(nodes.path(every, ["k"], ("child", nodes.is_("ul"))), "node", every, ["k"])
    assert whole.first()["text"] == "xy" * 9000


def test_boards_send_no_nodes_to_the_driver(spark):
    """Every join says how it is done, so that none is broadcast by its compressed size; and they are few."""
    pages = spark.createDataFrame([*fx._BOARDS.items()], "page string, html string")
    plan = nodes.board_parts(pages, nodes.nodes(pages, ["page"]), ["page"])._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert 0 < len(joins) < 60 and all("strategy=" in line for line in joins)


def test_headings_equal_their_sql(spark, tmp_path):
    """References without a semicolon stay; headings outside articles and several on a page count, each with its own siblings."""
    import duckdb

    from noticelake.plans import rendered

    pages = ["<article><h1>A &amp; b&&amp;&amp</h1><p>x</p><p>y<b>z</b></p></article>", "<h1>Out &lt; &copy;</h1><p>q</p><article><h1>One</h1><p>a</p><h1> Two &quot;</h1><p>b</p><p>c &am</p></article>", "<script>if (a && b) c('&amp;')</script><h1 title='&amp;&amp'></h1>", "<p>none</p>"]
    spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").withColumn("url", F.lit("https://h/")).coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
        for name in ("page_headings", "page_blocks"):
            got = sorted(map(tuple, rendered.QUERIES[name](spark, str(tmp_path)).collect()))
            assert got == sorted(c.execute(rendered.ORACLES[name]).fetchall())
    hidden = nodes.nodes(spark.createDataFrame([(1, pages[2])], "k int, html string"), ["k"], references={"amp": "&"})
    assert {(r["tag"], r["text"] or r["attrs"].get("title")) for r in hidden.collect()} == {("script", None), ("#hidden", "if (a && b) c('&amp;')"), ("h1", "&&amp")}


def test_item_pages_tell_all_that_a_page_says(spark):
    """The content and the address beside the place, as ``html.placed`` gives them."""
    from noticelake.plans import rendered

    rows = rendered.item_pages(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["k", "url", "error", "kraj", "okres", "doc_id", "text"]
    found = {r["k"]: r for r in rows.filter("k IN (1, 19, 35)").collect()}
    assert found[1]["text"].startswith("# Customer#") and found[1]["url"] == "https://h/f1.html" and found[1]["error"] is None
    assert found[19]["text"] is None and found[19]["error"] == "no main element" and found[19]["doc_id"] == "f19"
    assert found[35]["text"].endswith("\n\n1. c")


def test_customers_are_dealt_to_all_cores(spark):
    """One small file of customers is one part; their pages are rendered and parsed in more."""
    from noticelake.plans import rendered

    rows = rendered.item_markdown(spark, "/root/testdata/sf0.001")
    assert rows.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
