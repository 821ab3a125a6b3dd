"""Pages as tables of nodes, and selectors as joins between them.

Each element and text of a page is a row. Nodes are numbered in the order in which they begin (``pre``); ``last`` is the
highest number below a node. So b is below a if a.pre < b.pre <= a.last, which is a join on ranges; children and
siblings share a ``parent``, which is a plain one. A page's rows leave the parser one by one as their elements close,
so a page need not fit a batch, and joins deal its rows by parent or by block of numbers, not by page.

A tag that is never closed ends with the element around it, and a closing tag closes all that was opened since the
element of its name, as browsers have it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from noticelake.functions.dates import is_date_like
from noticelake.functions.text import strip
from noticelake.functions.urls import MINISTRY, district_name, file_id, join_url, region_name
from noticelake.sources.html import GENERAL_HEADING, MENU_ITEM, Boards, documents_of
from noticelake.sources.markup import HIDDEN, VOID
from noticelake.sources.stored import kept

TEXT, HIDDEN_TEXT = "#text", "#hidden"
NODE = "pre long, last long, level int, parent long, tag string, attrs map<string,string>, text string"
_FIELDS = [f.split()[0] for f in ("pre", "last", "level", "parent", "tag", "attrs", "text")]
#: Numbers of a block, by which rows of one page are dealt in joins on ranges.
BLOCK = 1024
_ROWS = 10_000
_FEED = 1_000_000
_REFERENCE = re.compile(r"&([a-zA-Z]+);")


class _Numbering(HTMLParser):
    """Gives each node's row to ``done`` when its last number is known. ``references``: see ``nodes``; each & is then fed as &amp;."""

    def __init__(self, references: dict[str, str] | None = None):
        super().__init__(convert_charrefs=True)
        self.references, self.raw = references, False
        self.open: list[tuple[int, str, dict[str, str]]] = []
        self.next, self.said, self.done = 1, [], []

    def _flush(self) -> None:
        if self.said:
            hidden = any(tag in HIDDEN for _, tag, _ in self.open)
            self.done.append((self.next, self.next, len(self.open) + 1, self.open[-1][0] if self.open else 0, HIDDEN_TEXT if hidden else TEXT, None, self._decoded("".join(self.said), self.raw)))
            self.next, self.said = self.next + 1, []

    def _decoded(self, text: str, raw: bool = False) -> str:
        if self.references is None:
            return text
        # The parser leaves scripts and styles as they are fed.
        return text.replace("&amp;", "&") if raw else _REFERENCE.sub(lambda m: self.references.get(m[1], m[0]), text)

    def _close(self) -> None:
        pre, tag, attrs = self.open.pop()
        self.done.append((pre, self.next - 1, len(self.open) + 1, self.open[-1][0] if self.open else 0, tag, attrs, None))

    def handle_starttag(self, tag, attrs):
        self._flush()
        self.open.append((self.next, tag, {k: self._decoded(v or "") for k, v in attrs}))
        self.next += 1
        if tag in VOID:
            self._close()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close()

    def handle_endtag(self, tag):
        if any(own == tag for _, own, _ in self.open):
            self._flush()
            while self.open[-1][1] != tag:
                self._close()
            self._close()

    def handle_data(self, data):
        self.said.append(data)
        self.raw = self.cdata_elem is not None and not getattr(self, "_escapable", False)

    def close(self):
        super().close()
        self._flush()
        while self.open:
            self._close()


def nodes(pages: DataFrame, keys: list[str], html: str = "html", references: dict[str, str] | None = None) -> DataFrame:
    """One row per element and text of each page: keys, and ``NODE``. Top-level nodes have parent 0 and level 1; null pages have none.

    Character references are read as browsers read them, those without a semicolon too, or, given ``references`` (name to
    character), only those that it names and that end with a semicolon.
    """
    schema = T.StructType([pages.schema[k] for k in keys] + T._parse_datatype_string(NODE).fields)
    wanted = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def made() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, wanted, strict=True)], schema=wanted)

        for batch in batches:
            for k in range(batch.num_rows):
                page = batch[html][k].as_py()
                if page is None:
                    continue
                own, parser = tuple(batch[c][k].as_py() for c in keys), _Numbering(references)
                if references is not None:
                    page = page.replace("&", "&amp;")
                for at in range(0, len(page), _FEED):
                    parser.feed(page[at : at + _FEED])
                    rows += [own + x[:5] + (x[5] if x[5] is None else list(x[5].items()), x[6]) for x in parser.done]
                    parser.done.clear()
                    while len(rows) >= _ROWS:
                        yield made()
                parser.close()
                rows += [own + x[:5] + (x[5] if x[5] is None else list(x[5].items()), x[6]) for x in parser.done]
                if len(rows) >= _ROWS:
                    yield made()
        if rows:
            yield made()

    return pages.select(*keys, html).mapInArrow(run, schema)


# Selectors -----------------------------------------------------------------------------------------------------------


def is_(tag: str | None = None, cls: str | None = None, **attrs: str) -> Column:
    """The condition tag.cls[attr=value]; a class is one of the words of its attribute, or the whole of it."""
    out = F.lit(True) if tag is None else F.col("tag") == tag
    if cls is not None:
        own = F.try_element_at("attrs", F.lit("class"))
        out &= F.coalesce((own == cls) | F.array_contains(F.split(own, r"\s+"), cls), F.lit(False))
    for name, value in attrs.items():
        out &= F.coalesce(F.try_element_at("attrs", F.lit(name)) == value, F.lit(False))
    return out


def as_node(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """keys, and the node as a struct."""
    return rows.select(*keys, F.struct(*_FIELDS).alias(name))


def attr(node: str, name: str) -> Column:
    return F.try_element_at(F.col(f"{node}.attrs"), F.lit(name))


def joined(left: DataFrame, right: DataFrame, on: list, how: str = "inner") -> DataFrame:
    """A join by sort and merge. Both sides grow with the pages; by their compressed size Spark would send some to the driver, to be broadcast."""
    return left.join(right.hint("merge"), on, how)


def step(context: DataFrame, at: str, axis: str, found: DataFrame, keys: list[str], name: str, how: str = "inner") -> DataFrame:
    """``context`` with the struct ``name``: each node of ``found`` on an axis of the node ``at`` (child, descendant, following)."""
    own = as_node(found, [F.col(k).alias(f"_{k}") for k in keys], name)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    pre, last = F.col(f"{at}.pre"), F.col(f"{at}.last")
    if axis == "child":
        on = [*same, F.col(f"{name}.parent") == pre]
    elif axis == "following":
        on = [*same, F.col(f"{name}.parent") == F.col(f"{at}.parent"), F.col(f"{name}.pre") > last]
    elif axis == "descendant":
        # A node meets those of the blocks that its range covers, so no task gets a page as a whole.
        covered = F.sequence(F.floor(pre / BLOCK), F.floor(last / BLOCK))
        context = context.withColumn("_block", F.explode(covered))
        own = own.withColumn("_at", F.floor(F.col(f"{name}.pre") / BLOCK))
        on = [*same, F.col("_block") == F.col("_at"), F.col(f"{name}.pre") > pre, F.col(f"{name}.pre") <= last]
        if how != "inner":
            raise ValueError("the descendant axis joins inner only")
    else:
        raise ValueError(f"no such axis: {axis}")
    drop = [f"_{k}" for k in keys] + ["_block", "_at"]
    return joined(context, own, on, how).drop(*drop)


def path(every: DataFrame, keys: list[str], *steps: tuple[str, Column]) -> DataFrame:
    """keys and ``node``: what a chain of (axis, condition) finds from the top; a node found on several ways comes once."""
    out = None
    for axis, condition in steps:
        found = every.filter(condition)
        if out is None:
            out = as_node(found if axis == "descendant" else found.filter("parent = 0"), keys, "node")
            continue
        out = step(out, "node", axis, found, keys, "_next").select(*keys, F.col("_next").alias("node"))
        if axis != "child":
            out = first_by(out, [*keys, "node.pre"], F.lit(0), "node", keys)
    return out


def first_by(rows: DataFrame, group: list[str], order: Column, node: str, keep: list[str]) -> DataFrame:
    """Of each group the node that comes first."""
    names = [f"_g{k}" for k in range(len(group))]
    found = rows.select(*(F.col(g).alias(n) for g, n in zip(group, names, strict=True)), *(c for c in keep), node, order.alias("_order"))
    firsts = found.groupBy(*names).agg(F.min_by(F.struct(*keep, node), F.struct("_order", F.col(f"{node}.pre"))).alias("_first"))
    return firsts.select("_first.*")


def texts(context: DataFrame, at: str, every: DataFrame, keys: list[str], separator: str = "", before: Column | None = None) -> DataFrame:
    """``context`` with ``text``: the shown texts below ``at``, each stripped, joined; '' if there are none. ``before``: a condition on the texts' struct ``_t``."""
    said = strip(F.col("_t.text"))
    found = step(context.select(*keys, at), at, "descendant", every.filter(F.col("tag") == TEXT), keys, "_t").filter(said != "")
    if before is not None:
        found = found.filter(before)
    names = [F.col(k).alias(f"_{k}") for k in keys]
    # The same text is met once for each row of ``context`` that repeats its node.
    parts = F.array_sort(F.collect_set(F.struct(F.col("_t.pre").alias("pre"), said.alias("said"))))
    told = found.groupBy(*names, F.col(f"{at}.pre").alias("_pre")).agg(F.array_join(F.transform(parts, lambda p: p["said"]), separator).alias("text"))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col(f"{at}.pre") == F.col("_pre")]
    return joined(context, told, on, "left").withColumn("text", F.coalesce("text", F.lit(""))).drop("_pre", *(f"_{k}" for k in keys))


# The pages of the sources --------------------------------------------------------------------------------------------


def menu(every: DataFrame, keys: list[str]) -> DataFrame:
    """Regions and districts of the menu: keys, place, kraj, url, okres_place, okres, okres_url; a region without districts has nulls there."""
    regions = path(
        every, keys, ("descendant", is_("div", "sidemenu_list")), ("descendant", is_("div", "small-nav -alt")), ("child", is_("ul")), ("descendant", is_("li", id=MENU_ITEM)), ("child", is_("ul", "sub-menu")), ("descendant", is_("li", "menu-item-has-children"))
    ).withColumnRenamed("node", "region")
    link = lambda rows, at, name: first_by(step(rows, at, "child", every.filter(is_("a")), keys, name), [*keys, f"{at}.pre"], F.lit(0), name, [*keys, at])
    named = texts(link(regions, "region", "link"), "link", every, keys).filter("text <> ''")
    named = named.select(*keys, "region", F.col("text").alias("kraj"), attr("link", "href").alias("url"))
    lists = first_by(step(named.select(*keys, "region"), "region", "child", every.filter(is_("ul", "sub-menu")), keys, "list"), [*keys, "region.pre"], F.lit(0), "list", [*keys, "region"])
    items = step(lists, "list", "descendant", every.filter(is_("li")), keys, "item").drop("list")
    linked = first_by(step(items, "item", "child", every.filter(is_("a")), keys, "link"), [*keys, "region.pre", "item.pre"], F.lit(0), "link", [*keys, "region", "item"])
    districts = texts(linked, "link", every, keys).select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("region.pre").alias("_pre"), F.col("item.pre").alias("okres_place"), F.col("text").alias("okres"), attr("link", "href").alias("okres_url"))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("region.pre") == F.col("_pre")]
    return joined(named, districts, on, "left").select(*keys, F.col("region.pre").alias("place"), "kraj", "url", "okres_place", "okres", "okres_url")


def _headings(section: DataFrame, every: DataFrame, keys: list[str], rank: Column) -> DataFrame:
    """Of each page the h2 of the section that ranks first by ``rank``, an order of its ``text``: that of an element that holds a single text, however deep."""
    # A chain of single children has as many levels as nodes and ends in a text, so the last node of an h2 tells; few texts have a rank.
    said = every.filter(F.col("tag").isin(TEXT, HIDDEN_TEXT)).withColumn("_rank", rank).filter("_rank IS NOT NULL").select(*keys, F.col("pre").alias("_end"), F.col("level").alias("_deep"), "_rank")
    heads = step(section, "section", "descendant", every.filter(is_("h2")), keys, "head").withColumn("_end", F.col("head.last"))
    chained = F.col("_deep") - F.col("head.level") == F.col("head.last") - F.col("head.pre")
    return first_by(joined(heads, said, [*keys, "_end"]).filter(chained), keys, F.col("_rank"), "head", keys)


def _frames(every: DataFrame, keys: list[str], rank: Column) -> DataFrame:
    """keys, and the nodes that bound the documents of a page with a section: head, table, and stop, the number of the next heading beside head."""
    section = first_by(as_node(every.filter(is_("div", id="popis")), keys, "section"), keys, F.lit(0), "section", keys)
    head = _headings(section, every, keys, rank)
    table = first_by(step(head, "head", "following", every.filter(is_("table", "tabdoc")), keys, "table"), keys, F.lit(0), "table", keys)
    stop = step(head, "head", "following", every.filter(is_("h2")), keys, "stop").groupBy(*keys).agg(F.min("stop.pre").alias("stop"))
    out = section.select(*keys)
    for found in (head, table, stop):
        out = joined(out, found, keys, "left")
    return out


def _paragraphs(bare: DataFrame, every: DataFrame, keys: list[str]) -> DataFrame:
    """Parts of pages without a table: keys, place, kind, text, href of the paragraphs that follow the heading up to the next."""
    said, link = strip(F.col("text")), F.col("tag") == "a"
    few = every.filter(is_("p") | link | (F.col("tag") == TEXT) & (said != "")).select(*keys, "pre", "last", "parent", "tag", F.try_element_at("attrs", F.lit("href")).alias("href"), said.alias("said"))
    # Siblings do not overlap, so the one that began last is the only one that a node can be in. One row of ``bare`` per page.
    near = few.join(bare.hint("shuffle_hash"), keys).filter((F.col("pre") > F.col("head.last")) & (F.col("stop").isNull() | (F.col("pre") < F.col("stop"))))
    own = is_("p") & (F.col("parent") == F.col("head.parent"))
    begun = F.last(F.when(own, F.struct("pre", "last")), ignorenulls=True).over(Window.partitionBy(*keys).orderBy("pre"))
    inside = near.withColumn("_p", begun).filter(~is_("p") & (F.col("pre") <= F.col("_p.last")))
    each = F.array_sort(F.collect_list(F.struct("pre", "last", link.alias("link"), "href", "said")))
    listed = inside.groupBy(*keys, F.col("_p.pre").alias("place")).agg(each.alias("all"))
    listed = listed.withColumn("first", F.get(F.filter("all", lambda x: x["link"]), F.lit(0)))
    first = F.col("first")
    told = F.filter("all", lambda x: x["said"].isNotNull() & (first.isNull() | (x["pre"] > first["pre"]) & (x["pre"] <= first["last"])))
    rows = listed.select(*keys, "place", F.when(first.isNull(), "date").otherwise("document").alias("kind"), F.array_join(F.transform(told, lambda x: x["said"]), "").alias("text"), first["href"].alias("href"))
    return rows.filter((F.col("kind") == "document") | is_date_like(F.col("text")))


def board_parts(pages: DataFrame, every: DataFrame, keys: list[str], specific: str | None = None, general: str | None = GENERAL_HEADING) -> DataFrame:
    """keys and b, struct<error, layout, parts>, for every row of ``pages``, as the Arrow function of that name finds them."""
    said = F.lower("text")
    rank = F.when(F.contains(said, F.lit(specific)) if specific else F.lit(False), 0).when(strip(said) == general if general else F.lit(False), 1)
    frames = kept(_frames(every, keys, rank))
    # Of pages with a table, the nodes below it.
    bounds = frames.filter("table IS NOT NULL").select(*keys, F.col("table.pre").alias("_from"), F.col("table.last").alias("_to"))
    wanted = F.col("tag").isin("tr", "td", "a", TEXT)
    inner = kept(every.filter(wanted).join(bounds.hint("shuffle_hash"), keys).filter((F.col("pre") > F.col("_from")) & (F.col("pre") <= F.col("_to"))).drop("_from", "_to"))
    rows = as_node(inner.filter(is_("tr")), keys, "row")
    cell = lambda cls, name: first_by(step(rows, "row", "descendant", inner.filter(is_("td", cls)), keys, name), [*keys, "row.pre"], F.lit(0), name, [*keys, "row"])
    part = lambda df, kind, text, href, before: df.select(*keys, F.col("_place").alias("place"), kind.alias("kind"), text.alias("text"), href.alias("href"), before.alias("before"))
    null = F.lit(None).cast("string")
    heading_cells = cell("tddocup", "cell")
    categories = part(texts(heading_cells, "cell", inner, keys).withColumn("_place", F.col("row.pre")), F.lit("category"), F.col("text"), null, null)
    plain = joined(cell("document-name", "cell").withColumn("_pre", F.col("row.pre")), heading_cells.select(*keys, F.col("row.pre").alias("_pre")), [*keys, "_pre"], "left_anti").drop("_pre")
    linked = first_by(step(plain, "cell", "descendant", inner.filter(is_("a", "govuk-link")), keys, "link"), [*keys, "row.pre"], F.lit(0), "link", [*keys, "row", "cell"])
    named = texts(linked, "link", inner, keys).withColumnRenamed("text", "_name")
    whole = texts(named, "cell", inner, keys)
    ahead = F.expr("substring(text, 1, greatest(locate(_name, text) - 1, 0))")
    documents = part(whole.withColumn("_place", F.col("row.pre")), F.lit("document"), F.col("_name"), attr("link", "href"), ahead)
    # Without a table: the siblings up to the next heading.
    bare = frames.filter("head IS NOT NULL AND table IS NULL").select(*keys, "head", "stop")
    loose = part(_paragraphs(bare, every, keys).withColumnRenamed("place", "_place"), F.col("kind"), F.col("text"), F.col("href"), null)
    parts = categories.unionByName(documents).unionByName(loose)
    one = F.struct("place", "kind", "text", "href", "before")
    listed = parts.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(one)), lambda p: F.struct(*(p[c].alias(c) for c in ("kind", "text", "href", "before")))).alias("parts"))
    told = pages.select(*keys)
    for found in (frames.select(*keys, F.lit(True).alias("_section"), "head", "table"), listed):
        told = joined(told, found, keys, "left")
    error = F.when(F.col("_section").isNull(), "section #popis not found").when(F.col("head").isNull(), "heading not found")
    layout = F.when(error.isNull(), F.when(F.col("table").isNotNull(), "table").otherwise("paragraphs"))
    empty = F.array().cast("array<struct<kind:string,text:string,href:string,before:string>>")
    return told.select(*keys, F.struct(error.alias("error"), layout.alias("layout"), F.coalesce("parts", empty).alias("parts")).alias("b"))


def board_documents(pages: DataFrame, keys: list[str], base: str = "https://www.minv.sk", specific: str | None = None, general: str | None = GENERAL_HEADING) -> Boards:
    """As the function of that name over whole pages, by joins over their nodes. ``keys`` are not null."""
    # Pages are read twice: for their nodes, and for the keys of those that have none.
    pages = kept(pages)
    parts = kept(board_parts(pages, kept(nodes(pages, keys)), keys, specific, general))
    docs, linkless = documents_of(parts, keys, base)
    return Boards(docs, parts.filter("b.error IS NOT NULL").select(*keys, "b.error"), linkless)


def news(every: DataFrame, keys: list[str], base: str) -> DataFrame:
    """Items of list pages: keys, place, nazov, url, datum (as written), popis."""
    box = first_by(as_node(every.filter(is_("div", "news")), keys, "box"), keys, F.lit(0), "box", keys)
    items = step(box, "box", "child", every.filter(is_("div", "news_content")), keys, "item").drop("box")
    of = lambda axis, condition, name: first_by(step(items, "item", axis, every.filter(condition), keys, name), [*keys, "item.pre"], F.lit(0), name, [*keys, "item"])
    place = F.col("item.pre").alias("place")
    link = texts(of("child", is_("a"), "link"), "link", every, keys).select(*keys, place, join_url(F.lit(base), attr("link", "href")).alias("url"), F.col("text").alias("_link"))
    title = texts(of("descendant", is_("h4"), "title"), "title", every, keys).select(*keys, place, F.col("text").alias("_title"))
    body = of("descendant", is_("div", "news_text"), "body")
    dates = first_by(step(body, "body", "descendant", every.filter(is_("span", "news_date")), keys, "date"), [*keys, "item.pre"], F.lit(0), "date", [*keys, "item", "body"])
    datum = texts(dates, "date", every, keys).select(*keys, place, F.col("text").alias("datum"))
    spans = dates.select(*keys, F.col("body.pre").alias("_body"), F.col("date.pre").alias("_from"), F.col("date.last").alias("_to"))
    body = joined(body.withColumn("_body", F.col("body.pre")), spans, [*keys, "_body"], "left")
    wide = body.withColumn("body", F.struct(*(F.col(f"body.{c}").alias(c) for c in _FIELDS), "_from", "_to")).drop("_from", "_to", "_body")
    outside = F.col("body._from").isNull() | ~F.col("_t.pre").between(F.col("body._from"), F.col("body._to"))
    rest = texts(wide, "body", every, keys, " ", outside).select(*keys, place, F.col("text").alias("popis"))
    out = items.select(*keys, place)
    for found in (link, title, datum, rest):
        out = joined(out, found, [*keys, "place"], "left")
    url = F.coalesce("url", F.lit(""))
    name = F.coalesce("_title", F.when(url != "", F.col("_link")), F.lit(""))
    return out.select(*keys, "place", name.alias("nazov"), url.alias("url"), F.coalesce("datum", F.lit("")).alias("datum"), F.coalesce("popis", F.lit("")).alias("popis"))


def crumbs(every: DataFrame, keys: list[str]) -> DataFrame:
    """keys, place, text: the links of the first breadcrumb, numbered from 0."""
    box = first_by(as_node(every.filter(is_("div", "breadcrumb")), keys, "box"), keys, F.lit(0), "box", keys)
    links = texts(step(box, "box", "descendant", every.filter(is_("a")), keys, "link").drop("box"), "link", every, keys)
    listed = links.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("link.pre").alias("pre"), "text"))).alias("all"))
    return listed.select(*keys, F.posexplode(F.col("all.text")).alias("place", "text"))


def places(pages: DataFrame, every: DataFrame, keys: list[str], url: str = "url") -> DataFrame:
    """``pages`` (keys and url) with kraj, okres, doc_id and error, by the third and fourth link of the breadcrumb."""
    told = crumbs(every, keys).groupBy(*keys).agg(F.max(F.when(F.col("place") == 2, F.col("text"))).alias("_third"), F.max(F.when(F.col("place") == 3, F.col("text"))).alias("_fourth"))
    third, fourth = F.col("_third"), F.col("_fourth")
    kraj = F.nullif(region_name(F.when(third.startswith("Kraj ") | (third == MINISTRY), third)), F.lit(""))
    okres = F.when(kraj == MINISTRY, F.lit(MINISTRY)).otherwise(F.nullif(district_name(F.when(fourth.startswith("Okresný úrad "), fourth)), F.lit("")))
    rows = joined(pages, told, keys, "left").withColumns({"kraj": kraj, "doc_id": file_id(F.col(url))}).withColumn("okres", okres).drop("_third", "_fourth")
    error = F.when(F.col("kraj").isNull(), "region not found in the breadcrumb").when(F.col("okres").isNull(), "district not found in the breadcrumb").when(F.col("doc_id").isNull(), "no document id in the URL")
    return rows.withColumn("error", error)
