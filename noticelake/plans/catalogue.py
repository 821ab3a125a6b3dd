"""The queries over the test tables, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticelake.functions import dates, text, urls
from noticelake.operators import delta, enrich, membership, nest, present, prompts, sample, status
from noticelake.plans import derived, rendered
from noticelake.plans.pipelines import recent_new_documents as flagship
from noticelake.plans.testdata import AS_OF, DOCUMENTS, OLDEST, SHARE, boards, documents, table
from noticelake.sources import html

QUERIES: dict = rendered.QUERIES | derived.QUERIES
ORACLES: dict[str, str] = rendered.ORACLES | derived.ORACLES
#: Pieces into which a nested result is dealt; a larger table takes more.
PIECES = 4096


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(column: str, pairs: dict[str, str], other: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in pairs.items()) + f" ELSE {other} END"


def _sql_stem(u: str) -> str:
    return rf"regexp_replace(regexp_extract(regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '([^/]*)$', 1), '^(.*[^.].*)\.[^.]*$', '\1')"


def _sql_value(u: str, name: str = "subor") -> str:
    return rf"url_decode(replace(regexp_extract(regexp_extract({u}, '^[^?#]*\?([^#]*)', 1), '(?:^|&){name}=([^&]+)', 1), '+', ' '))"


def _sql_doc_id(u: str) -> str:
    return f"CASE WHEN {u} IS NULL OR {u} = '' THEN NULL WHEN contains({u}, 'www.minzp.sk') THEN {_sql_stem(u)} WHEN {_sql_value(u)} <> '' THEN {_sql_value(u)} WHEN lower(regexp_extract({u}, '([^/?#]*)(?:[?#].*)?$', 1)) LIKE 'ou-%' THEN {_sql_stem(u)} ELSE 'urlhash_' || substr(sha256({u}), 1, 16) END"


NBSP = chr(0xA0)
_A, _B = rf"^(\d{{1,2}})\.[\s{NBSP}]*(\d{{1,2}})\.[\s{NBSP}]*(\d{{4}})$", r"^\d{4}-\d{1,2}-\d{1,2}$"


def _sql_iso(s: str) -> str:
    iso = f"CASE WHEN regexp_matches({s}, '{_A}') THEN regexp_extract({s}, '{_A}', 3) || '-' || regexp_extract({s}, '{_A}', 2) || '-' || regexp_extract({s}, '{_A}', 1) WHEN regexp_matches({s}, '{_B}') THEN {s} END"
    return f"coalesce(strftime(try_strptime({iso}, '%Y-%m-%d'), '%Y-%m-%d'), {s})"


# Nesting -------------------------------------------------------------------------------------------------------------


@query(f"WITH {DOCUMENTS} SELECT kraj, okres, doc_kategoria, datum, nazov, url, {_sql_doc_id('url')} AS doc_id FROM docs WHERE fresh AND datum >= '{OLDEST}'")
def recent_new_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return flagship(boards(docs), boards(docs.filter("NOT fresh")), OLDEST).select("kraj", "okres", "doc_kategoria", "datum", "nazov", "url", "doc_id")


@query(f"WITH {DOCUMENTS} SELECT kraj, kraj_url, okres, okres_url, okres_url_tabule, doc_kategoria, datum, nazov, url FROM docs")
def flatten_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nest.flatten(boards(documents(spark, sf_dir)))


@query(f"WITH {DOCUMENTS} SELECT kraj, count(DISTINCT okres) AS okresy, count(DISTINCT (okres, doc_kategoria)) AS kategorie, count(*) AS dokumenty FROM docs GROUP BY kraj")
def regroup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = nest.regroup(documents(spark, sf_dir), ordinal="place", share=F.floor(F.col("place") / SHARE))
    okres = pieces.select("kraj", F.explode("okresy").alias("o")).select("kraj", F.col("o.nazov").alias("okres"), F.explode("o.dokumenty_zivotne_prostredie").alias("k"))
    sizes = okres.groupBy("kraj", "okres", F.col("k.kategoria").alias("kategoria")).agg(F.sum(F.size("k.dokumenty")).alias("d"))
    return sizes.groupBy("kraj").agg(F.countDistinct("okres").alias("okresy"), F.count(F.lit(1)).alias("kategorie"), F.sum("d").alias("dokumenty"))


@query(f"WITH {DOCUMENTS} SELECT kraj, okres, doc_kategoria, row_number() OVER (PARTITION BY kraj, okres, doc_kategoria ORDER BY datum, place) AS rank, datum, nazov, url FROM docs")
def regroup_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nest.ranked(documents(spark, sf_dir), "place").select("kraj", "okres", "doc_kategoria", "rank", "datum", "nazov", "url")


@query(f"WITH {DOCUMENTS} SELECT kraj, okres, doc_kategoria, count(*) AS dokumenty FROM docs WHERE fresh GROUP BY ALL")
def nested_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    fresh = delta.new_on_boards(boards(docs), boards(docs.filter("NOT fresh")), share=F.floor(F.crc32(F.encode("url", "UTF-8")) / (2**32 // PIECES)))
    return nest.flatten(fresh).groupBy("kraj", "okres", "doc_kategoria").agg(F.count(F.lit(1)).alias("dokumenty"))


@query(f"WITH {DOCUMENTS} SELECT kraj, okres, doc_kategoria, count(*) AS dokumenty FROM docs WHERE datum >= '{OLDEST}' GROUP BY ALL")
def pruned_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = delta.prune_boards(boards(documents(spark, sf_dir)), lambda d: d["datum"] >= OLDEST)
    return nest.flatten(kept).groupBy("kraj", "okres", "doc_kategoria").agg(F.count(F.lit(1)).alias("dokumenty"))


@query(f"WITH {DOCUMENTS} SELECT url, datum FROM docs")
def nested_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.split("datum", "-")
    loose = F.concat(d[2].cast("int").cast("string"), F.lit(". "), d[1].cast("int").cast("string"), F.lit(". "), d[0])
    return nest.flatten(nest.with_iso_dates(boards(documents(spark, sf_dir).withColumn("datum", loose)))).select("url", "datum")


# Differences and merges ----------------------------------------------------------------------------------------------

_LISTS = "new AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 9000 AS VARCHAR) END AS url FROM orders), old AS (SELECT url FROM new WHERE k % 5 <> 0)"


def _lists(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("o_orderkey")
    new = table(spark, sf_dir, "orders").select(k.alias("k"), F.when(k % 11 != 0, (k % 9000).cast("string")).alias("url"))
    return new, new.filter("k % 5 <> 0").select("url")


@query(f"WITH {_LISTS} SELECT k, url FROM new WHERE url IS NOT NULL AND NOT EXISTS (SELECT 1 FROM old WHERE old.url = new.url)")
def flat_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.new_items(*_lists(spark, sf_dir))


@query(f"WITH {_LISTS} SELECT k, url FROM new WHERE url IS NOT NULL AND NOT EXISTS (SELECT 1 FROM old WHERE old.url = new.url)")
def flat_diff_by_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, old = _lists(spark, sf_dir)
    halves = [membership.filter_of(old.filter(F.xxhash64("url") % 2 == k), F.col("url"), blocks=64) for k in (-1, 0, 1)]
    return delta.new_items_by_filter(new, old, membership.merged(*halves), 64, prune_old=True)


@query(f"WITH {_LISTS} SELECT k, url FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.url = new.url)")
def flat_diff_null_is_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.new_rows(*_lists(spark, sf_dir), null_matches_null=False)


@query(f"WITH {_LISTS} SELECT k, url FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.url IS NOT DISTINCT FROM new.url)")
def flat_diff_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta.new_rows(*_lists(spark, sf_dir))


_UPDATES = "l AS (SELECT o_orderkey AS ord, 'u' || (o_orderkey % 7000) AS url, o_orderstatus AS a, o_orderpriority AS b FROM orders), r AS (SELECT event_id AS ord, 'u' || (event_id * 7 % 9000) AS url, CASE WHEN event_id % 4 <> 0 THEN event_type END AS a, CAST(user_id AS VARCHAR) AS c FROM events), last AS (SELECT *, min(ord) OVER (PARTITION BY url) AS first, row_number() OVER (PARTITION BY url ORDER BY ord DESC) AS n FROM r QUALIFY n = 1)"


def _updates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k, e = F.col("o_orderkey"), F.col("event_id")
    left = table(spark, sf_dir, "orders").select(k.alias("ord"), F.concat(F.lit("u"), (k % 7000).cast("string")).alias("url"), F.col("o_orderstatus").alias("a"), F.col("o_orderpriority").alias("b"))
    right = table(spark, sf_dir, "events").select(e.alias("ord"), F.concat(F.lit("u"), (e * 7 % 9000).cast("string")).alias("url"), F.when(e % 4 != 0, F.col("event_type")).alias("a"), F.col("user_id").cast("string").alias("c"))
    return left, right


@query(f"WITH {_UPDATES} SELECT coalesce(last.url, l.url) AS url, CASE WHEN last.n = 1 THEN last.a ELSE l.a END AS a, l.b, last.c FROM l FULL JOIN last ON l.url = last.url")
def merge_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _updates(spark, sf_dir)
    return delta.merge_columns(left, right, "url", "ord").select("url", "a", "b", "c")


@query(
    f"""WITH {_UPDATES} SELECT 0 AS part, l.ord, l.url, CASE WHEN last.n = 1 THEN last.a ELSE l.a END AS a, l.b, last.c FROM l LEFT JOIN last ON l.url = last.url
UNION ALL SELECT 1, first, url, a, NULL, c FROM last WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.url = last.url)"""
)
def merge_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_map = lambda df, *names: df.select("ord", F.create_map(*(x for n in names for x in (F.lit(n), F.col(n)))).alias("m"))
    left, right = _updates(spark, sf_dir)
    merged = delta.merge_maps(as_map(left, "url", "a", "b"), as_map(right, "url", "a", "c"))
    return merged.select("part", "ord", *(F.try_element_at("m", F.lit(n)).alias(n) for n in ("url", "a", "b", "c")))


@query("SELECT o.o_orderkey AS url, CASE WHEN l.k IS NOT NULL THEN 'P' ELSE o_orderstatus END AS o_orderstatus, CAST(l.k AS VARCHAR) AS lines FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS k FROM lineitem GROUP BY 1) l ON o_orderkey = l_orderkey")
def fold_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("url"), "o_orderstatus")
    results = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("url")).agg(F.lit("P").alias("o_orderstatus"), F.count(F.lit(1)).cast("string").alias("lines"))
    return enrich.fold_results(docs, results)


@query("SELECT d.doc_id, coalesce(length(d.text) < 10, true) AS run_text, coalesce(length(d.text) < 10, true) OR l.doc_id IS NULL OR l.quality = 0 AS run_analysis FROM documents d LEFT JOIN labels l USING (doc_id)")
def incremental_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    done = docs.join(labels, "doc_id", "left").select("doc_id", F.length("text").alias("text"), F.when(F.col("quality") == 1, 100).when(F.col("quality") == 0, 5).alias("analysis"))
    return delta.stages_to_run(docs.select("doc_id"), done, "doc_id", ("text", "analysis"))


# Dates ---------------------------------------------------------------------------------------------------------------

_ORDER_DATES = f"""dated AS (SELECT o_orderkey AS k, CASE o_orderkey % 9 WHEN 0 THEN strftime(d, '%-d. %-m. %Y') WHEN 1 THEN strftime(d, '%-d.%-m.%Y') WHEN 2 THEN strftime(d, '%-d.%-m. %Y') WHEN 3 THEN strftime(d, '%d.{NBSP}%m.{NBSP}%Y')
  WHEN 4 THEN strftime(d, '%Y-%m-%d') WHEN 5 THEN strftime(d, '%Y-%-m-%-d') WHEN 6 THEN '31. 2. ' || year(d) WHEN 7 THEN strftime(d, ' %d.%m.%y') ELSE NULL END AS datum FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders))"""


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    forms = ["d. M. yyyy", "d.M.yyyy", "d.M. yyyy", f"dd.{NBSP}MM.{NBSP}yyyy", "yyyy-MM-dd", "yyyy-M-d", "'31. 2. 'yyyy", " dd.MM.yy"]
    datum = F.lit(None).cast("string")
    for n, form in enumerate(forms):
        datum = F.when(k % 9 == n, F.date_format(d, form)).otherwise(datum)
    return table(spark, sf_dir, "orders").select(k.alias("k"), datum.alias("datum"))


@query(f"WITH {_ORDER_DATES} SELECT k, datum, {_sql_iso('datum')} AS iso, coalesce(length(trim(datum)) < 15 AND regexp_full_match(trim(datum), '\\d{{1,2}}\\.\\s*\\d{{1,2}}\\.\\s*\\d{{2,4}}'), false) AS date_like, strftime(try_strptime({_sql_iso('datum')}, '%Y-%m-%d'), '%d/%m/%Y') AS day FROM dated")
def date_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("datum")
    return _dated(spark, sf_dir).select("k", "datum", dates.iso_date(d).alias("iso"), dates.is_date_like(d).alias("date_like"), F.date_format(dates.as_date(d), "dd/MM/yyyy").alias("day"))


@query(f"WITH {_ORDER_DATES} SELECT k, datum FROM dated WHERE datum <> '' AND datum >= '{OLDEST[:4]}'")
def recency_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.recent(_dated(spark, sf_dir), OLDEST[:4])


@query(f"WITH {_ORDER_DATES} SELECT k, datum FROM dated WHERE try_strptime({_sql_iso('datum')}, '%Y-%m-%d') >= DATE '1995-06-01'")
def recency_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.recent(_dated(spark, sf_dir), "1995-06-01", strict=True)


@query(f"SELECT o_orderkey AS k, strftime(CAST(o_orderdate AS DATE) - 7, '%Y-%m-%d') AS week_before, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(o_orderdate, '%-d. %-m. %Y') AS shown FROM orders")
def date_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), dates.days_before(d, 7).alias("week_before"), dates.stamp(d).alias("stamp"), dates.shown_date(dates.stamp(d)).alias("shown"))


# URLs, ids, names ----------------------------------------------------------------------------------------------------


@query(f"SELECT page_id, url, {_sql_doc_id('url')} AS doc_id FROM pages")
def doc_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", urls.doc_id(F.col("url")).alias("doc_id"))


@query(f"WITH {DOCUMENTS} SELECT place, {_sql_doc_id('url')} AS doc_id, nullif({_sql_stem('url')}, '') AS file_id, nullif({_sql_value('url')}, '') AS parameter_id FROM docs")
def doc_id_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return documents(spark, sf_dir).select("place", urls.doc_id(u).alias("doc_id"), urls.file_id(u).alias("file_id"), urls.parameter_id(u).alias("parameter_id"))


@query(f"WITH {DOCUMENTS} SELECT place, 'https://www.minv.sk' || kraj_url AS kraj_url, 'https://www.minv.sk' || okres_url_tabule || '#popis' AS board FROM docs")
def links_absolute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("place", urls.absolute(F.col("kraj_url"), "https://www.minv.sk").alias("kraj_url"), urls.board_link(F.col("okres_url_tabule")).alias("board"))


@query("SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || '/x' AS rooted, regexp_replace(url, '^([^?#]*/)[^/?#]*(?:[?#].*)?$', '\\1') || 'y' AS relative FROM pages")
def links_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", urls.join_url(F.col("url"), F.lit("/x")).alias("rooted"), urls.join_url(F.col("url"), F.lit("y")).alias("relative"))


_TYPES = [*urls.SUFFIXES, "video/mp4", "text/plain; charset=utf-8", ""]


@query(f"WITH t AS (SELECT event_id, ([{', '.join(map(_quoted, _TYPES))}])[CAST(event_id % {len(_TYPES)} AS INTEGER) + 1] AS ct FROM events) SELECT event_id, {_case(chr(39).join(('trim(split_part(ct, ', ';', ', 1))')), urls.SUFFIXES, chr(39) + '.bin' + chr(39))} AS suffix FROM t")
def mime_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    ct = F.element_at(F.array(*map(F.lit, _TYPES)), (F.col("event_id") % len(_TYPES)).cast("int") + 1)
    return table(spark, sf_dir, "events").select("event_id", urls.file_suffix(ct).alias("suffix"))


_FILES = [f"A{k}" for k in urls.OFFICE_FORMATS] + [f"b{k.upper()}" for k in urls.OFFICE_FORMATS] + ["c.pdf", "d"]


@query(f"WITH t AS (SELECT event_id, ([{', '.join(map(_quoted, _FILES))}])[CAST(event_id % {len(_FILES)} AS INTEGER) + 1] AS f FROM events) SELECT event_id, {_case('lower(regexp_extract(f, ' + _quoted('([.][^.]+)$') + ', 1))', urls.OFFICE_FORMATS, 'NULL')} AS format FROM t")
def office_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = F.element_at(F.array(*map(F.lit, _FILES)), (F.col("event_id") % len(_FILES)).cast("int") + 1)
    return table(spark, sf_dir, "events").select("event_id", urls.office_format(f).alias("format"))


_REGIONS = [*urls.REGIONS, "Ministerstvo", "Kraj Neznámy"]


@query(f"WITH t AS (SELECT c_custkey AS k, ([{', '.join(map(_quoted, _REGIONS))}])[CAST(c_custkey % {len(_REGIONS)} AS INTEGER) + 1] AS r, CASE c_custkey % 3 WHEN 0 THEN 'Okresný úrad ' || c_name WHEN 1 THEN 'okresný ÚRAD  ' || c_name || ' ' ELSE c_name END AS o FROM customer) SELECT k, {_case('r', urls.REGIONS, 'r')} AS kraj, trim(regexp_replace(o, '(?i)^Okresný úrad\\s+', '')) AS okres FROM t")
def place_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("c_name")
    r = F.element_at(F.array(*map(F.lit, _REGIONS)), (k % len(_REGIONS)).cast("int") + 1)
    o = F.when(k % 3 == 0, F.concat(F.lit("Okresný úrad "), n)).when(k % 3 == 1, F.concat(F.lit("okresný úrad  "), n, F.lit(" "))).otherwise(n)
    return table(spark, sf_dir, "customer").select(k.alias("k"), urls.region_name(r).alias("kraj"), urls.district_name(o).alias("okres"))


@query("SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(strip_accents(text), '[^\\p{L}\\p{N}_]+', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g') AS name FROM documents")
def safe_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", urls.safe_file_name(F.col("text")).alias("name"))


@query(f"SELECT event_id, {_case('lower(event_type)', urls.ICONS, 'event_type')} AS icon FROM events")
def status_icons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", urls.status_icon(F.col("event_type")).alias("icon"))


# Enrichment and status -----------------------------------------------------------------------------------------------

@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL AND l.toxic = 0 THEN '{\"quality\": ' || l.quality || '}' END AS analysis, CASE WHEN l.doc_id IS NULL THEN 1 WHEN l.toxic = 1 THEN 1 ELSE 0 END AS errors, 'https://www.minv.sk/k' AS kraj_url FROM documents d LEFT JOIN labels l USING (doc_id)")
def enrich_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = lambda c: F.concat(F.lit("https://example.com/?subor="), c.cast("string"))
    docs = table(spark, sf_dir, "documents").select(F.col("lang").alias("kraj"), F.col("source").alias("okres"), url(F.col("doc_id")).alias("url"), F.lit("/k").alias("kraj_url"), F.col("doc_id").alias("number"))
    good = F.concat(F.lit('{"quality": '), F.col("quality").cast("string"), F.lit("}"))
    places = table(spark, sf_dir, "documents").select("doc_id", "lang", "source").withColumnRenamed("source", "okres")
    store = table(spark, sf_dir, "labels").join(places, "doc_id").select(
        F.lit("minv").alias("source"), F.col("lang").alias("kraj"), "okres", F.col("doc_id").cast("string").alias("doc_id"), F.lit("analysis.json").alias("file_name"), F.when(F.col("toxic") == 1, F.concat(good, F.lit(" trailing"))).otherwise(good).alias("content")
    )
    rows = enrich.enrich(docs, store, "minv", F.lit(AS_OF).cast("timestamp"))
    return rows.select(F.col("number").alias("doc_id"), "analysis", F.size("status").alias("errors"), "kraj_url")


@query("SELECT doc_id, text, lang, NULL::VARCHAR AS url FROM documents UNION ALL SELECT page_id, html, NULL, url FROM pages")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return enrich.unite(docs, table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"), "url"))


_STATUS = "e AS (SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamped FROM events)"


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("doc_id"), F.lit("k").alias("kraj"), F.lit("o").alias("okres"), "event_type", "ts", "event_id", "value")
    return status.entries(rows, F.col("event_type"), F.concat(F.lit("event "), F.col("event_id").cast("string")), F.col("ts"), 1, "events")


@query(f"WITH {_STATUS} SELECT r_name AS kraj, n_name AS okres, 'https://www.minv.sk/b/' || n_nationkey || '#popis' AS okres_url_tabule, stamped AS datum, event_type AS typ, 'event ' || event_id AS sprava FROM e JOIN nation ON n_nationkey = user_id % 25 JOIN region ON n_regionkey = r_regionkey")
def status_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(F.col("r_name").alias("kraj"), F.col("n_name").alias("okres"), F.col("n_nationkey"))
    okres = F.struct(F.col("okres").alias("nazov"), F.concat(F.lit("/b/"), F.col("n_nationkey").cast("string")).alias("url"))
    nested = places.groupBy("kraj").agg(F.collect_list(okres).alias("okresy"))
    log = _status(spark, sf_dir).withColumn("at", (F.col("doc_id").cast("long") % 25).cast("int"))
    # A district's log is one file; the test's files are made per place and day so that none grows with the table.
    files = log.groupBy("at", F.substring("date", 1, 10).alias("day")).agg(F.to_json(F.collect_list(F.struct("date", "type", "text"))).alias("content"))
    store = files.join(F.broadcast(places), files["at"] == places["n_nationkey"]).select(F.lit("minv").alias("source"), "kraj", "okres", F.lit(None).cast("string").alias("doc_id"), F.lit("status.json").alias("file_name"), "content")
    return enrich.district_status(nested, store)


@query(f"WITH {_STATUS}, r AS (SELECT *, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END + user_id % 2 AS run FROM e) SELECT user_id, run, count(*) AS n FROM (SELECT *, max(run) OVER (PARTITION BY user_id) AS last FROM r) WHERE run = last GROUP BY ALL")
def status_latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _status(spark, sf_dir).withColumn("run_id", (F.when(F.col("type") == "error", 1).otherwise(0) + F.col("doc_id").cast("long") % 2).cast("long"))
    last = status.latest_run(log).groupBy(F.col("doc_id").cast("long").alias("user_id"), F.col("run_id").alias("run")).agg(F.count(F.lit(1)).alias("n"))
    return last


@query(f"WITH f AS (SELECT user_id, arg_min(event_type, event_id) AS typ FROM events GROUP BY 1) SELECT user_id, {_case('lower(typ)', urls.ICONS, 'typ')} || ' <a href=\"https://example.com/' || user_id || '\">' || user_id || '</a>' AS cell FROM f")
def title_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min_by("event_type", "event_id").alias("type"))
    name = F.col("user_id").cast("string")
    entries = nest.appended(F.array(F.struct(F.col("type").alias("type"))), F.array(F.struct(F.lit("info").alias("type"))))
    return first.select("user_id", present.title_cell(entries, F.lit(""), name, F.concat(F.lit("https://example.com/"), name)).alias("cell"))


@query("SELECT event_id, CASE WHEN user_id % 7 = 0 THEN 'Invalid or empty URL' WHEN event_type = 'error' THEN 'Missing region' WHEN value < 10 THEN 'Missing district' END AS fault FROM events WHERE user_id % 7 = 0 OR event_type = 'error' OR value < 10")
def fault_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    rows = e.select("event_id", F.when(F.col("user_id") % 7 == 0, " ").otherwise("u").alias("url"), F.when(F.col("event_type") != "error", "k").alias("kraj"), F.when(F.col("value") < 10, "").otherwise("o").alias("okres"))
    return status.faults(rows).select("event_id", "fault")


# Presentation --------------------------------------------------------------------------------------------------------


@query("SELECT d.doc_id, l.doc_id IS NOT NULL AS has_analysis, coalesce(l.toxic = 0, false) AS valid_analysis, CASE WHEN l.doc_id IS NULL THEN 'Bez analýzy' WHEN l.quality = 1 THEN 'a, b' ELSE 'N/A' END AS shown FROM documents d LEFT JOIN labels l USING (doc_id)")
def analysis_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    analysis = F.when(F.col("toxic") == 1, '{"error": "x"}').when(F.col("toxic") == 0, '{"zhrnutie": "y"}')
    kinds = F.when(F.col("quality") == 1, F.array(F.lit("a"), F.lit("b")))
    return rows.select("doc_id", present.has_analysis(analysis).alias("has_analysis"), present.has_valid_analysis(analysis).alias("valid_analysis"), present.shown(kinds, analysis, "Bez analýzy").alias("shown"))


@query(f"WITH {DOCUMENTS} SELECT place, '<a href=\"' || kraj_url || '\">' || kraj || '</a>' AS kraj, coalesce(CASE WHEN place % 3 = 0 THEN nazov END, 'Súhrn chýba') || chr(10) || 'ID: ' || coalesce(CASE WHEN place % 2 = 0 THEN nazov END, 'N/A') || chr(10) || datum || ' ℹ️ ok' AS summary FROM docs")
def row_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = F.array(F.struct(F.col("datum").alias("date"), F.lit("info").alias("type"), F.lit("ok").alias("text")))
    summary = present.summary(F.when(F.col("place") % 3 == 0, F.col("nazov")), F.when(F.col("place") % 2 == 0, F.col("nazov")), entries)
    return documents(spark, sf_dir).select("place", present.place_cell(F.col("kraj"), F.col("kraj_url")).alias("kraj"), summary.alias("summary"))


@query(f"WITH {DOCUMENTS} SELECT datum, nazov, url FROM docs ORDER BY datum DESC, url LIMIT 100 OFFSET 100")
def grid_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.page(present.newest_first(documents(spark, sf_dir).select("datum", "nazov", "url")), 2)


_WORD = "[A-Za-zéèêçáíóúñäöüÉÈÊÇÁÍÓÚÑÄÖÜ]+"
_SQL_WORDS = f"words AS (SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS w FROM documents) GROUP BY w)"


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The different words of all whole texts, with their counts."""
    return table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(_WORD), F.lit(0))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_SQL_WORDS} SELECT min(w) AS word, CAST(sum(n) AS BIGINT) AS n FROM words GROUP BY strip_accents(lower(w))")
def collated_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _words(spark, sf_dir).groupBy(present.collation_key(F.col("w"))).agg(F.min("w").alias("word"), F.sum("n").alias("n")).select("word", "n")


@query(f"WITH {_SQL_WORDS} SELECT w AS word, n FROM words ORDER BY strip_accents(lower(w)), w LIMIT 50 OFFSET 50")
def collated_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.page(_words(spark, sf_dir).orderBy(present.collation_key(F.col("w")), "w").withColumnRenamed("w", "word"), 2, 50)


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring') AND contains(lower(p_type), 'l')")
def header_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.matching(table(spark, sf_dir, "part"), p_name="RING", p_type="L", p_brand="").select("p_partkey", "p_name")


@query("SELECT event_id, ts FROM events WHERE event_type = 'error'")
def level_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present.of_level(table(spark, sf_dir, "events").withColumn("typ", F.col("event_type")), "error").select("event_id", "ts")


@query("SELECT doc_id, lang FROM documents ORDER BY sha256('7:' || doc_id), doc_id LIMIT 100")
def sample_hash_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), 100, "doc_id", 7)


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"))


# Text ----------------------------------------------------------------------------------------------------------------

_STRIPPED = "regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g')"


@query(f"SELECT doc_id, length({_STRIPPED}) < 32 AS needs_ocr, {_STRIPPED} = '' AS blank FROM documents")
def text_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.needs_ocr(F.col("text")).alias("needs_ocr"), text.is_blank(F.col("text")).alias("blank"))


@query(f"SELECT doc_id, {_STRIPPED} AS body FROM documents")
def fence_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 3
    fenced = F.when(k == 0, F.concat(F.lit(" ```markdown\n"), F.col("text"), F.lit("\n```\n"))).when(k == 1, F.concat(F.lit("```\n"), F.col("text"), F.lit("```"))).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", text.without_fences(fenced).alias("body"))


@query("WITH t AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN props WHEN 1 THEN props || ' trailing' WHEN 2 THEN '```' || props || '```' WHEN 3 THEN '' ELSE '[' || props || ', null]' END AS j FROM events) SELECT event_id, json_valid(j) AS valid FROM t")
def json_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, p = F.col("event_id") % 5, F.col("props")
    j = F.when(k == 0, p).when(k == 1, F.concat(p, F.lit(" trailing"))).when(k == 2, F.concat(F.lit("```"), p, F.lit("```"))).when(k == 3, "").otherwise(F.concat(F.lit("["), p, F.lit(", null]")))
    return table(spark, sf_dir, "events").select("event_id", text.strict_json(j)["error"].isNull().alias("valid"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query(f"SELECT conv_id, string_agg(text, {_quoted(text.ARCHIVE_SEPARATOR)} ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def archive_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompts.archive_text(table(spark, sf_dir, "conversations"), ["conv_id"], "turn")


@query(f"SELECT 'A' || string_agg('Príklad dokumentu (z ' || conv_id || '/' || turn || '):' || chr(10) || chr(10) || text, {_quoted(text.DOCUMENT_SEPARATOR)} ORDER BY conv_id || '/' || turn) || 'B' AS prompt FROM (SELECT * FROM conversations ORDER BY sha256('3:' || conv_id || '/' || turn) LIMIT 20)")
def prompt_of_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat(F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string"))
    rows = table(spark, sf_dir, "conversations").select(path.alias("path"), F.col("text").alias("content"))
    return prompts.prompt(sample.sample(rows, 20, "path", 3), "A{examples}B")


# Pages ---------------------------------------------------------------------------------------------------------------


@query("SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN CAST(event_id AS VARCHAR) END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS since FROM events")
def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("at", F.struct("ts", "event_id"))
    since = html.carried(F.when(F.col("event_type") == "signup", F.col("event_id").cast("string")), ["user_id"], "at")
    return e.select("event_id", "user_id", since.alias("since"))


@query("SELECT user_id, page FROM (SELECT user_id, page, row_number() OVER (PARTITION BY user_id ORDER BY page) AS n FROM (SELECT DISTINCT user_id, event_id // 40 - min(event_id // 40) OVER (PARTITION BY user_id) + 1 AS page FROM events)) WHERE page = n")
def contiguous_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.floor(F.col("event_id") / 40)
    rows = table(spark, sf_dir, "events").select("user_id", (number - F.min(number).over(Window.partitionBy("user_id")) + 1).alias("page")).distinct()
    return html.contiguous(rows, "page", ["user_id"])


@query(None)
def page_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole pages as Markdown; a parser's work, so tests compare with written pages (``item_markdown`` has SQL)."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.concat(F.lit("<main>"), "html", F.lit("</main>")).alias("html"))
    return html.with_markdown(pages, ["page_id"])
