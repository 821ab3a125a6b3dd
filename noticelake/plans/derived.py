"""Queries over what is stored or streamed: sites, keyed state, histories, records, sketches, indexes, archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.operators import history, present, rankindex, sketches, textindex
from noticelake.plans.testdata import table
from noticelake.sources import archives, records, site
from noticelake.sources.stored import kept, new_folder
from noticelake.streaming import state

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


# A site and its stream -----------------------------------------------------------------------------------------------


def _site(spark: SparkSession, sf_dir: str) -> str:
    """``pages`` served as a site, one page of the site for each; the name of its source."""
    folder = new_folder(spark, "site")
    site.store_site(table(spark, sf_dir, "pages").select((F.col("page_id") + 1).alias("page"), F.col("html").alias("body")), folder)
    return site.register(spark, site.stored_site(folder))


@query("SELECT page_id + 1 AS page, 200 AS http_status, md5(html) AS digest FROM pages")
def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.format(_site(spark, sf_dir)).option("address", "https://h/list?page={page}").load()
    return rows.select("page", "http_status", F.md5("body").alias("digest"))


@query("SELECT page_id + 1 AS page, md5(html) AS digest FROM pages")
def site_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.readStream.format(_site(spark, sf_dir)).option("address", "https://h/list?page={page}").load()
    out = new_folder(spark, "site-stream")
    state.to_table(rows.select("page", F.md5("body").alias("digest")), f"{out}/rows", f"{out}/offsets").awaitTermination()
    return spark.read.schema("page long, digest string").parquet(f"{out}/rows").select("page", "digest")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A stream wants a folder or a pattern.
    return spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/event[s].parquet")


@query("SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen FROM events GROUP BY 1")
def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = state.first_seen(_events(spark, sf_dir).select("user_id", "ts"), "user_id", "ts")
    out = new_folder(spark, "first-seen")
    state.to_table(rows, f"{out}/rows", f"{out}/state").awaitTermination()
    return spark.read.schema("user_id long, ts timestamp").parquet(f"{out}/rows").groupBy("user_id").agg(F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("first_seen"))


@query("WITH r AS (SELECT user_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END + user_id % 2 AS run FROM events) SELECT user_id, run AS run_id, count(*) AS n FROM (SELECT *, max(run) OVER (PARTITION BY user_id) AS last FROM r) WHERE run = last GROUP BY ALL")
def stream_latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = F.when(F.col("event_type") == "error", 1).otherwise(0) + F.col("user_id") % 2
    rows = state.latest_runs(_events(spark, sf_dir).select("user_id", run.alias("run_id"), "ts"), ["user_id"], at="ts")
    out = new_folder(spark, "latest-run")
    state.to_table(rows, f"{out}/rows", f"{out}/state", "update").awaitTermination()
    return state.latest_of(spark.read.schema("user_id long, run_id long, n long, batch int").parquet(f"{out}/rows"), ["user_id"])


# Histories -----------------------------------------------------------------------------------------------------------

_SNAPSHOTS = """snaps AS (SELECT 'u' || o_orderkey AS url, o_orderstatus || CASE WHEN v >= 6 AND o_orderkey % 4 = 0 THEN '*' ELSE '' END AS stav, v AS version FROM orders, (SELECT unnest(range(1, 11)) AS v) WHERE (o_orderkey * 7 + v // 2 * 3) % 10 < 7)"""
_RUNS = "runs AS (SELECT url, stav, min(version) AS since, max(version) AS until FROM (SELECT *, version - row_number() OVER (PARTITION BY url, stav ORDER BY version) AS g FROM snaps) GROUP BY url, stav, g)"


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ten snapshots: some are listed now and then, some change in the sixth."""
    key, v = F.col("o_orderkey"), F.col("version")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("version"))
    rows = rows.filter((key * 7 + F.floor(v / 2) * 3) % 10 < 7)
    stav = F.concat("o_orderstatus", F.when((v >= 6) & (key % 4 == 0), "*").otherwise(""))
    return rows.select(F.concat(F.lit("u"), key.cast("string")).alias("url"), stav.alias("stav"), "version")


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine snapshots at once, and the tenth as it arrives."""
    rows = _snapshots(spark, sf_dir)
    return history.extended(history.intervals(rows.filter("version < 10")), rows.filter("version = 10").drop("version"), 10)


@query(f"WITH {_SNAPSHOTS}, {_RUNS} SELECT url, stav, since, until FROM runs")
def snapshot_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir)


@query(f"WITH {_SNAPSHOTS} SELECT url, stav FROM snaps WHERE version = 7")
def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.as_of(_history(spark, sf_dir), 7)


@query(f"WITH {_SNAPSHOTS}, asked AS (SELECT l_orderkey AS k, l_linenumber AS n, 'u' || l_orderkey AS url, l_linenumber + 2 AS version FROM lineitem) SELECT a.k, a.n, s.stav FROM asked a LEFT JOIN snaps s USING (url, version)")
def lines_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each line's order was listed as in the version that the line asks for."""
    asked = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.concat(F.lit("u"), F.col("l_orderkey").cast("string")).alias("url"), (F.col("l_linenumber") + 2).alias("version"))
    return history.as_of_each(_history(spark, sf_dir), asked, "version").select("k", "n", "stav")


# Records -------------------------------------------------------------------------------------------------------------

_DAMAGED = """t AS (SELECT event_id, event_type, CASE event_id % 8 WHEN 0 THEN left(props, length(props) - 2) WHEN 1 THEN '[1]' WHEN 2 THEN '{"k": "x"}' WHEN 3 THEN NULL WHEN 4 THEN '{"k": null, "more": [1]}' ELSE props END AS record FROM events)"""


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, props = F.col("event_id") % 8, F.col("props")
    text = F.when(kind == 0, F.expr("left(props, length(props) - 2)")).when(kind == 1, "[1]").when(kind == 2, '{"k": "x"}').when(kind == 4, '{"k": null, "more": [1]}').when(kind != 3, props)
    return table(spark, sf_dir, "events").select("event_id", "event_type", text.alias("text"))


@query(f"WITH {_DAMAGED} SELECT event_id, coalesce(CAST(json_extract(record, '$.k') AS BIGINT), -1) AS k FROM t WHERE event_id % 8 > 3")
def kept_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = records.parsed(_damaged(spark, sf_dir), "text", "k long").rows
    return found.select("event_id", F.coalesce("record.k", F.lit(-1).cast("long")).alias("k"))


@query(f"WITH {_DAMAGED} SELECT event_id, record AS text, (['no JSON', 'no object', 'field of another type', 'no record'])[CAST(event_id % 8 AS INT) + 1] AS fault FROM t WHERE event_id % 8 < 4")
def refused_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parsed(_damaged(spark, sf_dir), "text", "k long").refused.select("event_id", "text", "fault")


@query(
    f"""WITH {_DAMAGED}, o AS (SELECT * FROM t WHERE event_id % 8 NOT IN (0, 1, 3))
SELECT event_type, key, CASE json_type(record, '$.' || key) WHEN 'VARCHAR' THEN 'STRING' WHEN 'NULL' THEN 'VOID' WHEN 'ARRAY' THEN 'ARRAY<BIGINT>' ELSE 'BIGINT' END AS type, count(*) AS records
FROM (SELECT event_type, record, unnest(json_keys(record)) AS key FROM o) GROUP BY ALL"""
)
def record_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.drift(_damaged(spark, sf_dir), "text", "event_type")


_ENTRIES = """c AS (SELECT r_name AS kraj, n_name AS okres, c_mktsegment AS kategoria, c_name AS nazov, c_custkey AS k, c_custkey // 100 AS block FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested boards as JSON, one text per hundred customers; some documents, categories and districts are damaged."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    key = F.col("c_custkey")
    quoted = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    doc = F.when(key % 10 == 3, quoted('"text ', key, '"')).when(key % 10 == 7, quoted('{"nazov": "', F.col("c_name"), '", "url": " "}')).otherwise(quoted('{"datum": "d", "nazov": "', F.col("c_name"), '", "url": "u', key, '"}'))
    # Regions and nations are 5 and 25 rows at any scale.
    rows = c.join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"]).join(F.broadcast(r), n["n_regionkey"] == r["r_regionkey"])
    listed = lambda df, part, *group: df.groupBy("block", *group).agg(F.array_join(F.array_sort(F.collect_list(part)), ", ").alias("part"))
    docs = listed(rows.withColumn("block", F.floor(key / 100)), doc, "r_name", "n_name", "c_mktsegment")
    category = F.when((F.col("c_mktsegment") == "BUILDING") & (F.col("block") % 3 == 0), "17").otherwise(quoted('{"kategoria": "', F.col("c_mktsegment"), '", "dokumenty": [', F.col("part"), "]}"))
    categories = listed(docs, category, "r_name", "n_name")
    district = F.when((F.col("n_name") == "NATION_4") | (F.col("block") % 5 == 4), quoted('{"dokumenty_zivotne_prostredie": [', F.col("part"), "]}")).otherwise(quoted('{"nazov": "', F.col("n_name"), '", "dokumenty_zivotne_prostredie": [', F.col("part"), "]}"))
    districts = listed(categories, district, "r_name")
    regions = listed(districts, quoted('{"kraj": "', F.col("r_name"), '", "okresy": [', F.col("part"), "]}"))
    return regions.select(F.col("block").cast("string").alias("name"), quoted("[", F.col("part"), ", null]").alias("text"))


_STAYS = "block % 5 <> 4 AND okres <> 'NATION_4' AND NOT (kategoria = 'BUILDING' AND block % 3 = 0)"


@query(f"WITH {_ENTRIES} SELECT kraj, okres, kategoria AS doc_kategoria, nazov, CASE WHEN k % 10 = 7 THEN ' ' ELSE 'u' || k END AS url FROM c WHERE {_STAYS} AND k % 10 <> 3")
def kept_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.flat_boards(kept(_entries(spark, sf_dir))).rows.select("kraj", "okres", "doc_kategoria", "nazov", "url")


@query(
    f"""WITH {_ENTRIES}, named AS (SELECT * FROM c WHERE block % 5 <> 4 AND okres <> 'NATION_4')
SELECT CAST(block AS VARCHAR) AS name, fault, count(*) AS n FROM (
  SELECT DISTINCT block, 'region is no object' AS fault, 0 AS k, '' AS o FROM c
  UNION ALL SELECT DISTINCT block, 'district without a name', 0, okres FROM c WHERE block % 5 = 4 OR okres = 'NATION_4'
  UNION ALL SELECT DISTINCT block, 'category is no object', 0, okres FROM named WHERE kategoria = 'BUILDING' AND block % 3 = 0
  UNION ALL SELECT block, 'document is no object', k, okres FROM c WHERE {_STAYS} AND k % 10 = 3) GROUP BY ALL"""
)
def refused_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.flat_boards(kept(_entries(spark, sf_dir))).refused.groupBy("name", "fault").agg(F.count(F.lit(1)).alias("n"))


# Sketches ------------------------------------------------------------------------------------------------------------


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n, true AS near FROM events GROUP BY 1")
def sketch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users per level from stored sketches of each day, held against the exact count within the error bound."""
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    stored = kept(sketches.sketched(e, F.col("user_id"), "event_type", "day"))
    exact = e.groupBy("event_type").agg(F.count_distinct("user_id").alias("exact"))
    told = sketches.added(stored, "event_type").join(exact, "event_type")
    near = F.abs(sketches.different() - F.col("exact")) <= F.ceil(F.col("exact") * sketches.error_bound())
    return told.select("event_type", "n", near.alias("near"))


@query("WITH u AS (SELECT DISTINCT event_type, user_id FROM events) SELECT a.event_type AS a, b.event_type AS b, true AS near FROM u a JOIN u b ON a.user_id = b.user_id AND a.event_type < b.event_type GROUP BY ALL")
def sketch_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users that two levels share, from theta sketches, against the exact number. Levels are few at any scale."""
    e = table(spark, sf_dir, "events")
    told = kept(sketches.sketched(e, F.col("user_id"), "event_type"))
    users = e.select("event_type", "user_id").distinct()
    exact = users.withColumnRenamed("event_type", "a").join(users.withColumnRenamed("event_type", "b"), "user_id").filter("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("exact"))
    left, right = (told.select(F.col("event_type").alias(c), F.col("theta").alias(f"theta_{c}"), sketches.different().alias(f"users_{c}")) for c in "ab")
    pairs = exact.join(left, "a").join(right, "b")
    near = F.abs(sketches.shared("theta_a", "theta_b") - F.col("exact")) <= F.ceil((F.col("users_a") + F.col("users_b")) * sketches.error_bound())
    return pairs.select("a", "b", near.alias("near"))


# Indexes -------------------------------------------------------------------------------------------------------------


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'ring') AND contains(lower(p_type), 'l')")
def indexed_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``header_filter``, by the trigrams of the names."""
    rows = table(spark, sf_dir, "part")
    postings = kept(textindex.index(rows, "p_partkey", "p_name"))
    found = textindex.containing(rows, postings, textindex.sizes(postings), "p_partkey", "p_name", "RING")
    return present.matching(found, p_type="L").select("p_partkey", "p_name")


@query("SELECT row_number() OVER (ORDER BY l_shipdate DESC, l_orderkey, l_linenumber) AS rank, l_orderkey, l_linenumber FROM lineitem ORDER BY rank LIMIT 100 OFFSET 5800")
def deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page far down, from the two files at most that hold it."""
    folder = new_folder(spark, "ranked")
    rows = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber")
    rankindex.write(rows, [F.desc("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber")], folder, 5_000)
    return rankindex.page(spark, folder, 59).select("rank", "l_orderkey", "l_linenumber")


# Archives ------------------------------------------------------------------------------------------------------------


@query("SELECT conv_id, CASE WHEN turn % 2 = 1 THEN 'inner.zip/' ELSE '' END || 't' || turn || '.txt' AS member, coalesce(text, '') AS text, NULL::VARCHAR AS error FROM conversations")
def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation as an archive, its odd turns in an archive inside, unpacked in parts of 64 bytes and put together."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat(F.lit("t"), F.col("turn").cast("string"), F.lit(".txt")).alias("name"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("content"))
    inner = archives.zipped(turns.filter("turn % 2 = 1"), "name", "content", ["conv_id"]).select("conv_id", F.lit("inner.zip").alias("name"), F.col("body").alias("content"))
    outer = archives.zipped(turns.filter("turn % 2 = 0").select("conv_id", "name", "content").unionByName(inner), "name", "content", ["conv_id"])
    return archives.whole_texts(archives.members(outer, part=64), ["conv_id"])
