"""The test tables in the roles of the boards: region, district (nation), category (segment), document (customer)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2025-12-31"
OLDEST = "2025-03-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat documents of boards. ``fresh``: not in the last snapshot."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    key = F.col("c_custkey")
    name = key.cast("string")
    url = (
        F.when(key % 4 == 0, F.concat(F.lit("https://example.com/get?x=1&subor=A%20"), name))
        .when(key % 4 == 1, F.concat(F.lit("https://www.minzp.sk/ou/file-"), name, F.lit(".html")))
        .when(key % 4 == 2, F.concat(F.lit("https://example.com/d/OU-"), name, F.lit(".pdf")))
        .otherwise(F.concat(F.lit("https://example.com/d/"), name))
    )
    # Regions and nations are 5 and 25 rows at any scale.
    rows = c.join(F.broadcast(n.join(r, n["n_regionkey"] == r["r_regionkey"])), c["c_nationkey"] == n["n_nationkey"])
    return rows.select(
        F.col("r_name").alias("kraj"),
        F.concat(F.lit("/r/"), F.col("r_regionkey").cast("string")).alias("kraj_url"),
        F.col("n_name").alias("okres"),
        F.concat(F.lit("/n/"), F.col("n_nationkey").cast("string")).alias("okres_url"),
        F.concat(F.lit("/b/"), F.col("n_nationkey").cast("string")).alias("okres_url_tabule"),
        F.col("c_mktsegment").alias("doc_kategoria"),
        F.date_format(F.date_add(F.lit("2025-01-01").cast("date"), (key % 400).cast("int")), "yyyy-MM-dd").alias("datum"),
        F.col("c_name").alias("nazov"),
        url.alias("url"),
        (key % 5 == 0).alias("fresh"),
        key.alias("place"),
    )


DOCUMENTS = """docs AS (SELECT r_name AS kraj, '/r/' || r_regionkey AS kraj_url, n_name AS okres, '/n/' || n_nationkey AS okres_url, '/b/' || n_nationkey AS okres_url_tabule,
  c_mktsegment AS doc_kategoria, strftime(DATE '2025-01-01' + CAST(c_custkey % 400 AS INTEGER), '%Y-%m-%d') AS datum, c_name AS nazov,
  CASE c_custkey % 4 WHEN 0 THEN 'https://example.com/get?x=1&subor=A%20' || c_custkey WHEN 1 THEN 'https://www.minzp.sk/ou/file-' || c_custkey || '.html'
    WHEN 2 THEN 'https://example.com/d/OU-' || c_custkey || '.pdf' ELSE 'https://example.com/d/' || c_custkey END AS url,
  c_custkey % 5 = 0 AS fresh, c_custkey AS place
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


#: Documents of a board row, at most.
SHARE = 1000


def boards(rows: DataFrame) -> DataFrame:
    """Nested boards of flat rows, in no order, in pieces: a row is a region with one district, one category and at most SHARE documents."""
    share = F.floor(F.col("place") / SHARE).alias("share")
    keys = ["kraj", "kraj_url", "okres", "okres_url", "okres_url_tabule", "doc_kategoria"]
    pieces = rows.groupBy(*keys, share).agg(F.collect_list(F.struct("datum", "nazov", "url")).alias("dokumenty"))
    kategoria = F.struct(F.col("doc_kategoria").alias("kategoria"), "dokumenty")
    okres = F.struct(F.col("okres").alias("nazov"), F.col("okres_url").alias("url"), F.col("okres_url_tabule").alias("url_tabule"), F.array(kategoria).alias("dokumenty_zivotne_prostredie"))
    return pieces.select("kraj", F.array(okres).alias("okresy"), F.col("kraj_url").alias("url"))
