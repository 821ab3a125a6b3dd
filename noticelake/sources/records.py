"""Records that may be malformed: those that can be read, those that cannot with the reason, and how records differ."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CORRUPT = "_corrupt"


class Records(NamedTuple):
    """rows: what was read. refused: place, text and fault of what was not."""

    rows: DataFrame
    refused: DataFrame


def parsed(rows: DataFrame, text: str, schema: str) -> Records:
    """``rows`` with the JSON object of the column ``text`` as the struct ``record``; others are refused with a fault.

    A record that is no JSON, no object, or has a field of another type than the schema's is refused; fields that are
    absent are null, and others are ignored.
    """
    variant = F.try_parse_json(text)
    record = F.from_json(text, f"{schema}, {_CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    told = rows.withColumns({"_variant": variant, "record": record})
    kind = F.schema_of_variant("_variant")
    fault = F.when(F.col(text).isNull(), "no record").when(F.col("_variant").isNull(), "no JSON").when(~kind.startswith("OBJECT"), "no object").when(F.col(f"record.{_CORRUPT}").isNotNull(), "field of another type")
    told = told.withColumn("fault", fault)
    good = told.filter("fault IS NULL").withColumn("record", F.col("record").dropFields(_CORRUPT)).drop("_variant", "fault")
    return Records(good, told.filter("fault IS NOT NULL").drop("_variant", "record"))


def read_json_entries(spark: SparkSession, path: str, schema: str) -> Records:
    """The entries of JSON array files, one by one: an entry that is no object of the schema is refused, and no other.

    rows have the schema's columns; refused: name (of the file), place, text, fault. A file that is no array is one refused row.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"), F.try_parse_json("value").alias("v"))
    is_list = F.coalesce(F.schema_of_variant("v").startswith("ARRAY"), F.lit(False))
    whole = files.filter(~is_list).select("name", F.lit(None).cast("int").alias("place"), "text", F.when(F.col("v").isNull(), "no JSON").otherwise("no list").alias("fault"))
    entries = files.filter(is_list).select("name", "v").lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("name", F.col("pos").alias("place"), F.to_json("value").alias("text"))
    rows, refused = parsed(entries, "text", schema)
    return Records(rows.select("record.*"), refused.select("name", "place", "text", "fault").unionByName(whole))


def warnings(refused: DataFrame, what: str = "entry") -> DataFrame:
    """Status levels and texts for refused records: level, text."""
    return refused.select(F.lit("warning").alias("level"), F.concat_ws(" ", F.lit("skipped"), F.lit(what), F.col("place").cast("string"), F.concat(F.lit("("), "fault", F.lit(")"))).alias("text"))


def drift(rows: DataFrame, text: str, *group: str) -> DataFrame:
    """How records differ: group, key, type, records (that have the key with that type), of all objects."""
    objects = rows.select(*group, F.try_parse_json(text).alias("_v")).filter(F.schema_of_variant("_v").startswith("OBJECT"))
    fields = objects.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    return fields.groupBy(*group, "key", F.schema_of_variant("value").alias("type")).agg(F.count(F.lit(1)).alias("records"))


def common_schema(text: Column) -> Column:
    """An aggregate: the schema that all records share, in Spark's notation for variants."""
    return F.schema_of_variant_agg(F.try_parse_json(text))


def json_texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole files: name, text."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))


def _level(rows: DataFrame, of: str, keep: list[str], what: str) -> tuple[DataFrame, DataFrame]:
    """The objects in the list ``of`` (a variant) as ``v``, with ``keep`` and ``place`` (the path to each), and the entries that are none."""
    there = rows.filter(F.col(of).isNotNull())
    kind = F.schema_of_variant(of)
    faulty = lambda df, fault, value, place: df.select("name", place.alias("place"), F.to_json(value).alias("text"), F.lit(fault).alias("fault"))
    lists, others = there.filter(kind.startswith("ARRAY")), there.filter(~kind.startswith("ARRAY") & (kind != "VOID"))
    each = lists.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col(of).outer()))
    each = each.withColumn("place", F.concat_ws("/", "place", F.col("pos").cast("string")))
    is_object = F.schema_of_variant("value").startswith("OBJECT")
    refused = faulty(each.filter(~is_object), f"{what} is no object", F.col("value"), F.col("place")).unionByName(faulty(others, f"{what}s are no list", F.col(of), F.col("place")))
    return each.filter(is_object).select("name", *keep, "place", F.col("value").alias("v")), refused


def _text(name: str) -> Column:
    return F.try_variant_get("v", f"$.{name}", "string")


def flat_boards(texts: DataFrame) -> Records:
    """``texts``: name, text; nested boards as JSON. rows: the documents with their region, district and category; refused: name, place, text, fault.

    On every level an entry that is no object is skipped and named, and what is beside it stays; regions, districts and
    categories without a name are skipped too. Documents without a URL stay, as they become error rows later. ``place``
    is the path of numbers to an entry.
    """
    parsed_ = texts.select("name", "text", F.try_parse_json("text").alias("all"), F.lit(None).cast("string").alias("place"))
    broken = parsed_.filter("all IS NULL").select("name", F.lit("").alias("place"), "text", F.lit("no JSON").alias("fault"))
    found, refused = parsed_, [broken]
    keep: list[str] = []
    of = "all"
    steps = (("region", {"kraj": "kraj", "kraj_url": "url"}, "okresy"), ("district", {"okres": "nazov", "okres_url": "url", "okres_url_tabule": "url_tabule"}, "dokumenty_zivotne_prostredie"), ("category", {"doc_kategoria": "kategoria"}, "dokumenty"))
    for what, columns, below in steps:
        found, bad = _level(found, of, keep, what)
        refused.append(bad)
        found = found.select("name", *keep, "place", "v", *(_text(field).alias(c) for c, field in columns.items()))
        named = next(iter(columns))
        refused.append(found.filter(F.col(named).isNull()).select("name", "place", F.to_json("v").alias("text"), F.lit(f"{what} without a name").alias("fault")))
        keep += columns
        found = found.filter(F.col(named).isNotNull()).withColumn("below", F.try_variant_get("v", f"$.{below}", "variant")).drop("v")
        of = "below"
    found, bad = _level(found, of, keep, "document")
    found = found.select("name", *keep, "place", "v", *(_text(c).alias(c) for c in ("datum", "nazov", "url")))
    refused.append(bad)
    every = refused[0]
    for r in refused[1:]:
        every = every.unionByName(r)
    return Records(found.select(*keep, "datum", "nazov", "url"), every)
