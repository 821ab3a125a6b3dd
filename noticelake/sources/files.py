"""Files in: JSON arrays, the tree of stored documents, archives. Files out: JSON arrays and rotated snapshots."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.functions.arrow import arrow
from noticelake.functions.text import strict_json, strip
from noticelake.operators.membership import FILTER, MOST_BLOCKS, filter_of, merged
from noticelake.operators.schema import STORED
from noticelake.sources.stored import open_store


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, with no rows where there is no such path; any other fault of the read is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_json_array(spark: SparkSession, path: str, schema: str, lenient: bool = False) -> DataFrame:
    """Rows of a JSON array file. The schema is required; a file that is no array fails the read rather than lose rows.

    With ``lenient``, valid JSON that is no array counts as an empty one.
    """
    faults = input_faults(spark, path)
    if lenient and faults and all(level == "error" for level, _ in faults):
        return spark.createDataFrame([], schema)
    if faults:
        raise ValueError("; ".join(text for _, text in faults))
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_json_text(spark: SparkSession, text: str, schema: str) -> DataFrame:
    """Rows of a JSON array given as text, as from standard input; empty text is an error."""
    if not text.strip():
        raise ValueError("no input")
    one = spark.createDataFrame([(text,)], "t string")
    return one.select(F.inline(F.from_json("t", f"array<struct<{schema}>>", {"mode": "FAILFAST"})))


def input_faults(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """What is wrong with an input file as a whole: (level, text) entries; none if it can be read as an array."""
    try:
        files = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return [("critical", f"input {path} is missing")]
    text = strip(F.col("value"))
    told = files.select(F.col("_metadata.file_name").alias("name"), F.substring(text, 1, 1).alias("first"), strict_json(text)["error"].alias("error"))
    wrong = told.filter("error IS NOT NULL OR first <> '['").orderBy("name").limit(10).collect()
    if not wrong and files.isEmpty():
        return [("critical", f"input {path} is empty")]
    return [("error", f"input {r['name']} is not a list") if r["error"] is None else ("critical", f"input {r['name']} is empty" if not r["first"] else f"input {r['name']} is no JSON: {r['error']}") for r in wrong]


def read_store(spark: SparkSession, root: str, pattern: str = "*.{json,txt,md}") -> DataFrame:
    """The tree <root>/<source>/docs/<region>/<district>[/<id>]/<file> as rows of source, kraj, okres, doc_id, file_name, content."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root, wholetext=True)
    path = F.try_url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
    part = lambda k: F.nullif(F.regexp_extract("path", r"/([^/]+)/docs/([^/]+)/([^/]+)/(?:([^/]+)/)?([^/]+)$", k), F.lit(""))
    rows = files.select(F.col("value").alias("content"), path.alias("path"))
    return rows.select(part(1).alias("source"), part(2).alias("kraj"), part(3).alias("okres"), part(4).alias("doc_id"), part(5).alias("file_name"), "content")


@arrow("array<struct<member:string,content:binary,error:string>>")
def archive_members(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The files of a ZIP by full path; a broken archive is one row with its error, a broken member likewise."""

    def members(data):
        try:
            z = zipfile.ZipFile(io.BytesIO(bytes(data)))
        except (zipfile.BadZipFile, TypeError) as e:
            return [{"member": None, "content": None, "error": f"{type(e).__name__}: {e}"}]
        out = []
        for info in sorted(z.infolist(), key=lambda i: i.filename):
            if info.is_dir():
                continue
            try:
                out.append({"member": info.filename, "content": z.read(info), "error": None})
            except Exception as e:
                out.append({"member": info.filename, "content": None, "error": f"{type(e).__name__}: {e}"})
        return out

    for batch in batches:
        yield pd.Series([members(x) for x in batch], dtype=object)


def unpacked(files: DataFrame) -> DataFrame:
    """``files``: file_name, body and others. ZIP files become a row per member (member, content, error); RAR files one with an error; others one of themselves."""
    suffix = F.lower(F.regexp_extract("file_name", r"(\.[^.]+)$", 1))
    itself = F.array(F.struct(F.lit(None).cast("string").alias("member"), F.col("body").alias("content"), F.lit(None).cast("string").alias("error")))
    refused = F.array(F.struct(F.lit(None).cast("string").alias("member"), F.lit(None).cast("binary").alias("content"), F.lit("RAR archives are not supported").alias("error")))
    out = [c for c in files.columns if c != "body"]
    split = lambda df, parts: df.select(*out, F.inline(parts))
    zips, rars = files.filter(suffix == ".zip"), files.filter(suffix == ".rar")
    return split(zips, archive_members("body")).unionByName(split(rars, refused)).unionByName(split(files.filter(~F.coalesce(suffix.isin(".zip", ".rar"), F.lit(False))), itself))


def read_json_maps(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a JSON array of flat objects as ord, m (map<string,string>): an absent key stays apart from a null one."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.posexplode(F.from_json("value", "array<map<string,string>>", {"mode": "FAILFAST"})).alias("ord", "m")).select(F.col("ord").cast("long"), "m")


def write_json_array(rows: DataFrame, path: str, order: list[str], value: str | None = None) -> None:
    """A single JSON array file for reports, of the rows or of one column, in the given order. For results that one task can hold; tables stay Parquet."""
    item = F.struct(F.struct(*order).alias("o"), (F.col(value) if value else F.struct(*rows.columns)).alias("r"))
    by_order = lambda a, b: F.when(a["o"] < b["o"], -1).when(a["o"] > b["o"], 1).otherwise(0)
    ordered = F.transform(F.array_sort(F.collect_list(item), by_order), lambda x: x["r"])
    rows.agg(F.to_json(ordered, {"pretty": "true", "ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_json_file(rows: DataFrame, path: str, order: list[str], value: str | None = None) -> None:
    """A JSON array as one file, of any size, for a file system that all machines mount: each task writes its entries at their place in it.

    The entries are first written in order as parts; their sizes tell every part's place. No machine holds or passes on
    the whole. The file is replaced when the new one is complete.
    """
    from pyarrow import fs

    store, where = open_store(path)
    if store.type_name != "local":
        raise ValueError(f"{path}: parts can be written into one file on a mounted file system only; write_json_array makes a folder elsewhere")
    item = F.to_json(F.col(value) if value else F.struct(*rows.columns), {"pretty": "true", "ignoreNullFields": "false"})
    # Entries are indented as those of a list, each with its comma; the last one's is left out.
    text = F.concat(F.lit("  "), F.replace(item, F.lit("\n"), F.lit("\n  ")))
    parts, target = f"{where}-parts-{uuid.uuid4().hex}", f"{where}-{uuid.uuid4().hex}.new"
    ranged = rows.select(*order, text.alias("_text")).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.select(F.concat(F.col("_text"), F.lit(",")).alias("value")).write.text(f"file://{parts}")
    listed = sorted((f.path, f.size) for f in store.get_file_info(fs.FileSelector(parts)) if f.base_name.startswith("part-") and f.size)
    places, at = [], 2
    for k, (name, size) in enumerate(listed):
        size -= 2 if k + 1 == len(listed) else 0
        places.append((name, size, at))
        at += size
    with store.open_output_stream(target) as out:
        out.write(b"[\n" if places else b"[]")

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, size, begin in batch.itertuples(index=False):
                with open(name, "rb") as part, open(target, "r+b") as out:
                    out.seek(begin)
                    while block := part.read(min(size, 1 << 22)):
                        size -= len(block)
                        out.write(block)
            yield batch[["name"]]

    spark = rows.sparkSession
    if places:
        spark.createDataFrame(places, "name string, size long, begin long").repartition(len(places), "begin").mapInPandas(put, "name string").count()
    with open(target, "r+b") as out:
        out.seek(at)
        out.write(b"\n]\n" if places else b"\n")
    store.move(target, where)
    store.delete_dir(parts)


def saver(root: str) -> Callable[[DataFrame, str], DataFrame]:
    """Stores a step's rows under a folder and returns them read back, so that the step runs once."""

    def save(rows: DataFrame, name: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{root}/{name}")
        return rows.sparkSession.read.schema(rows.schema).parquet(f"{root}/{name}")

    return save


def stored_files(done: DataFrame, source: str, text_name: str = "text.txt") -> DataFrame:
    """``done``: kraj, okres, doc_id, text, analysis_raw, analysis. A row for each file that the store keeps of a document."""
    names = ((text_name, "text"), ("analysis.txt", "analysis_raw"), ("analysis.json", "analysis"))
    listed = F.array(*(F.struct(F.lit(n).alias("file_name"), F.col(c).alias("content")) for n, c in names))
    rows = done.filter("doc_id IS NOT NULL").select(F.lit(source).alias("source"), "kraj", "okres", "doc_id", F.inline(listed)).filter("content IS NOT NULL")
    return rows.dropDuplicates(["kraj", "okres", "doc_id", "file_name"])


def append_store(rows: DataFrame, path: str, run_id: int) -> None:
    """Stored files of a run added to the store's table, which keeps those of earlier runs."""
    rows.write.mode("overwrite").parquet(f"{path}/run={run_id}")


def latest_stored(spark: SparkSession, path: str) -> DataFrame:
    """The store's table with the latest version of each file."""
    rows = read_if_there(spark, path, f"{STORED}, run long")
    key = ["source", "kraj", "okres", "doc_id", "file_name"]
    return rows.groupBy(*key).agg(F.max_by("content", "run").alias("content"))


def write_snapshot(rows: DataFrame, root: str, version: str, key: str | None = None, blocks: int = MOST_BLOCKS) -> None:
    """A snapshot beside the earlier ones, whole or not at all. With ``key``, the filter of its keys is stored beside them."""
    rows.write.mode("overwrite").parquet(f"{root}/snapshot={version}")
    if key is not None:
        stored = rows.sparkSession.read.schema(rows.schema).parquet(f"{root}/snapshot={version}")
        filter_of(stored, F.col(key), blocks=blocks).write.mode("overwrite").parquet(f"{root}-keys/snapshot={version}")


def read_key_filter(spark: SparkSession, root: str, versions: list[str] | None = None) -> DataFrame:
    """The filter of the keys of all stored snapshots, or of those named."""
    rows = read_if_there(spark, f"{root}-keys", f"{FILTER}, snapshot string")
    if versions is not None:
        rows = rows.filter(F.col("snapshot").cast("string").isin(*versions))
    return merged(rows.select("block", "blocks", "bits"))


def read_snapshots(spark: SparkSession, root: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """The two latest snapshots (current, previous); an absent one has no rows."""
    every = read_if_there(spark, root, f"{schema}, snapshot string")
    versions = [r[0] for r in every.select(F.col("snapshot").cast("string")).distinct().orderBy(F.desc("snapshot")).limit(2).collect()]
    at = lambda k: every.filter(F.col("snapshot").cast("string") == versions[k]).drop("snapshot") if k < len(versions) else spark.createDataFrame([], schema)
    return at(0), at(1)
