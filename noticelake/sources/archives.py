"""Archives as a table function: members come out one by one, in parts of bounded size, and from archives inside archives.

What a task holds is one archive's bytes and one part; no list of members, and no member larger than a part, is ever
built. Members that do not unpack are rows with their error, as are archives that are none, or lie too deep.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

#: Bytes of a part, and archives inside one another.
PART = 8_000_000
DEPTH = 4
MEMBER = "member: string, part: int, content: binary, error: string"


def _members(name: str, body, depth: int, part: int) -> Iterator[tuple]:
    try:
        archive = zipfile.ZipFile(body)
    except (zipfile.BadZipFile, TypeError, ValueError) as e:
        yield name or None, 0, None, f"{type(e).__name__}: {e}"
        return
    for info in archive.infolist():
        if info.is_dir():
            continue
        path = f"{name}/{info.filename}" if name else info.filename
        try:
            with archive.open(info) as data:
                if info.filename.lower().endswith(".zip"):
                    if depth <= 1:
                        yield path, 0, None, "archives too deep inside one another"
                    else:
                        # A member that is an archive must be read at any place, so it is unpacked as a whole.
                        yield from _members(path, io.BytesIO(data.read()), depth - 1, part)
                    continue
                number = 0
                while (block := data.read(part)) or not number:
                    yield path, number, block, None
                    number += 1
        except Exception as e:  # a broken member is its own row
            yield path, 0, None, f"{type(e).__name__}: {e}"


@udtf(returnType=MEMBER)
class _Unpack:
    def eval(self, body: bytes, part: int, depth: int) -> Iterator[tuple]:
        if body is None:
            yield None, 0, None, "no archive"
            return
        yield from _members("", io.BytesIO(body), depth, part)


def members(files: DataFrame, body: str = "body", part: int = PART, depth: int = DEPTH) -> DataFrame:
    """``files`` without ``body``, and a row for each part of each member: member (its path, through inner archives), part (from 0), content, error."""
    spark = files.sparkSession
    spark.udtf.register("unpacked_members", _Unpack)
    kept = [c for c in files.columns if c != body]
    view = "archives_to_unpack"
    files.createOrReplaceTempView(view)
    names = ", ".join(f"f.`{c}`" for c in kept)
    return spark.sql(f"SELECT {names}{', ' if names else ''}m.* FROM {view} f, LATERAL unpacked_members(f.`{body}`, {int(part)}, {int(depth)}) m")


def whole_texts(parts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, member, text, error: members put together from their parts, as UTF-8 text; for members that a row can hold."""
    listed = F.array_sort(F.collect_list(F.when(F.col("content").isNotNull(), F.struct("part", "content"))))
    joined = parts.groupBy(*keys, "member").agg(listed.alias("all"), F.max("error").alias("error"))
    body = F.aggregate("all", F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["content"]))
    return joined.select(*keys, "member", F.when(F.size("all") > 0, F.decode(body, "UTF-8")).alias("text"), "error")


def zipped(spark_rows: DataFrame, name: str, content: str, keys: list[str]) -> DataFrame:
    """keys, body: one ZIP per key of the rows' files; for keys whose files a row can hold."""

    @F.pandas_udf("binary")
    def pack(listed):
        import pandas as pd

        out = []
        for files in listed:
            data = io.BytesIO()
            with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
                for f in files:
                    z.writestr(zipfile.ZipInfo(f["name"], (2000, 1, 1, 0, 0, 0)), bytes(f["content"]), zipfile.ZIP_DEFLATED)
            out.append(data.getvalue())
        return pd.Series(out)

    listed = F.array_sort(F.collect_list(F.struct(F.col(name).alias("name"), F.col(content).alias("content"))))
    return spark_rows.groupBy(*keys).agg(listed.alias("all")).select(*keys, pack("all").alias("body"))
