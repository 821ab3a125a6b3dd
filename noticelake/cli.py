"""Commands: python -m noticelake.cli <command> ... Input and output are JSON array files.

Commands that fetch, convert or extract store each step under --work, a folder that all machines share, and take --tools, a Python module with ``fetcher`` (url to status, content type
and bytes), ``converters`` (noticelake.operators.convert.Converters) and ``extractor`` (text to model output).
"""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from noticelake.functions import dates
from noticelake.operators import convert, delta, nest, prompts, sample, schema, status
from noticelake.plans import pipelines
from noticelake.sources import files, html, records


def _write(rows, path: str | None, order: list[str]) -> None:
    if path:
        files.write_json_array(rows, path, order)
    else:
        # One array, row by row, so that the driver holds one partition at most.
        text = rows.orderBy(*order).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j"))
        print("[", end="")
        for k, r in enumerate(text.toLocalIterator()):
            print(",\n" if k else "\n", r["j"], sep="", end="")
        print("\n]")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="noticelake", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *options: str, about: str):
        p = sub.add_parser(name, help=about)
        for o in options:
            p.add_argument(f"--{o.rstrip('?')}", required=not o.endswith("?"))
        return p

    command("directory", "pages", "output?", about="regions and districts from saved menu pages")
    command("boards", "pages", "output?", about="documents from saved board pages")
    for name, about, first in (("scrape-boards", "documents of all districts' boards, fetched", "directory"), ("scrape-listing", "items of all pages of a list, fetched", "url")):
        command(name, first, "tools", "work", "output?", about=about)
    command("listing", "pages", "base", "output?", about="documents from saved list pages")
    command("nested-diff", "old", "new", "output?", about="boards with new documents only")
    command("diff", "old", "new", "output?", about="new items of a flat listing")
    merge = command("merge", "out", about="put the second listing into the first")
    merge.add_argument("--in", dest="inputs", action="append", required=True)
    command("sample", "input", "output", "n", "seed?", about="documents of boards drawn at random")
    command("dates", "input?", "output?", about="JSON with dates as yyyy-MM-dd; from standard input without --input")
    for name, about in (("process-boards", "text and analysis of the documents of boards"), ("process-listing", "place, text and analysis of listed items")):
        command(name, "input", "tools", "work", "store?", "status?", "run?", "output?", about=about).add_argument("--skip-analysis", action="store_true")
    command("pdf-text", "input", "tools", about="the text of a PDF file")
    command("prompt", "input", "store", "template", about="a prompt from sampled boards and stored texts")
    a = parser.parse_args(argv)
    if a.command == "merge" and len(a.inputs) != 2:
        parser.error("merge needs exactly two inputs")

    spark = SparkSession.builder.appName("noticelake").getOrCreate()
    pages = lambda: spark.read.text(a.pages, wholetext=True).select(F.col("_metadata.file_name").alias("page"), F.col("value").alias("html"))
    boards = lambda p: files.read_json_array(spark, p, schema.BOARD)
    listing = lambda p: files.read_json_array(spark, p, schema.LISTING)
    if a.command == "directory":
        _write(pages().select(F.inline(html.menu_tree("html"))), a.output, ["kraj"])
    elif a.command == "boards":
        docs, failed, linkless = html.board_documents(pages(), ["page"])
        for r in failed.unionByName(linkless.select("page", F.concat_ws(": ", "warning", "nazov").alias("error"))).toLocalIterator():
            print(f"{r['page']}: {r['error']}", file=sys.stderr)
        _write(docs, a.output, ["page", "place"])
    elif a.command == "listing":
        _write(html.listing(pages(), ["page"], a.base), a.output, ["page", "place"])
    elif a.command == "scrape-boards":
        tools = importlib.import_module(a.tools)
        found = pipelines.scrape_boards(files.read_json_array(spark, a.directory, schema.DIRECTORY), tools.fetcher, files.saver(a.work))
        _write(found, a.output, ["kraj"])
    elif a.command == "scrape-listing":
        tools = importlib.import_module(a.tools)
        first = spark.createDataFrame([(a.url,)], "url string")
        _write(pipelines.crawl_listing(first, tools.fetcher, files.saver(a.work), a.url), a.output, ["datum", "url", "nazov"])
    elif a.command == "nested-diff":
        _write(delta.new_on_boards(boards(a.new), files.read_json_array(spark, a.old, schema.BOARD, lenient=True)), a.output, ["kraj"])
    elif a.command == "diff":
        _write(delta.new_items(listing(a.new), files.read_json_array(spark, a.old, schema.LISTING, lenient=True)), a.output, ["url"])
    elif a.command == "merge":
        left, right = (files.read_json_maps(spark, p) for p in a.inputs)
        files.write_json_array(delta.merge_maps(left, right), a.out, ["part", "ord"], "m")
    elif a.command == "sample":
        _write(sample.sample_boards(boards(a.input), int(a.n), int(a.seed or 0)), a.output, ["kraj"])
    elif a.command == "dates":
        if a.input:
            _write(nest.with_iso_dates(boards(a.input)), a.output, ["kraj"])
        else:
            text = sys.stdin.read()
            if not text.strip():
                print("no input", file=sys.stderr)
                return 1
            print(spark.createDataFrame([(text,)], "t string").select(dates.json_dates("t", F.lit("datum"))).first()[0])
    elif a.command in ("process-boards", "process-listing"):
        tools = importlib.import_module(a.tools)
        source, run_id, save = ("minv" if a.command == "process-boards" else "minzp"), int(a.run or 1), files.saver(a.work)
        if faults := files.input_faults(spark, a.input):
            for level, text in faults:
                print(f"{level}: {text}", file=sys.stderr)
            if a.status:
                rows = spark.createDataFrame(faults, "level string, text string")
                status.append(status.entries(rows, F.col("level"), F.col("text"), F.current_timestamp(), run_id, source), a.status, "input")
            return 1
        # Entries that cannot be read are skipped and named; the rest is processed.
        entries = records.flat_boards(records.json_texts(spark, a.input)) if a.command == "process-boards" else records.read_json_entries(spark, a.input, schema.LISTING)
        skipped = save(records.warnings(entries.refused), f"skipped-{run_id}")
        for r in skipped.limit(20).collect():
            print(f"{r['level']}: {r['text']}", file=sys.stderr)
        if a.status:
            status.append(status.entries(skipped, F.col("level"), F.col("text"), F.current_timestamp(), run_id, source), a.status, "entries")
        if a.command == "process-boards":
            before = files.read_if_there(spark, f"{a.work}/results", f"{pipelines.RESULTS}, run long")
            newest = before.withColumn("n", F.row_number().over(Window.partitionBy("url").orderBy(F.desc("run")))).filter("n = 1 AND body IS NOT NULL").drop("n", "run")
            done = pipelines.process_documents(entries.rows, tools.fetcher, tools.converters, tools.extractor, save, newest, a.skip_analysis, prompts.extraction)
            done = save(done, f"done-{run_id}")
            kept = done.filter("doc_id IS NOT NULL").select(*StructType.fromDDL(pipelines.RESULTS).names).dropDuplicates(["url"])
            kept.write.mode("overwrite").parquet(f"{a.work}/results/run={run_id}")
        else:
            done = save(pipelines.process_listing(entries.rows, tools.fetcher, tools.extractor, save, a.skip_analysis, prompts.extraction), f"done-{run_id}")
        if a.store:
            files.append_store(files.stored_files(done, source, "text.txt" if source == "minv" else "text.md"), a.store, run_id)
        if a.status:
            status.append(pipelines.status_of(done, F.current_timestamp(), run_id, source, a.skip_analysis), a.status)
        _write(done.drop("body"), a.output, ["url"])
    elif a.command == "pdf-text":
        tools = importlib.import_module(a.tools)
        pdf = spark.read.format("binaryFile").load(a.input).select(F.lit("a.pdf").alias("file_name"), "content")
        row = convert.file_texts(pdf, tools.converters).first()
        print(row["text"] if row["convert_error"] is None else row["convert_error"], file=sys.stdout if row["convert_error"] is None else sys.stderr)
        return int(row["convert_error"] is not None)
    elif a.command == "prompt":
        from noticelake.functions.urls import doc_id

        docs = nest.flatten(boards(a.input)).withColumn("doc_id", doc_id(F.col("url")))
        found, missing = prompts.examples(docs, files.read_store(spark, a.store))
        for r in missing.toLocalIterator():
            print(f"no text: {r['url']}", file=sys.stderr)
        with open(a.template, encoding="utf-8") as f:
            row = prompts.prompt(found, f.read()).first()
        if row is None:
            return 1
        print(row["prompt"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
