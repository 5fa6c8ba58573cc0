"""Commands on a project's folder. Parsers and responders are named as module:function."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import __version__
from .operators import export, library, search
from .pipeline import Pipeline
from .settings import load_settings


def _function(name: str | None):
    if name is None:
        return None
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def parser() -> argparse.ArgumentParser:
    own = argparse.ArgumentParser("docloom")
    own.add_argument("--config")
    for name in ("parser", "extract", "compose", "ocr"):
        own.add_argument(f"--{name}", dest=f"with_{name}")
    commands = own.add_subparsers(dest="command", required=True)
    for name in ("version", "ingest", "structure", "status", "topics", "schemas"):
        commands.add_parser(name)
    commands.add_parser("run").add_argument("--dry-run", action="store_true")
    commands.add_parser("show").add_argument("record_id")
    commands.add_parser("open").add_argument("record_id")
    commands.add_parser("failures").add_argument("--doc")
    found = commands.add_parser("search")
    found.add_argument("query")
    found.add_argument("--limit", type=int, default=20)
    out = commands.add_parser("export")
    out.add_argument("format", choices=("json", "csv", "html", "knowledge"))
    again = commands.add_parser("reprocess")
    again.add_argument("doc_id")
    again.add_argument("--from-stage", choices=("extract", "compose"), default="extract")
    review = commands.add_parser("review")
    review.add_argument("action", choices=("list", "show", "approve", "reject"))
    review.add_argument("review_id", nargs="?")
    return own


def run(p: Pipeline, a: argparse.Namespace) -> None:
    lib = p.library
    match a.command:
        case "run":
            out = p.run(a.dry_run)
            out.show(1000, False)
            print(p.write_report(out))
        case "ingest":
            p.run_ingest().show(1000, False)
        case "structure":
            p.run_structure().groupBy("doc_id").count().show(1000, False)
        case "status":
            library.documents_by_status(lib.read("documents")).show(1000, False)
            library.stage_summary(lib.read("stage_status")).show(1000, False)
        case "topics":
            library.topic_tree(lib.read("topics"), lib.read("records")).show(1000, False)
        case "schemas":
            print(p.schemas())
        case "show":
            library.record_of(lib.read("records"), a.record_id).show(1, False, True)
        case "open":
            where = lib.read("evidence").filter(F.col("record_id") == a.record_id)
            where.join(lib.read("documents"), "doc_id").select("source_path", "page_start", "page_end").show(1000, False)
        case "failures":
            library.failures(lib.read("stage_status"), a.doc).show(1000, False)
        case "search":
            held = lib.read("records")
            search.scan_search(held, "record_id", ("title", "search_text"), a.query, a.limit).join(held.select("record_id", "title"), "record_id").orderBy("score").show(a.limit, False)
        case "export":
            folder = p.settings.path("exports")
            if a.format == "json":
                export.export_library(lib.read("records"), lib.read("relations"), library.topic_tree(lib.read("topics"), lib.read("records")), folder)
            elif a.format == "csv":
                export.write_csv(export.overview(lib.read("records")), f"{folder}/overview.csv")
            elif a.format == "html":
                export.html_pages(p.knowledge(), f"{folder}/html")
            else:
                export.write_json_lines(p.knowledge(), f"{folder}/knowledge.jsonl")
        case "reprocess":
            p.reprocess(a.doc_id, a.from_stage)
        case "review" if a.action == "list":
            p.reviews().show(1000, False)
        case "review" if a.action == "show":
            p.reviews().filter(F.col("review_id") == a.review_id).show(1, False, True)
        case "review":
            p.decide(a.review_id, {"approve": "approved", "reject": "rejected"}[a.action])


def main(arguments: list[str] | None = None) -> None:
    a = parser().parse_args(arguments)
    if a.command == "version":
        print(__version__)
        return
    spark = SparkSession.builder.appName("docloom").getOrCreate()
    functions = {n: _function(getattr(a, f"with_{n}")) for n in ("parser", "extract", "compose", "ocr")}
    run(Pipeline(spark, load_settings(a.config), **functions), a)


if __name__ == "__main__":
    main()
