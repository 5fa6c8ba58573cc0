"""Files: the inbox, JSON stage files, and parsers of documents into pages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import content_id
from ..functions.text import needs_ocr, usable_tables

LINE = "array<struct<text:string,size:double,bold:boolean,y:double>>"
PAGE = f"doc_id string, page int, text string, is_ocr boolean, lines {LINE}, tables array<array<array<string>>>, image_share double"


def scan_inbox(spark: SparkSession, path: str, suffix: str = ".pdf") -> DataFrame:
    """path, filename, doc_id, length, content of the files below a folder, names that start with a dot left out; files with the same bytes once, under the
    first path; in no order."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    wanted = F.lower("filename").endswith(suffix) & ~F.col("filename").startswith(".")
    named = files.withColumn("filename", F.element_at(F.split("path", "/"), -1)).filter(wanted)
    # bytes are hashed where they are read; only paths and ids are grouped, and the bytes are read again where they are needed
    hashed = named.select("path", content_id(F.col("content")).alias("doc_id"))
    first = hashed.groupBy("doc_id").agg(F.min("path").alias("path"))
    return named.join(first, "path").select("path", "filename", "doc_id", "length", "content")


def dealt(table: DataFrame) -> DataFrame:
    """A scan with fewer splits than the session has cores, as of one small file, dealt out to all of them; any other as it is."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


def read_json_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines of a known schema; blank lines are skipped, rows that don't fit are kept in _corrupt_record where the schema has it."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


class UnreadableFile(ValueError):
    """For parsers to raise: kind is "corrupt", "encrypted" or "empty"."""

    def __init__(self, kind: str, message: str = ""):
        super().__init__(f"{kind}: {message}" if message else kind)


def lines_of_spans(spans: DataFrame) -> DataFrame:
    """spans: doc_id, page, line_idx, span_idx, text, size, font, flags, top, page_height. Lines as page_lines gives them: the spans' text joined, the
    largest size of a span that isn't blank, bold where all of these are (by flag 16 or the font's name), and the line's place on the page."""
    full = F.trim("text") != ""
    bold = (F.col("flags").bitwiseAND(F.lit(16)) != 0) | F.contains(F.lower("font"), F.lit("bold"))
    text = F.trim(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("span_idx", "text"))), lambda x: x["text"]), ""))
    own = spans.groupBy("doc_id", "page", "line_idx").agg(
        text.alias("text"), F.bround(F.max(F.when(full, F.col("size"))), 1).alias("size"), F.min(F.when(full, bold)).alias("bold"), F.bround(F.min(F.col("top") / F.col("page_height")), 3).alias("y")
    )
    return own.filter("size is not null")


def read_scans(pages: DataFrame, reader: Callable[[bytes], str], min_chars: int = 50, min_share: float = 0.3) -> DataFrame:
    """pages whose text is read from their image (a column `image`, where a parser gives one) if they have hardly any and an image covers them. reader may
    raise; such a page stays as it is and is marked in ocr_failed."""
    if "image" not in pages.columns:
        return pages
    wanted = needs_ocr(F.col("text"), F.col("image_share"), min_chars, min_share) & F.col("image").isNotNull()
    schema = T.StructType([f for f in pages.schema.fields if f.name != "image"] + [T.StructField("ocr_failed", T.BooleanType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            read, failed = [], []
            for image in frame["image"]:
                try:
                    read.append(reader(bytes(image)))
                except Exception:  # noqa: BLE001  a page that can't be read is that page's fault
                    read.append(None)
                failed.append(read[-1] is None)
            yield frame.assign(text=[t if r is None else r for t, r in zip(frame["text"], read, strict=True)], is_ocr=[not f for f in failed], ocr_failed=failed)[schema.names]

    scans = pages.filter(wanted).mapInPandas(run, schema)
    return scans.unionByName(pages.filter(~F.coalesce(wanted, F.lit(False))).drop("image").withColumn("ocr_failed", F.lit(False)))


def quarantine(bad: DataFrame, folder: str) -> int:
    """Moves unreadable files (path, filename, error) out of the inbox, each with a note of its error beside it; copies those that can't be moved. For the
    few files of a run, one at a time on the driver, through Hadoop's file systems. Number of files."""
    sc = bad.sparkSession.sparkContext
    fs, conf, n = sc._jvm.org.apache.hadoop.fs, sc._jsc.hadoopConfiguration(), 0
    for n, row in enumerate(bad.select("path", "filename", "error").toLocalIterator(), 1):
        source, target = fs.Path(row.path), fs.Path(f"{folder}/{row.filename}")
        here, there = source.getFileSystem(conf), target.getFileSystem(conf)
        there.mkdirs(target.getParent())
        note = row.error
        if not fs.FileUtil.copy(here, source, there, target, True, conf):
            fs.FileUtil.copy(here, source, there, target, False, conf)
            note += "\n(the original couldn't be moved out of the inbox)"
        stream = there.create(fs.Path(f"{folder}/{row.filename}.error.txt"), True)
        stream.write(bytearray(note.encode()))
        stream.close()
    return n


def parse_documents(files: DataFrame, parser: Callable[[bytes], list[dict]]) -> tuple[DataFrame, DataFrame]:
    """(pages, quarantined). parser turns a file's bytes into page dicts (text, lines, tables, image_share) and may raise: the error becomes
    a quarantine row (path, filename, error), never a failed task."""
    kinds = T.StructType.fromDDL(PAGE + ", path string, filename string, error string")
    names = kinds.names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for f in frame.itertuples():
                try:
                    pages = parser(bytes(f.content))
                    if not pages:
                        raise ValueError("no pages")
                    rows += [{"doc_id": f.doc_id, "page": i, "is_ocr": False, **p, "path": f.path, "filename": f.filename, "error": None} for i, p in enumerate(pages, 1)]
                except Exception as e:  # noqa: BLE001  any fault of a file is that file's
                    rows.append({"doc_id": f.doc_id, "path": f.path, "filename": f.filename, "error": f"{type(e).__name__}: {e}"})
            yield pd.DataFrame([{n: r.get(n) for n in names} for r in rows], columns=names, dtype=object)

    parsed = files.select("doc_id", "path", "filename", "content").mapInPandas(run, kinds)
    pages = parsed.filter("error is null").drop("path", "filename", "error").withColumn("tables", usable_tables(F.col("tables")))
    return pages, parsed.filter("error is not null").select("doc_id", "path", "filename", "error")


def page_lines(pages: DataFrame) -> DataFrame:
    """doc_id, page, line_idx, text, size, bold, y: one row per line."""
    return pages.select("doc_id", "page", F.posexplode("lines").alias("line_idx", "l")).select("doc_id", "page", "line_idx", "l.*")
