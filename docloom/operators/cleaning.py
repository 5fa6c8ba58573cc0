"""Layout cleaning of page lines: running headers, footers, page numbers, broken words.

lines: doc_id, page, line_idx, text, y (0 top to 1 bottom) and any other columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_edge, is_page_number, signature, strip, tidy

REPEAT_SHARE = 0.3


def repeated_edges(lines: DataFrame, share: float = REPEAT_SHARE) -> DataFrame:
    """doc_id, signature, pages: edge lines that stand on enough of the document's pages (at least two, and `share` of them)."""
    pages = lines.groupBy("doc_id").agg(F.countDistinct("page").alias("n_pages")).filter("n_pages > 1")
    edges = lines.filter(is_edge(F.col("y")) & (strip(F.col("text")) != "")).select("doc_id", "page", signature(F.col("text")).alias("signature"))
    counts = edges.distinct().groupBy("doc_id", "signature").agg(F.count("*").alias("pages"))
    enough = F.col("pages") >= F.greatest(F.lit(2), F.floor(F.col("n_pages") * share))
    return counts.join(pages, "doc_id").filter(enough).select("doc_id", "signature", "pages")


def clean_lines(lines: DataFrame, repeated: DataFrame) -> DataFrame:
    """The lines without page numbers and repeated lines at page edges. Lines of the body always stay."""
    own = lines.withColumn("signature", F.when(is_edge(F.col("y")), signature(F.col("text"))))
    own = own.filter(~F.coalesce(is_edge(F.col("y")) & is_page_number(F.col("text")), F.lit(False)))
    return own.join(repeated.select("doc_id", "signature"), ["doc_id", "signature"], "left_anti").drop("signature")


def page_texts(lines: DataFrame) -> DataFrame:
    """doc_id, page, text, char_count: each page's lines in order, tidied."""
    ordered = F.array_sort(F.collect_list(F.struct("line_idx", "text")))
    joined = lines.groupBy("doc_id", "page").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "\n").alias("text"))
    return joined.withColumn("text", tidy(F.col("text"))).withColumn("char_count", F.length("text"))


def clean_pages(lines: DataFrame, share: float = REPEAT_SHARE) -> DataFrame:
    """page_texts of the cleaned lines; pages that lose every line stay, empty."""
    texts = page_texts(clean_lines(lines, repeated_edges(lines, share)))
    pages = lines.select("doc_id", "page").distinct()
    return pages.join(texts, ["doc_id", "page"], "left").fillna({"text": "", "char_count": 0})


def ingest_report(pages: DataFrame, low: float = 0.6) -> DataFrame:
    """pages: doc_id, page, text, is_ocr, ocr_failed, quality, n_tables. Per document: pages by outcome, as sorted arrays; pages after the
    first failed one count as not read by OCR."""
    from pyspark.sql import Window

    before = Window.partitionBy("doc_id").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    off = F.coalesce(F.max(F.col("ocr_failed").cast("int")).over(before), F.lit(0)) == 1
    own = pages.withColumn("off", off)
    having = lambda c: F.array_sort(F.collect_list(F.when(c, F.col("page"))))
    return own.groupBy("doc_id").agg(
        F.count("*").alias("n_pages"),
        having(F.col("is_ocr") & ~F.col("off")).alias("ocr_pages"),
        having(F.col("ocr_failed") | (F.col("off") & F.col("is_ocr"))).alias("failed_pages"),
        having(F.col("is_ocr") & ~F.col("off") & (F.col("quality") < low)).alias("low_quality_pages"),
        having(F.trim("text") == "").alias("empty_pages"),
        having(F.col("n_tables") > 0).alias("table_pages"),
    )
