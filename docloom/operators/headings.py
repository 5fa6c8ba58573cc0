"""Headings, their levels and the topic tree, from line styles or bookmarks.

lines: doc_id, page, line_idx, text, size, bold. Headings: doc_id, n (from 0), level, title, page, line_idx.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import make_id
from ..functions.similarity import partial_ratio_of
from ..functions.text import is_page_number, strip, words

MAX_CHARS, MAX_WORDS, BIGGER, NEAR = 120, 16, 1.12, 0.95
MIN_BOOKMARKS, BOOKMARK_SCORE = 3, 85
_PART = r"(?:chapter|part|unit|module|title|book|section|article|schedule|appendix)\s+(?:\d+|[ivxlcdm]+|[a-z])\b"
_LABEL = rf"(?:(?:{_PART}[.:\-–—]?|\[[\d:.\s\-–]+\]|\(?(?:\d+(?:\.\d+)*|[a-z]|[ivxlc]+)[.)]|\d+(?:\.\d+)+)\s*)"
_PLACEHOLDER = r"(?iU)^(?:reserved|omitted|deleted|repealed|intentionally left blank)\.?$"


def strip_numbering(text: Column) -> Column:
    """The title without stacked labels such as '3.5.', '(a)' or 'Chapter 2', lower-cased."""
    bare = F.regexp_replace(strip(text), rf"(?iU)^{_LABEL}+", "")
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(bare, "[.:]+$", "")), r"(?U)\s+", " "))


def numbering_depth(text: Column) -> Column:
    """1 for '3', 'Chapter 2', 'A. x'; 3 for '3.4.1 x'; null without a number."""
    own = strip(text)
    dotted = F.regexp_extract(own, r"(?U)^(\d+(?:\.\d+){0,4})\.?\s+\S", 1)
    named = own.rlike(rf"(?iU)^(?:{_PART}|[A-Z]\.\s+\S|[IVXLC]+\.\s+\S)")
    return F.when(own.rlike(rf"(?iU)^{_PART}"), F.lit(1)).when(dotted != "", F.size(F.split(dotted, r"\."))).when(named, F.lit(1))


def is_caps(text: Column) -> Column:
    letters = F.regexp_replace(text, r"\P{L}", "")
    return (F.length(letters) >= 4) & ~letters.rlike(r"\P{Lu}")


def heading_like(text: Column) -> Column:
    own, bare = strip(text), strip_numbering(text)
    sentence = own.endswith(".") & numbering_depth(own).isNull() & (F.length(own) > 40)
    return (
        (F.length(own) > 0) & (F.length(own) <= MAX_CHARS) & (F.size(words(own)) <= MAX_WORDS) & own.rlike(r"\p{L}") & ~own.rlike("[,;]$")
        & ~is_page_number(own) & ~F.concat(bare, F.lit(".")).rlike(_PLACEHOLDER) & (bare != "") & ~sentence
    )


def body_size(lines: DataFrame) -> DataFrame:
    """doc_id, body: the rounded size with most characters; of equals the one seen first."""
    sizes = lines.groupBy("doc_id", F.bround("size").cast("int").alias("body")).agg(F.sum(F.length("text")).alias("chars"), F.min(F.struct("page", "line_idx")).alias("first"))
    order = Window.partitionBy("doc_id").orderBy(F.desc("chars"), "first")
    return sizes.withColumn("rank", F.row_number().over(order)).filter("rank = 1").select("doc_id", "body")


def detect_headings(lines: DataFrame, max_levels: int = 3) -> DataFrame:
    """Lines larger than the body, bold or in capitals, ranked by style; a heading that runs over lines of one page is one."""
    bold_share = lines.groupBy("doc_id").agg((F.sum(F.when(F.col("bold"), F.length("text")).otherwise(0)) / F.greatest(F.sum(F.length("text")), F.lit(1))).alias("bold_share"))
    own = lines.join(body_size(lines), "doc_id").join(bold_share, "doc_id").filter((F.col("body") > 0) & heading_like(F.col("text")))
    near = F.col("size") >= F.col("body") * NEAR
    own = own.withColumns({"depth": numbering_depth(F.col("text")), "strong": F.col("bold") & (F.col("bold_share") < 0.5) & near, "caps": is_caps(F.col("text")) & near})
    numbered = F.col("depth").isNotNull()
    own = own.filter((F.col("size") >= F.col("body") * BIGGER) | (F.col("strong") & (numbered | (F.length("text") <= 80))) | (F.col("caps") & numbered))
    # styles rank by size, then bold, then capitals; with a single style the numbering decides
    style = Window.partitionBy("doc_id").orderBy(F.bround("size").desc(), F.col("strong").desc(), F.col("caps").desc())
    own = own.withColumn("rank", F.dense_rank().over(style)).withColumn("styles", F.max("rank").over(Window.partitionBy("doc_id")))
    level = F.when((F.col("styles") == 1) & numbered, F.col("depth")).otherwise(F.col("rank"))
    own = own.withColumn("level", F.least(level, F.lit(max_levels)))
    order = Window.partitionBy("doc_id").orderBy("page", "line_idx")
    same = (F.lag("page").over(order) == F.col("page")) & (F.lag("line_idx").over(order) == F.col("line_idx") - 1) & (F.lag("level").over(order) == F.col("level")) & ~numbered
    own = own.withColumn("starts", F.when(same, 0).otherwise(1)).withColumn("run", F.sum("starts").over(order))
    title = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_idx", "text"))), lambda x: strip(x["text"])), " ")
    runs = own.groupBy("doc_id", "run", "page", "level").agg(title.alias("title"), F.max("line_idx").alias("line_idx"))
    return runs.select("doc_id", (F.col("run") - 1).cast("int").alias("n"), "level", "title", "page", "line_idx")


def clean_bookmarks(toc: DataFrame, documents: DataFrame) -> DataFrame:
    """toc: doc_id, ord, level, title, page; documents: doc_id, page_count. Titles with their white space collapsed; without bookmarks that have no title
    or point outside the document."""
    title = F.trim(F.regexp_replace("title", r"(?U)\s+", " "))
    own = toc.withColumn("title", title).filter("title <> ''").join(documents.select("doc_id", "page_count"), "doc_id")
    return own.filter("page between 1 and page_count").drop("page_count")


def bookmarks_to_headings(toc: DataFrame, lines: DataFrame, max_levels: int = 3) -> DataFrame:
    """toc: doc_id, ord, level, title, page. Each bookmark stands at the line of its page that is most like it, or at the first line."""
    near = toc.join(lines.select("doc_id", "page", "line_idx", "text"), ["doc_id", "page"], "left")
    scored = near.withColumn("score", F.coalesce(partial_ratio_of(F.lower("title"), F.lower("text")), F.lit(0.0)))
    best = scored.groupBy("doc_id", "ord", "level", "title", "page").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("line_idx"))).alias("b"))
    line = F.when(F.col("b.s") <= -BOOKMARK_SCORE, F.col("b.line_idx")).otherwise(0)
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("ord")) - 1
    return best.select("doc_id", n.alias("n"), F.least("level", F.lit(max_levels)).alias("level"), "title", "page", line.alias("line_idx"))


def normalise_levels(headings: DataFrame, doc: str = "doc_id", order: str = "n", level: str = "level") -> DataFrame:
    """Levels start at 1 and go down one at a time.

    Closed form: with the 1-based place i and the level a counted from the least, the level is i + min(0, least a - i so far).
    """
    whole = Window.partitionBy(doc)
    so_far = whole.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = headings.withColumn("__i", F.row_number().over(whole.orderBy(order))).withColumn("__a", F.col(level) - F.min(level).over(whole) + 1)
    own = own.withColumn(level, (F.col("__i") + F.least(F.lit(0), F.min(F.col("__a") - F.col("__i")).over(so_far))).cast("int"))
    return own.drop("__i", "__a")


def find_headings(lines: DataFrame, toc: DataFrame | None = None, max_levels: int = 3) -> DataFrame:
    """Normalised headings with `found_by`: bookmarks where a document has at least three, else styles."""
    detected = detect_headings(lines, max_levels).withColumn("found_by", F.lit("headings"))
    if toc is not None:
        many = toc.groupBy("doc_id").agg(F.count("*").alias("k")).filter(F.col("k") >= MIN_BOOKMARKS).select("doc_id")
        marked = bookmarks_to_headings(toc.join(many, "doc_id", "left_semi"), lines, max_levels).withColumn("found_by", F.lit("toc"))
        detected = detected.join(many, "doc_id", "left_anti").unionByName(marked)
    return normalise_levels(detected)


def topic_paths(headings: DataFrame, max_levels: int = 3, doc: str = "doc_id", order: str = "n") -> DataFrame:
    """Adds topic_path: titles from level 1 down to the heading; neighbours equal but for their numbering are one."""
    so_far = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = headings
    for k in range(1, max_levels + 1):  # normalised levels leave no gap: the last title of level k is the ancestor
        own = own.withColumn(f"__t{k}", F.last(F.when(F.col("level") == k, F.col("title")), ignorenulls=True).over(so_far))
    path = F.filter(F.array(*[F.when(F.col("level") >= k, F.col(f"__t{k}")) for k in range(1, max_levels + 1)]), lambda t: t.isNotNull())
    new = lambda t, i: (i == 0) | (strip_numbering(t) != strip_numbering(F.get("__p", F.greatest(i - 1, F.lit(0)))))
    own = own.withColumn("__p", path).withColumn("topic_path", F.filter("__p", new))
    return own.drop("__p", *[f"__t{k}" for k in range(1, max_levels + 1)])


def topic_tree(headings: DataFrame, max_levels: int = 3) -> DataFrame:
    """doc_id, node_id, parent_id, level, title, page, n of every heading; a top heading's parent is the document's root node."""
    own = headings.withColumn("node_id", make_id("node", F.col("doc_id"), F.col("n"), F.col("title")))
    so_far = Window.partitionBy("doc_id").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    above = {k: F.last(F.when(F.col("level") == k, F.col("node_id")), ignorenulls=True).over(so_far) for k in range(1, max_levels)}
    parent = F.when(F.col("level") == 1, make_id("node", F.col("doc_id"), "root"))
    for k, node in above.items():
        parent = parent.when(F.col("level") == k + 1, node)
    return own.select("doc_id", "node_id", parent.alias("parent_id"), "level", "title", "page", "n")
