"""Line, page and note expressions. All of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .wordlists import STOPWORDS

PAGE_NUMBER = r"(?iU)^\s*(?:page\s*)?[-–—(\[]?\s*(?:\d{1,5}|[ivxlcdm]{1,7})\s*[-–—)\]]?(?:\s*(?:of|/)\s*\d{1,5})?\s*$"
EDGE = 0.10


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_page_number(text: Column) -> Column:
    return text.rlike(PAGE_NUMBER)


def signature(text: Column) -> Column:
    """What a running header keeps from page to page: its text with every number as '#'."""
    return F.regexp_replace(F.lower(strip(text)), r"\p{Nd}+", "#")


def is_edge(y: Column) -> Column:
    """Within the top or bottom tenth of the page."""
    return (y < EDGE) | (y > 1 - EDGE)


def tidy(text: Column) -> Column:
    """Joins words broken by a hyphen at a line end, and collapses blanks and empty lines."""
    joined = F.regexp_replace(text, r"(\p{Ll})-\n(\p{Ll})", "$1$2")
    return strip(F.regexp_replace(F.regexp_replace(joined, "[ \t\u00a0]+", " "), "\n{3,}", "\n\n"))


def estimate_tokens(text: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4)).cast("int")


def words(text: Column) -> Column:
    """White-space separated words; none for an empty text."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def lettered_words(text: Column) -> Column:
    return F.filter(words(text), lambda w: w.rlike(r"\p{L}{2}"))


def text_quality(text: Column) -> Column:
    """Share of words with two letters in a row; 0 for an empty text."""
    n = F.size(words(text))
    return F.when(n == 0, F.lit(0.0)).otherwise(F.bround(F.size(lettered_words(text)) / n, 3))


def needs_ocr(text: Column, image_share: Column, min_chars: int = 50, min_share: float = 0.3) -> Column:
    return (F.length(strip(text)) < min_chars) & (image_share > min_share)


def image_coverage(areas: Column, page_area: Column) -> Column:
    """Share of a page that images cover, by the areas they have on it; images over one another count each, the share ends at 1."""
    return F.when(page_area > 0, F.least(F.aggregate(areas, F.lit(0.0), lambda s, a: s + a) / page_area, F.lit(1.0))).otherwise(0.0)


def clean_title(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(name, "_+", " ")), r"\s+\d+$", ""), r"(?U)\s+", " "))


def telegraphic(note: Column) -> Column:
    """The note without small words; the note itself when fewer than two words would stay."""
    kept = F.filter(words(note), lambda w: ~F.array_contains(F.array(*map(F.lit, sorted(STOPWORDS))), F.lower(F.btrim(w, F.lit(",.;:()")))))
    return F.when(F.size(kept) >= 2, F.array_join(kept, " ")).otherwise(note)


def page_marker(page: Column) -> Column:
    return F.concat(F.lit("[[p. "), page.cast("string"), F.lit("]]"))


def format_table(rows: Column) -> Column:
    """Cells between pipes, a line for each row; null cells are empty."""
    return F.array_join(F.transform(rows, lambda r: F.concat(F.lit("| "), F.array_join(F.transform(r, lambda c: F.coalesce(c, F.lit(""))), " | "), F.lit(" |"))), "\n")


def usable_tables(tables: Column) -> Column:
    """Tables of at least two non-blank rows and two columns, cells with their white space collapsed."""
    cell = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))
    rows = lambda t: F.filter(F.transform(t, lambda r: F.transform(r, cell)), lambda r: F.exists(r, lambda c: c != ""))
    return F.filter(F.transform(tables, rows), lambda t: (F.size(t) >= 2) & F.exists(t, lambda r: F.size(r) >= 2))


def loose(text: Column) -> Column:
    """Lower case, only letters, numbers and the section sign."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}§]+", "")


def note_id(value: Column) -> Column:
    return F.lower(F.regexp_replace(value, "[\\s\\[\\]()#\"'`]", ""))


def date_precision(value: Column) -> Column:
    return F.when(F.trim(value).rlike(r"^\d{4}$"), F.lit("year")).otherwise(F.lit("day"))
