"""Content types of sections by the density of terms and keywords. sections: section_id, title, text, token_estimate, has_tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import COMMENTARY, DOT_LEADER, KEYWORDS, SKIP_TITLES
from ..functions.text import strip
from .terms import find_terms

TYPES = ("CASE", "CONCEPT", "RULE", "EXAMPLE", "COMPARISON")
THRESHOLD = 2.0
MIN_TOKENS = 40
TABLE_BONUS = 6
#: Weights of term kinds, and of a keyword, by type.
WEIGHTS = {"CASE": {"case_name": 3, "citation": 2, "court": 1}, "CONCEPT": {"defined_term": 2}, "RULE": {"provision": 2, "statute": 1}, "EXAMPLE": {}, "COMPARISON": {}}
KEYWORD_WEIGHT = {"EXAMPLE": 3}


def keyword_count(kind: str, text: Column) -> Column:
    """Keywords of one type as whole words, in any case."""
    return F.regexp_count(text, F.lit(rf"(?iU)\b(?:{KEYWORDS[kind]})\b"))


def keyword_counts(sections: DataFrame) -> DataFrame:
    return sections.withColumns({f"{k.lower()}_words": keyword_count(k, F.col("text")) for k in TYPES})


def raw_scores(sections: DataFrame) -> DataFrame:
    """Adds raw_<type>: weighted counts of terms and keywords."""
    own = sections.withColumn("__terms", F.transform(find_terms(F.col("text")), lambda t: t["kind"]))
    kind_count = lambda k: F.size(F.filter("__terms", lambda t: t == k))
    out = {}
    for k in TYPES:
        score = keyword_count(k, F.col("text")) * KEYWORD_WEIGHT.get(k, 1)
        for term, weight in WEIGHTS[k].items():
            score = score + kind_count(term) * weight
        out[f"raw_{k.lower()}"] = score + F.when(F.col("has_tables"), TABLE_BONUS).otherwise(0) if k == "COMPARISON" else score
    return own.withColumns(out).drop("__terms")


def per_thousand(count: Column, tokens: Column) -> Column:
    return F.bround(count * 1000 / F.greatest(tokens, F.lit(1)), 2)


def skip_reason(title: Column, text: Column, tokens: Column) -> Column:
    """Why a section isn't worth reading on, or null."""
    lines = F.filter(F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\u0085  ]"), lambda x: (strip(x) != "") & ~x.startswith("[[p."))
    listed = F.size(F.filter(lines, lambda x: x.rlike(DOT_LEADER)))
    any_listed = text.rlike(r"(?U)(?:\.{3}|…|\s{3})\s*\d")  # spares the lines of most texts
    return (
        F.when(tokens < MIN_TOKENS, F.lit("too short"))
        .when(F.coalesce(title, F.lit("")).rlike(SKIP_TITLES), F.concat(F.lit("front/back matter ("), strip(title), F.lit(")")))
        .when(any_listed & (F.size(lines) > 0) & (2 * listed > F.size(lines)), F.lit("table of contents"))
    )


def commentary(text: Column) -> Column:
    """Distinct phrases of the author's own voice, lower-cased, sorted."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(rf"(?iU)\b({COMMENTARY})\b"), F.lit(1)), lambda x: F.lower(F.trim(x)))))


def ranked_types(scores: dict[str, Column]) -> Column:
    """Types at the threshold or above, strongest first, in the order of TYPES where equal."""
    entries = F.array(*[F.struct((-scores[k]).alias("s"), F.lit(i).alias("i"), F.lit(k).alias("k")) for i, k in enumerate(TYPES)])
    return F.transform(F.array_sort(F.filter(entries, lambda e: e["s"] <= -THRESHOLD)), lambda e: e["k"])


def classify(sections: DataFrame) -> DataFrame:
    """section_id, skip_reason, types, scores (map), unclear, signals. Skipped sections have no types and no scores."""
    own = sections.withColumn("skip_reason", skip_reason(F.col("title"), F.col("text"), F.col("token_estimate")))
    own = raw_scores(own.withColumn("text", F.when(F.col("skip_reason").isNull(), F.col("text"))))  # what is skipped isn't searched
    scores = {k: per_thousand(F.col(f"raw_{k.lower()}"), F.col("token_estimate")) for k in TYPES}
    read = F.col("skip_reason").isNull()
    found = own.withColumn("__types", ranked_types(scores))
    return found.select(
        "section_id",
        "skip_reason",
        F.when(read & (F.size("__types") == 0), F.array(F.lit("CONCEPT"))).when(read, F.col("__types")).otherwise(F.array().cast("array<string>")).alias("types"),
        F.when(read, F.create_map(*[x for k in TYPES for x in (F.lit(k), scores[k])])).alias("scores"),
        (read & (F.size("__types") == 0)).alias("unclear"),
        F.when(read, commentary(F.col("text"))).otherwise(F.array().cast("array<string>")).alias("signals"),
    )


MODEL_CHARS = 6000


def reclassified(classes: DataFrame, sections: DataFrame, responder: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """classes with the word of a model on unclear sections that aren't skipped. responder: section_id and text (its first MODEL_CHARS characters) to
    section_id, types and skip_reason, null where it has nothing to say. method tells which rule or model decided."""
    asked = classes.filter("unclear and skip_reason is null").select("section_id").join(sections.select("section_id", F.substring("text", 1, MODEL_CHARS).alias("text")), "section_id")
    said = responder(asked).select("section_id", F.filter("types", lambda t: t.isin(*TYPES)).alias("__types"), F.col("skip_reason").alias("__skip"))
    out = classes.join(said, "section_id", "left")
    skipped, named = F.col("__skip").isNotNull(), F.size("__types") > 0
    types = F.when(skipped, F.array().cast("array<string>")).when(named, F.col("__types")).otherwise(F.col("types"))
    method = F.when(skipped | named, "model").otherwise("rules")
    return out.withColumns({"types": types, "skip_reason": F.coalesce("skip_reason", "__skip"), "method": method}).drop("__types", "__skip")
