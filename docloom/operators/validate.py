"""Checks of built records against their sections, and the verdict: PASS, REGENERATE or HUMAN_REVIEW.

records: as build_records gives them. Each check adds an array of messages; a message starts with no code, so that texts can be shown as they are.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.udf import vectorised
from ..functions.text import loose
from .overlap import MAX_RATIO, MAX_RUN, MAX_SENTENCE, check_overlap, overlap_ok, overlap_score, sentences
from .terms import find_terms, term_key

MAX_STATEMENT = 700
SECTION_WINDOW = 80
_FIRST_PERSON = r"\b(?:[Ww]e|[Oo]ur|[Oo]urs)\b"
_ADVICE = r"(?i)\b(?:practice pointer|practice tip|counsel should|attorneys should|lawyers should|it is advisable|be sure to|consider (?:asking|adding))\b"
_NUMBERED = regex.compile(r"^(.*?§+)\s*([\d.]+[A-Za-z]*)")
_NOT_LOOSE = regex.compile(r"[^\p{L}\p{N}§]+")


def _messages(*conditions: tuple[Column, Column]) -> Column:
    return F.filter(F.array(*[F.when(c, m) for c, m in conditions]), lambda x: x.isNotNull())


def schema_errors() -> Column:
    """What a record of each type needs at least, and statements that are too long."""
    has = lambda *fields: F.exists("statements", lambda s: s["field"].isin(*fields))
    kind = lambda t: F.col("record_type") == t
    needs = _messages(
        (kind("CASE") & ~has("decision", "principles", "material_facts", "legal_issues"), F.lit("case has no facts, issues, decision or principles")),
        (kind("CONCEPT") & ~has("definition", "key_points"), F.lit("concept has neither a definition nor key points")),
        (kind("RULE") & ~has("requirements", "conditions", "exceptions"), F.lit("rule has no requirements, conditions or exceptions")),
        (kind("COMPARISON") & (F.size("comparison") == 0) & ~has("key_differences"), F.lit("comparison has no items")),
    )
    long = F.filter(F.transform("statements", lambda s: F.length(s["text"])), lambda n: n > MAX_STATEMENT)
    return F.concat(needs, F.transform(long, lambda n: F.concat(F.lit("statement too long ("), n.cast("string"), F.lit(" chars)"))))


def grounding_errors(doc: str = "section_doc", first: str = "page_start", last: str = "page_end") -> Column:
    elsewhere = F.transform(F.filter("evidence", lambda e: e["doc_id"] != F.col(doc)), lambda e: F.concat(F.lit("evidence "), e["id"], F.lit(" points to another document")))
    outside = F.filter("evidence", lambda e: F.exists(e["pages"], lambda p: (p < F.col(first)) | (p > F.col(last))))
    beyond = F.transform(outside, lambda e: F.concat(F.lit("evidence "), e["id"], F.lit(" cites pages outside "), F.col(first), F.lit("-"), F.col(last)))
    return F.concat(elsewhere, beyond, F.transform(_unsupported("source"), lambda s: F.concat(F.lit("source statement without supporting notes: '"), F.substring(s["text"], 1, 60), F.lit("'"))))


def _unsupported(basis: str) -> Column:
    return F.filter("statements", lambda s: (F.size(s["evidence"]) == 0) & (s["basis"] == basis))


def grounding_warnings() -> Column:
    return F.transform(_unsupported("interpretation"), lambda s: F.concat(F.lit("interpretation without supporting notes: '"), F.substring(s["text"], 1, 60), F.lit("'")))


def identifiers() -> Column:
    """Array of struct(kind, value) of what a record names."""
    entry = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    empty = F.expr("cast(array() as array<struct<kind:string,value:string>>)")
    many = lambda kind, values: F.coalesce(F.transform(values, lambda v: entry(kind, v)), empty)
    case = F.filter(F.array(entry("case_name", F.col("case_name"))), lambda e: e["value"].isNotNull())
    citations = F.filter(F.transform(F.split(F.coalesce("citation", F.lit("")), "[;,]"), lambda c: F.trim(c)), lambda c: c != "")
    laws = F.coalesce(F.flatten(F.transform("laws", lambda x: F.array(entry("statute", x["statute"]), entry("provision", x["provision"])))), empty)
    related = F.transform(F.filter("related", lambda r: r["type"] == "CASE"), lambda r: r["name"])
    parties = F.transform("parties", lambda p: p["name"])
    court = F.filter(F.array(entry("court", F.col("court"))), lambda e: e["value"].isNotNull())
    every = F.concat(case, many("citation", citations), court, many("party", parties), laws, many("case_name", related))
    return F.filter(every, lambda e: F.coalesce(e["value"], F.lit("")) != "")


def in_section_list(value: str, source: str) -> bool:
    """'42 USC § 1981' is supported by '42 USC §§ 1981, 1983': its code stands shortly before its number."""
    hit = _NUMBERED.match(value.strip())
    if not hit:
        return False
    code, low = _NOT_LOOSE.sub("", hit[1].rstrip("§ ").lower()), source.lower()
    spots = (m.start() for m in regex.finditer(regex.escape(hit[2]), low))
    return bool(code) and any(code in _NOT_LOOSE.sub("", low[max(0, at - SECTION_WINDOW) : at]) for at in spots)


@vectorised("array<boolean>")
def _listed(values: pd.Series, source: pd.Series) -> pd.Series:
    return pd.Series([[v["kind"] in ("provision", "statute") and in_section_list(v["value"], s or "") for v in vs] for vs, s in zip(values, source, strict=True)])


def check_terms(records: DataFrame, source: str = "text") -> DataFrame:
    """Adds term_errors (identifiers that the source doesn't have) and term_warnings (defined terms that the record no longer uses)."""
    own = records.withColumns({"__named": identifiers(), "__found": find_terms(F.col(source)), "__loose": loose(F.col(source))})
    own = own.withColumns({"__keys": F.transform("__found", lambda t: term_key(t["kind"], t["value"])), "__listed": _listed("__named", source)})
    kind = lambda e: F.when(e["kind"] == "party", "case_name").otherwise(e["kind"])
    supported = lambda e, i: F.array_contains("__keys", term_key(kind(e), e["value"])) | F.contains(F.col("__loose"), loose(e["value"])) | F.get("__listed", i)
    missing = F.filter("__named", lambda e, i: ~supported(e, i))
    errors = F.transform(missing, lambda e: F.concat(e["kind"], F.lit(" not found in source: '"), e["value"], F.lit("'")))
    body = loose(F.concat_ws(" ", F.transform("statements", lambda s: s["text"]), "case_name", "name"))
    unused = F.filter("identifiers", lambda i: (i["kind"] == "defined_term") & ~F.contains(body, loose(i["value"])))
    warnings = F.transform(unused, lambda i: F.concat(F.lit("defined term not used in record: '"), i["value"], F.lit("'")))
    return own.withColumns({"term_errors": errors, "term_warnings": warnings}).drop("__named", "__found", "__loose", "__keys", "__listed")


def commentary_reasons() -> Column:
    """Why a record reads like its author's own advice: what extraction said, first person, advice."""
    text = F.array_join(F.transform("statements", lambda s: s["text"]), " ")
    given = F.when(F.col("proprietary"), F.col("reasons")).otherwise(F.array().cast("array<string>"))
    found = _messages((text.rlike(_FIRST_PERSON), F.lit("first-person wording (author's voice)")), (text.rlike(_ADVICE), F.lit("practice advice")))
    return F.array_distinct(F.filter(F.concat(given, found), lambda r: F.coalesce(r, F.lit("")) != ""))


def copying_reasons(o: str = "overlap", max_run: int = MAX_RUN, max_ratio: float = MAX_RATIO, max_sentence: float = MAX_SENTENCE) -> Column:
    percent = lambda x: F.concat(F.bround(x * 100).cast("int").cast("string"), F.lit("%"))
    run, ratio, near = (F.col(f"{o}.{c}") for c in ("max_run", "ratio", "sentence_similarity"))
    return _messages(
        (run >= max_run, F.concat(run.cast("string"), F.lit(" consecutive words of ordinary source wording reproduced"))),
        (ratio > max_ratio, F.concat(percent(ratio), F.lit(" of 8-word sequences match the source"))),
        (near >= max_sentence, F.concat(F.lit("a source sentence is substantially reproduced ("), percent(near), F.lit(" similar)"))),
    )


@vectorised("array<string>")
def _texts(statements: pd.Series, comparison: pd.Series) -> pd.Series:
    out = []
    for given, items in zip(statements, comparison, strict=True):
        own = [s for x in (given if given is not None else []) for s in sentences(x["text"])]
        out.append(own + [f"{c['subject']} {c['attribute']} {c['value']}" for c in (items if items is not None else [])])
    return pd.Series(out)


def verdict(schema_ok: Column, grounding_ok: Column, terms_ok: Column, copy_ok: Column, reasons: Column, attempt: int, max_attempts: int = 1) -> Column:
    """REGENERATE where copying is the only fault and tries are left; else HUMAN_REVIEW with any fault or reason."""
    sound = schema_ok & grounding_ok & terms_ok
    return F.when(sound & ~copy_ok & F.lit(attempt < max_attempts), "REGENERATE").when(~sound | ~copy_ok | (F.size(reasons) > 0), "HUMAN_REVIEW").otherwise("PASS")


def validate(records: DataFrame, sections: DataFrame, low_quality: DataFrame | None = None, attempt: int = 0, max_attempts: int = 1) -> DataFrame:
    """Adds errors, warnings, review_reasons, copied (phrases), overlap, similarity and status. low_quality: doc_id, pages (array)."""
    own = sections.select("section_id", F.col("doc_id").alias("section_doc"), "page_start", "page_end", "text")
    rows = records.join(own, "section_id")
    exact = F.concat(F.transform("identifiers", lambda i: i["value"]), F.when(F.col("record_type").isin("CASE", "RULE", "CONCEPT"), F.array("name")).otherwise(F.array().cast("array<string>")))
    of_section = records.select("section_id", F.explode(exact).alias("e")).groupBy("section_id").agg(F.array_sort(F.collect_set("e")).alias("exact"))
    rows = rows.join(of_section, "section_id", "left").withColumns({"texts": _texts("statements", "comparison"), "source": F.col("text")})
    rows = check_terms(check_overlap(rows))
    copying = copying_reasons()
    rows = rows.withColumns({"schema_errors": schema_errors(), "grounding_errors": grounding_errors(), "copying": copying, "voice": commentary_reasons()})
    if low_quality is not None:
        rows = rows.join(low_quality.select(F.col("doc_id").alias("section_doc"), F.col("pages").alias("low_pages")), "section_doc", "left")
        poor = F.exists("evidence", lambda e: F.coalesce(F.arrays_overlap(e["pages"], F.col("low_pages")), F.lit(False)))
    else:
        poor = F.lit(False)
    none = F.array().cast("array<string>")
    too_close = F.when(F.size("copying") > 0, F.array(F.concat(F.lit("wording too close to source: "), F.array_join("copying", "; ")))).otherwise(none)
    errors = F.concat("schema_errors", "grounding_errors", "term_errors", too_close)
    rows = rows.withColumns({"errors": errors, "warnings": F.concat(grounding_warnings(), "term_warnings"), "low_ocr": poor, "copy_ok": overlap_ok()})
    voice = F.concat("voice", F.when(F.col("low_ocr"), F.array(F.lit("based on low-quality OCR pages"))).otherwise(none))
    status = verdict(F.size("schema_errors") == 0, F.size("grounding_errors") == 0, F.size("term_errors") == 0, F.col("copy_ok"), voice, attempt, max_attempts)
    still = F.when(~F.col("copy_ok") & F.lit(attempt > 0), F.array(F.lit("still too similar after regeneration"))).otherwise(none)
    rows = rows.withColumns({"status": status, "review_reasons": F.when(status == "REGENERATE", F.col("copying")).otherwise(F.array_distinct(F.concat("errors", voice, still)))})
    sentence = F.when(F.col("overlap.copied_sentence").isNotNull() & (F.col("overlap.sentence_similarity") >= MAX_SENTENCE), F.array("overlap.copied_sentence")).otherwise(none)
    rows = rows.withColumns({"copied": F.concat("overlap.phrases", sentence), "similarity": overlap_score()})
    return rows.drop("section_doc", "page_start", "page_end", "text", "exact", "texts", "source", "schema_errors", "grounding_errors", "term_errors", "term_warnings", "copying", "voice", "low_pages", "copy_ok")


def validated(records: DataFrame, sections: DataFrame, recompose: Callable[[DataFrame], DataFrame], low_quality: DataFrame | None = None, max_attempts: int = 1) -> DataFrame:
    """validate(), and again what recompose() makes of the records to regenerate (section_id, key, copied), until none is left."""
    checked = validate(records, sections, low_quality, 0, max_attempts)
    done = checked.filter("status <> 'REGENERATE'")
    for attempt in range(1, max_attempts + 1):
        again = checked.filter("status = 'REGENERATE'").select("section_id", "key", F.col("copied").alias("phrases"))
        checked = validate(recompose(again), sections, low_quality, attempt, max_attempts)
        done = done.unionByName(checked.filter("status <> 'REGENERATE'"))
    return done
