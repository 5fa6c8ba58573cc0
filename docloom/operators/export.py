"""Exports: knowledge records as JSON, overviews as CSV, an HTML page, run reports."""

from __future__ import annotations

import html
import json
from collections.abc import Iterable, Iterator
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .library import record_title
from .link import RELATIONS
from .records import FIELDS

TYPE_ORDER = ("CONCEPT", "CASE", "RULE", "EXAMPLE", "COMPARISON")


def _texts(field: str) -> Column:
    return F.transform(F.filter("statements", lambda s: s["field"] == field), lambda s: s["text"])


def _one(field: str) -> Column:
    return F.coalesce(F.get(_texts(field), F.lit(0)), F.lit(""))


def _laws() -> Column:
    return F.transform("laws", lambda x: F.concat_ws(", ", F.when(x["provision"] != "", x["provision"]), F.when(x["statute"] != "", x["statute"])))


def knowledge() -> Column:
    """A record's content as JSON, under its type's own names."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    options = {"ignoreNullFields": "false"}
    case = F.struct(
        text("case_name").alias("case_name"), text("citation").alias("citation"), text("court").alias("court"), F.coalesce(F.substring("date.value", 1, 4), F.lit("")).alias("year"), F.col("parties"), _texts("material_facts").alias("material_facts"),
        _texts("legal_issues").alias("legal_issue"), _laws().alias("relevant_law"), _one("decision").alias("decision"), _texts("principles").alias("legal_principles"), _texts("important_factors").alias("important_factors"),
    )
    concept = F.struct(F.col("name").alias("concept_name"), _one("definition").alias("definition"), _texts("key_points").alias("key_points"), _texts("important_factors").alias("important_factors"))
    quote = F.coalesce(F.get(F.filter(F.transform("laws", lambda x: x["quoted_provision"]), lambda q: q.isNotNull()), F.lit(0)), F.lit(""))
    rule = F.struct(F.col("name").alias("rule_name"), _laws().alias("relevant_provision"), _texts("requirements").alias("requirements"), _texts("conditions").alias("conditions"), _texts("exceptions").alias("exceptions"), quote.alias("quoted_provision"))
    example = F.struct(_one("scenario").alias("scenario"), F.col("concept_illustrated"), _texts("important_facts").alias("important_facts"), _one("result").alias("result"))
    pairs = F.transform("comparison", lambda c: F.struct(c["subject"].alias("subject"), c["attribute"].alias("aspect"), c["value"].alias("value")))
    comparison = F.struct(F.col("name").alias("title"), F.col("subjects").alias("compared"), F.col("dimensions").alias("aspects"), pairs.alias("comparison"), _texts("key_differences").alias("key_differences"))
    out = F.to_json(comparison, options)
    for kind, content in (("EXAMPLE", example), ("RULE", rule), ("CONCEPT", concept), ("CASE", case)):
        out = F.when(F.col("record_type") == kind, F.to_json(content, options)).otherwise(out)
    return out


def sources(evidence: DataFrame, files: DataFrame) -> DataFrame:
    """evidence: record_id, pos, doc_id, page; files: doc_id, filename. record_id and sources: a struct for each document, in order of first mention, with the
    first and last page cited."""
    spans = evidence.groupBy("record_id", "doc_id").agg(F.min("pos").alias("pos"), F.min("page").alias("page_start"), F.max("page").alias("page_end"))
    named = spans.join(files.select("doc_id", "filename"), "doc_id", "left")
    entry = F.struct("pos", F.struct(F.col("doc_id").alias("document_id"), F.coalesce("filename", F.lit("")).alias("original_file"), "page_start", "page_end").alias("s"))
    return named.groupBy("record_id").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["s"]).alias("sources"))


def evidence_pages(records: DataFrame) -> DataFrame:
    """record_id, pos, doc_id, page: the long form of evidence."""
    return records.select("record_id", F.posexplode("evidence").alias("pos", "e")).select("record_id", "pos", "e.doc_id", F.explode("e.pages").alias("page"))


def knowledge_records(records: DataFrame, files: DataFrame, pending: DataFrame | None = None) -> DataFrame:
    """The agreed output: library records (PASS, approved where a person had to look) and, if given, pending reviews with status, review_reasons, review_id."""
    own = records.withColumns({"out_status": F.lit("PASS"), "reason": F.when(F.col("status") == "HUMAN_REVIEW", "approved by reviewer").otherwise(F.array_join("review_reasons", "; ")), "review_id": F.lit(None).cast("string")})
    if pending is not None:
        own = own.unionByName(pending.withColumns({"out_status": F.lit("HUMAN_REVIEW"), "reason": F.array_join("review_reasons", "; ")}), allowMissingColumns=True)
    rows = own.join(sources(evidence_pages(own), files), "record_id", "left")
    others = F.transform(F.filter("related", lambda r: r["type"] != "CASE"), lambda r: r["name"])
    illustrated = F.filter(F.coalesce("concept_illustrated", F.array().cast("array<string>")), lambda c: ~F.array_contains(others, c))
    return rows.select(
        "record_id", F.coalesce("topic.name", F.lit("")).alias("topic"), F.coalesce("subtopic.name", F.lit("")).alias("subtopic"), F.col("record_type").alias("content_type"), record_title().alias("title"), knowledge().alias("knowledge"),
        F.when(F.col("record_type") == "EXAMPLE", F.concat(others, illustrated)).otherwise(others).alias("related_concepts"), F.transform(F.filter("related", lambda r: r["type"] == "CASE"), lambda r: r["name"]).alias("related_cases"),
        F.get("sources", F.lit(0)).alias("source"), F.filter("sources", lambda x, i: i > 0).alias("additional_sources"), F.struct(F.col("out_status").alias("status"), F.col("similarity").alias("similarity_score"), "reason").alias("validation"), "review_id",
    )


def overview(records: DataFrame) -> DataFrame:
    """A row for each record, lists as texts: what the CSV export holds."""
    docs = F.array_join(F.array_sort(F.array_distinct(F.transform("evidence", lambda e: e["doc_id"]))), " ")
    pages = F.array_join(F.transform(F.array_sort(F.array_distinct(F.flatten(F.transform("evidence", lambda e: e["pages"])))), lambda p: p.cast("string")), " ")
    waits = F.coalesce(F.col("status") == "HUMAN_REVIEW", F.lit(False)) if "status" in records.columns else F.lit(False)
    return records.select("record_id", F.col("record_type").alias("type"), record_title().alias("title"), F.coalesce("topic.name", F.lit("")).alias("topic"), F.coalesce("subtopic.name", F.lit("")).alias("subtopic"), docs.alias("documents"), pages.alias("pages"), "proprietary", waits.alias("needs_review")).orderBy("record_id")


def write_json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", "true").csv(path)


def write_csv_file(rows: DataFrame, path: str) -> None:
    """One UTF-8 file with a byte order mark, as spreadsheets want it, written row by row."""
    import csv

    with open(path, "w", encoding="utf-8-sig", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(rows.columns)
        for row in rows.toLocalIterator():
            writer.writerow(["" if v is None else v for v in row])


def export_library(records: DataFrame, relations: DataFrame, topics: DataFrame, folder: str) -> None:
    """records, relations and topics as folders of JSON lines; topics: topic_id, name, parent_id, n."""
    write_json_lines(records.orderBy("record_id"), f"{folder}/records.jsonl")
    write_json_lines(relations.select("from_id", "relation", "to_id", "basis"), f"{folder}/relations.jsonl")
    write_json_lines(topics.select("topic_id", "name", "parent_id", F.col("n").alias("records")), f"{folder}/topics.jsonl")


def json_schema(kind: T.DataType) -> dict:
    """A Spark type as JSON Schema."""
    if isinstance(kind, T.StructType):
        return {"type": "object", "properties": {f.name: json_schema(f.dataType) for f in kind.fields}}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": json_schema(kind.elementType)}
    if isinstance(kind, T.MapType):
        return {"type": "object", "additionalProperties": json_schema(kind.valueType)}
    names = {"string": "string", "boolean": "boolean", "double": "number", "float": "number", "int": "integer", "bigint": "integer"}
    return {"type": names.get(kind.simpleString(), "string")}


def schemas(records: DataFrame) -> dict[str, dict]:
    """One JSON Schema for each record type, with the statement fields it may have, and one for relations."""
    out = {}
    for kind, fields in FIELDS.items():
        own = json_schema(records.schema)
        own["properties"]["record_type"] = {"const": kind}
        own["properties"]["statements"]["items"]["properties"]["field"] = {"enum": fields}
        out[kind] = own
    edge = {c: {"type": "string"} for c in ("from_id", "to_id", "basis")} | {"relation": {"enum": list(RELATIONS)}}
    return out | {"relation": {"type": "object", "properties": edge}}


def page_ranges(rows: DataFrame, key: str, page: str = "page") -> DataFrame:
    """key and ranges: '425–427, 431' for pages 425, 426, 427 and 431."""
    from pyspark.sql import Window

    own = rows.select(key, F.col(page).alias("p")).distinct()
    runs = own.withColumn("g", F.col("p") - F.row_number().over(Window.partitionBy(key).orderBy("p"))).groupBy(key, "g").agg(F.min("p").alias("a"), F.max("p").alias("b"))
    text = F.when(F.col("a") == F.col("b"), F.col("a").cast("string")).otherwise(F.concat(F.col("a"), F.lit("–"), F.col("b")))
    return runs.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("a", text.alias("t")))), lambda x: x["t"]), ", ").alias("ranges"))


def ordered_for_reading(rows: DataFrame) -> DataFrame:
    """By topic, subtopic, type and title; no topic is General."""
    place = F.array_position(F.array(*map(F.lit, TYPE_ORDER)), F.col("content_type"))
    return rows.withColumns({"topic": F.when(F.col("topic") == "", "General").otherwise(F.col("topic"))}).orderBy("topic", "subtopic", place, "title", "record_id")


def topic_counts(rows: DataFrame) -> DataFrame:
    """topic, subtopic and n of knowledge records; the row of a topic alone has no subtopic. For the table of contents."""
    named = rows.select(F.when(F.col("topic") == "", "General").otherwise(F.col("topic")).alias("topic"), F.when(F.col("subtopic") != "", F.col("subtopic")).alias("subtopic"))
    return named.rollup("topic", "subtopic").agg(F.count("*").alias("n"), F.grouping_id().alias("g")).filter("topic is not null and (g = 1 or g = 0 and subtopic is not null)").drop("g")


def _article(row) -> str:
    cells = "".join(f"<dt>{html.escape(k.replace('_', ' '))}</dt><dd>{_cell(v)}</dd>" for k, v in json.loads(row.knowledge).items())
    mark = f" class='review'><p>{html.escape((row.validation.reason if row.validation else None) or 'to be reviewed')}</p" if row.review_id else ""
    return f"<article{mark}><h4>{html.escape(row.title or '')}</h4><p>{row.content_type}</p><dl>{cells}</dl></article>"


def _page(title: str, parts: Iterable[str]) -> str:
    return "\n".join([f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>", *parts])


def _sections(rows: Iterable) -> Iterator[str]:
    """Articles under a heading for each topic and subtopic, those to be reviewed at the end."""
    topic = sub = None
    late = []
    for row in rows:
        if row.review_id:
            late.append(_article(row))
            continue
        if row.topic != topic:
            topic, sub = row.topic, None
            yield f"<h2>{html.escape(topic)}</h2>"
        if row.subtopic != sub and row.subtopic:
            sub = row.subtopic
            yield f"<h3>{html.escape(sub)}</h3>"
        yield _article(row)
    if late:
        yield "<h2>To be reviewed</h2>"
        yield from late


def contents(counts: Iterable) -> str:
    """The table of contents: topics with their subtopics and numbers of records."""
    lines = [f"<li>{'&nbsp;' * 4 if r.subtopic else ''}{html.escape(r.subtopic or r.topic)} ({r.n})</li>" for r in counts]
    return f"<ul>{''.join(lines)}</ul>"


def html_page(rows: DataFrame, title: str = "Library") -> str:
    """One page with all knowledge records, for libraries that fit one; see html_pages."""
    toc = contents(topic_counts(rows).orderBy("topic", F.col("subtopic").asc_nulls_first()).toLocalIterator())
    return _page(title, [toc, *_sections(ordered_for_reading(rows).toLocalIterator())])


def html_pages(rows: DataFrame, path: str, title: str = "Library") -> None:
    """A page for each topic, written by tasks as text files in `topic=...` folders below `path`, and the table of contents in `contents`. A task
    holds one row at a time."""

    def pages(frames):
        topic = None
        for frame in frames:
            out = []
            for row in frame.itertuples():
                if row.topic != topic:
                    topic = row.topic
                    out.append((row.topic, _page(row.topic, [])))
                review = {"validation": SimpleNamespace(reason=row.reason), "review_id": row.review_id}
                out.append((row.topic, _article(SimpleNamespace(knowledge=row.knowledge, title=row.title, content_type=row.content_type, **review))))
            yield pd.DataFrame(out, columns=["topic", "value"])

    place = F.array_position(F.array(*map(F.lit, TYPE_ORDER)), F.col("content_type"))
    own = rows.select(F.when(F.col("topic") == "", "General").otherwise(F.col("topic")).alias("topic"), "subtopic", place.alias("place"), "title", "record_id", "knowledge", "content_type", "review_id", F.col("validation.reason").alias("reason"))
    own = own.repartition("topic").sortWithinPartitions("topic", F.col("review_id").isNotNull(), "subtopic", "place", "title", "record_id")
    own.select("topic", "title", "knowledge", "content_type", "review_id", "reason").mapInPandas(pages, "topic string, value string").write.mode("overwrite").partitionBy("topic").text(path)
    toc = topic_counts(rows).withColumn("line", F.concat(F.lit("<li>"), F.coalesce("subtopic", "topic"), F.lit(" ("), "n", F.lit(")</li>")))
    toc.orderBy("topic", F.col("subtopic").asc_nulls_first()).select("line").write.mode("overwrite").text(f"{path.rstrip('/')}-contents")


def _cell(value) -> str:
    if value in (None, "", []):
        return "<i>not stated</i>"
    if isinstance(value, list):
        return "<ul>" + "".join(f"<li>{_cell(v)}</li>" for v in value) + "</ul>"
    if isinstance(value, dict):
        return html.escape(", ".join(str(v) for v in value.values() if v))
    return html.escape(str(value))
