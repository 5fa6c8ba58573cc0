"""Records about one thing merged in order, entities, and the edges between records, topics and entities."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import make_id
from ..functions.similarity import token_set_ratio
from ..functions.udf import vectorised
from .library import Library, evidence_columns, evidence_rows, record_rows
from .records import record_id
from .terms import normalise, term_key

SIMILAR = 90
#: The names an edge may have; others become related_to.
RELATIONS = ("part_of", "cites", "applies", "interprets", "establishes", "illustrates", "distinguishes", "overrules", "compares", "defines", "related_to")
_KEY_KIND = {"CASE": "case_name", "STATUTE": "statute", "PROVISION": "provision", "COURT": "court"}


def entity_id(entity_type: Column, name: Column) -> Column:
    kind = F.lit("statute")
    for t, k in _KEY_KIND.items():
        kind = F.when(entity_type == t, F.lit(k)).otherwise(kind)
    return make_id("ent", entity_type, term_key(kind, name))


STATEMENTS = "array<struct<field:string,text:string,basis:string,evidence:array<string>>>"


def _folded_field(given: list[tuple[int, dict]]) -> list[tuple]:
    """(seq, statement) of one field in order: those of the first occurrence are taken as they stand, later ones are compared with all that stayed.
    A text that came before needs no second comparison, and evidence grows in a dict."""
    held: list[tuple[str, str, str, dict | list]] = []
    known: dict[str, int] = {}  # the place of the twin of each text: what is held stays in its place
    for seq, s in given:
        low, own = s["text"].lower(), list(s["evidence"])
        twin = None
        if seq != given[0][0]:
            twin = known[low] if low in known else next((k for k, o in enumerate(held) if token_set_ratio(o[2], low) >= SIMILAR), None)
        if twin is None:
            held.append((s["text"], s["basis"], low, own))
            continue
        known[low] = twin
        text, basis, key, evidence = held[twin]
        if isinstance(evidence, list):
            evidence = dict.fromkeys(evidence)
            held[twin] = (text, basis, key, evidence)
        evidence.update(dict.fromkeys(own))
    return [(text, basis, list(evidence)) for text, basis, _, evidence in held]


@vectorised(STATEMENTS)
def merged_statements(occurrences: pd.Series) -> pd.Series:
    """occurrences: arrays of seq and x, the statements of one occurrence of a record, in order. The statements of the merged record, by field; null for
    null."""

    def fold(rows) -> list[dict]:
        fields: dict[str | None, list[tuple[int, dict]]] = {}
        for o in rows:
            for s in o["x"]:
                fields.setdefault(s["field"], []).append((o["seq"], s))
        order = sorted(fields, key=lambda f: (f is not None, f or ""))
        return [{"field": f, "text": t, "basis": b, "evidence": e} for f in order for t, b, e in _folded_field(fields[f])]

    return pd.Series([None if rows is None else fold(rows) for rows in occurrences], dtype=object)


def firsts(entries: Column, key=lambda e: e) -> Column:
    """The entries of an array before which none has the same key, in order. They are found by sorting: Spark's own array_distinct compares each
    struct with all that it kept."""
    keyed = F.array_sort(F.transform(entries, lambda e, i: F.struct(key(e).alias("k"), i.alias("i"), e.alias("e"))))
    new = F.zip_with(keyed, F.concat(F.array(F.lit(None)), keyed), lambda x, before: F.when(before.isNull() | ~x["k"].eqNullSafe(before["k"]), F.struct(x["i"].alias("i"), x["e"].alias("e"))))
    return F.transform(F.array_sort(F.filter(new, lambda x: x["i"].isNotNull())), lambda x: x["e"])


#: Columns of checked records that a merged record keeps from its first occurrence.
FIRST_COLUMNS = ("status", "similarity", "errors", "warnings", "copied", "section_id", "doc_id", "section_index", "ord", "key", "prompt_version", "created_at")


def merged_citations(lists: Column) -> Column:
    """Citations of the occurrences in order (an array of texts) as one text; one that stands in what is there already isn't added."""
    whole = F.aggregate(lists, F.lit(""), lambda done, c: F.when(F.contains(done, c), done).when(done == "", c).otherwise(F.concat(done, F.lit("; "), c)))
    return F.when(whole != "", whole)


def _order(records: DataFrame) -> list[str]:
    """The columns that occurrences of one record are folded by."""
    return ["doc_id", "section_index", "ord", *[c for c in ("section_id", "key") if c in records.columns]]  # the last two for ties only


def merged_evidence(records: DataFrame) -> DataFrame:
    """evidence_rows of merged_records, for those who need nothing else of them: of the evidence of one record and id the first in the order of
    merged_records stays. Nothing is folded, so a record of many occurrences isn't one row of one task."""
    order = _order(records)
    own = records.select("record_id", *order, F.posexplode_outer("evidence").alias("__pos", "e")).filter("e.id is not null")
    first = F.row_number().over(Window.partitionBy("record_id", "e.id").orderBy(*order, "__pos")) == 1
    return evidence_columns(own.withColumn("__first", first).filter("__first"))


def merged_records(records: DataFrame) -> DataFrame:
    """Records of one id, folded in order of doc_id, section_index and ord: the first keeps its type, topic, status, validation and provenance
    (FIRST_COLUMNS, where the table has them); blanks are filled from later ones, lists grow by what is new, evidence by what has a new id, citations
    are joined, flags are or-ed, reasons are put together. Records of one id with different types are an error: ids are made of types."""
    own = records.withColumn("seq", F.row_number().over(Window.partitionBy("record_id").orderBy(*_order(records))))

    def ordered(column: str) -> Column:
        """All entries of an array column, those of the first record first."""
        return F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col(column).isNotNull(), F.struct("seq", F.col(column).alias("x"))))), lambda s: s["x"]))

    first = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("seq")))
    filled = lambda c: F.min_by(F.col(c), F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col("seq")))
    cited = F.transform(F.array_sort(F.collect_list(F.when(F.coalesce("citation", F.lit("")) != "", F.struct("seq", "citation")))), lambda s: s["citation"])
    evidence = firsts(F.filter(ordered("evidence"), lambda e: e["id"].isNotNull()), lambda e: e["id"])
    occurrences = F.array_sort(F.collect_list(F.when(F.col("statements").isNotNull(), F.struct("seq", F.col("statements").alias("x")))))
    kept = [F.min_by(c, "seq").alias(c) for c in FIRST_COLUMNS if c in records.columns]
    kept += [F.array_distinct(ordered("review_reasons")).alias("review_reasons")] if "review_reasons" in records.columns else []
    kept += [F.max("low_ocr").alias("low_ocr")] if "low_ocr" in records.columns else []
    out = own.groupBy("record_id").agg(
        F.min_by("record_type", "seq").alias("record_type"), F.countDistinct("record_type").alias("__types"), F.min_by("name", "seq").alias("name"), filled("case_name").alias("case_name"), merged_citations(F.array_distinct(cited)).alias("citation"), filled("court").alias("court"), first("date").alias("date"),
        firsts(ordered("parties")).alias("parties"), firsts(ordered("laws")).alias("laws"), ordered("comparison").alias("comparison"), F.array_distinct(ordered("subjects")).alias("subjects"), F.array_distinct(ordered("dimensions")).alias("dimensions"),
        F.array_distinct(ordered("concept_illustrated")).alias("concept_illustrated"), firsts(ordered("related")).alias("related"), evidence.alias("evidence"), F.struct(first("topic").alias("topic"), F.min_by("subtopic", F.when(F.col("topic").isNotNull(), F.col("seq"))).alias("subtopic")).alias("__t"),
        F.max("proprietary").alias("proprietary"), F.array_distinct(ordered("reasons")).alias("reasons"), firsts(ordered("identifiers")).alias("identifiers"), F.count("*").alias("n_merged"), occurrences.alias("__s"), *kept,
    )
    clash = F.raise_error(F.concat(F.lit("records of different types have the id "), "record_id"))
    out = out.withColumn("record_type", F.when(F.col("__types") == 1, F.col("record_type")).otherwise(clash.cast("string"))).drop("__types")
    several = F.col("n_merged") > 1
    alone = F.transform(F.array_sort(F.transform(F.get("__s", F.lit(0))["x"], lambda s, i: F.struct(s["field"].alias("field"), i.alias("i"), s.alias("s")))), lambda x: x["s"])
    statements = F.when(several, merged_statements(F.when(several, F.col("__s")))).otherwise(F.coalesce(alone, F.array().cast(STATEMENTS)))
    return out.withColumn("statements", statements).select("*", "__t.topic", "__t.subtopic").drop("__t", "__s")


def with_entities(records: DataFrame) -> DataFrame:
    """records whose laws name their entity: entity_id is the provision's where there is one, else the statute's."""
    whole = lambda x: F.trim(F.concat_ws(" ", x["provision"], x["statute"]))
    some = lambda v: F.coalesce(v, F.lit("")) != ""
    target = lambda x: F.when(some(x["provision"]), entity_id(F.lit("PROVISION"), whole(x))).when(some(x["statute"]), entity_id(F.lit("STATUTE"), x["statute"]))
    return records.withColumn("laws", F.transform("laws", lambda x: x.withField("entity_id", target(x))))


def entity_mentions(records: DataFrame) -> DataFrame:
    """entity_id, entity_type, canonical, alias, and the record's order: cases, courts, statutes and provisions that records name."""
    base = ["record_id", "doc_id", "section_index", "ord"]
    laws = records.filter("laws is not null").select(*base, F.explode("laws").alias("law")).select(*base, "law.*")
    mention = lambda t, name, alias: [F.lit(t).alias("entity_type"), name.alias("canonical"), alias.alias("alias")]
    whole = F.trim(F.concat_ws(" ", "provision", "statute"))
    cases = records.filter("case_name is not null")
    parts = [
        cases.select(*base, *mention("CASE", normalise(F.lit("case_name"), F.col("case_name")), F.col("case_name"))),
        records.filter("coalesce(court, '') <> ''").select(*base, *mention("COURT", F.col("court"), F.col("court"))),
        laws.filter("coalesce(statute, '') <> ''").select(*base, *mention("STATUTE", F.col("statute"), F.col("statute"))),
        laws.filter("coalesce(provision, '') <> ''").select(*base, *mention("PROVISION", whole, F.col("provision"))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("entity_id", entity_id(F.col("entity_type"), F.col("canonical")))


def entities(mentions: DataFrame, order: tuple[str, ...] = ("doc_id", "section_index", "ord")) -> DataFrame:
    """entity_id, entity_type, canonical (of the first mention) and aliases (distinct, in order of first mention)."""
    seq = F.struct(*order)
    first = mentions.groupBy("entity_id", "entity_type", "alias").agg(F.min(seq).alias("at"), F.min_by("canonical", seq).alias("canonical"))
    names = F.transform(F.array_sort(F.collect_list(F.struct("at", "alias"))), lambda x: x["alias"])
    return first.groupBy("entity_id", "entity_type").agg(F.min_by("canonical", F.struct("at", "alias")).alias("canonical"), names.alias("aliases"))


def relations(records: DataFrame) -> DataFrame:
    """from_id, relation, to_id, basis: all edges that the records give, one for each (from, relation, to); of several bases the last by name."""
    edge = lambda rows, a, r, b, basis=F.lit("source"): rows.select(a.alias("from_id"), r.alias("relation"), b.alias("to_id"), basis.alias("basis"))
    me, part = F.col("record_id"), F.lit("part_of")
    laws = records.filter("laws is not null").select("record_id", "record_type", F.explode("laws").alias("law")).select("record_id", "record_type", "law.*")
    provision = F.coalesce("provision", F.lit("")) != ""
    target = F.when(provision, entity_id(F.lit("PROVISION"), F.trim(F.concat_ws(" ", "provision", "statute")))).when(F.coalesce("statute", F.lit("")) != "", entity_id(F.lit("STATUTE"), F.col("statute")))
    related = records.select("record_id", F.explode("related").alias("r")).select("record_id", "r.*")
    other = F.when(F.col("type") == "STATUTE", entity_id(F.lit("STATUTE"), F.col("name"))).otherwise(record_id(F.col("type"), F.col("name")))
    illustrated = records.filter("record_type = 'EXAMPLE'").select("record_id", F.explode("concept_illustrated").alias("name"))
    parent = F.coalesce(F.col("subtopic.id"), F.col("topic.id"))
    out = edge(records.filter(parent.isNotNull()), me, part, parent)
    for more in (
        edge(records.filter("subtopic is not null and topic is not null"), F.col("subtopic.id"), part, F.col("topic.id")),
        edge(laws.filter(target.isNotNull()), me, F.when(F.col("record_type") == "RULE", "defines").otherwise("interprets"), target),
        edge(related, me, F.when(F.col("relation").isin(*RELATIONS), F.col("relation")).otherwise("related_to"), other),
        edge(illustrated, me, F.lit("illustrates"), record_id(F.lit("CONCEPT"), F.col("name"))),
    ):
        out = out.unionByName(more)
    out = out.filter("to_id is not null and from_id <> to_id")
    return out.groupBy("from_id", "relation", "to_id").agg(F.max("basis").alias("basis"))


def last_write(edges: DataFrame, order: str) -> DataFrame:
    """Of edges with the same ends and name the last by `order`."""
    w = Window.partitionBy("from_id", "relation", "to_id").orderBy(F.desc(order))
    return edges.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def relations_of(edges: DataFrame, node: str) -> DataFrame:
    return edges.filter((F.col("from_id") == node) | (F.col("to_id") == node))


def topics_of(records: DataFrame) -> DataFrame:
    """topic_id, name, parent_id of all topics and subtopics; of several names or parents the first by order stays."""
    own = ["doc_id", "section_index", "ord"]
    tops = records.filter("topic is not null").select(*own, F.col("topic.id").alias("topic_id"), F.col("topic.name").alias("name"), F.lit(None).cast("string").alias("parent_id"))
    subs = records.filter("subtopic is not null").select(*own, F.col("subtopic.id").alias("topic_id"), F.col("subtopic.name").alias("name"), F.col("topic.id").alias("parent_id"))
    seq = F.struct(*own)
    return tops.unionByName(subs).groupBy("topic_id").agg(F.max_by("name", seq).alias("name"), F.min_by("parent_id", seq).alias("parent_id"))


def store_records(library: Library, checked: DataFrame) -> DataFrame:
    """Puts checked records into the library with all that hangs on them: occurrences are kept, the records that they belong to are folded again in
    their fixed order, and records, evidence, entities, topics and relations are merged. Only touched records are folded and only touched buckets
    written, so that a batch that is stored twice gives the same tables. The folded records."""
    held = library.merge("occurrences", checked, ["record_id", "doc_id", "section_index", "ord"])
    touched = checked.select("record_id").distinct()
    folded = library.replace("folded", with_entities(merged_records(held.join(touched, "record_id", "left_semi"))))  # written once, read by all below
    library.merge("records", record_rows(folded), ["record_id"])
    library.merge("evidence", evidence_rows(folded), ["record_id", "evidence_id"])
    mentions = library.merge("mentions", entity_mentions(held.join(touched, "record_id", "left_semi")), ["record_id", "entity_id", "alias", "doc_id", "section_index", "ord"])
    named = entity_mentions(folded_order(folded)).select("entity_id").distinct()
    library.merge("entities", entities(mentions.join(named, "entity_id", "left_semi")), ["entity_id"])
    library.merge("topics", topics_of(folded_order(folded)), ["topic_id"], rules={"parent_id": "fill"})
    library.merge("relations", relations(folded), ["from_id", "relation", "to_id"])
    return folded


def folded_order(folded: DataFrame) -> DataFrame:
    """Folded records with the order columns of their first occurrence, also where the table has none."""
    missing = {c: F.lit(None).cast(t) for c, t in (("doc_id", "string"), ("section_index", "int"), ("ord", "int")) if c not in folded.columns}
    return folded.withColumns(missing) if missing else folded
