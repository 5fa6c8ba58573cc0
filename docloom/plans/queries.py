"""Registered queries: the operators on the tables of an input folder.

The tables hold no legal prose, so sections with identifiers are written from customers and nations by the same SQL here and in the oracle.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import ids, similarity, text
from ..operators import classify as cls
from ..operators import cleaning, export, headings, library, link, overlap, records, search, usage, validate
from ..operators import sections as sec
from ..operators import terms as trm
from ..sources.files import dealt

#: Portable SQL: runs in Spark and DuckDB alike. One section per customer; five kinds by turns.
LEGAL = """
SELECT concat('sec_', CAST(c_custkey AS STRING)) AS section_id, CAST(c_custkey AS BIGINT) AS num, concat('doc_', CAST(c_custkey % 97 AS STRING)) AS doc_id,
  CASE WHEN c_custkey % 29 = 0 THEN 'Index' ELSE concat('Section ', CAST(c_custkey % 50 AS STRING)) END AS title,
  concat(upper(substr(c_mktsegment, 1, 1)), lower(substr(c_mktsegment, 2))) AS seg, concat(upper(substr(n_name, 1, 1)), lower(substr(n_name, 2))) AS nat,
  CASE WHEN c_custkey % 31 = 0 THEN 'Too short.' WHEN c_custkey % 5 = 0 THEN concat('In Acme v. ', concat(upper(substr(n_name, 1, 1)), lower(substr(n_name, 2))), ', the court held that the plaintiff had no claim. The judgment was affirmed on 12 March 1999 and the bench gave its reasons in a short opinion that the parties accepted without more. ')
    WHEN c_custkey % 5 = 1 THEN concat('"', lower(c_mktsegment), ' levy" means a charge on goods. The doctrine refers to a principle of fairness that is known as equity in many places, and the definition is old and settled among those who write about such things. ')
    WHEN c_custkey % 5 = 2 THEN concat('Under Section ', CAST(c_custkey AS STRING), 'F the employer shall give notice and must pay unless the worker is exempt. Rule 7 is mandatory and no one is entitled to more than that under any condition precedent set out by the ministry in its notes. ')
    WHEN c_custkey % 5 = 3 THEN concat('For example a worker in ', lower(n_name), ' leaves early. Suppose the owner objects and the matter drags on for a year or more while both sides write letters to each other and wait for an answer that never comes in time. ')
    ELSE concat('Whereas ', lower(c_mktsegment), ' firms pay late, others differ from them and compare well. In contrast the rest is similarly placed on the other hand, though no one has yet looked at the numbers with any care or patience for detail. ') END AS text
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


def load(spark: SparkSession, d: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{d}/{n}.parquet") for n in names]


def legal_sections(spark: SparkSession, d: str) -> DataFrame:
    customer, nation = load(spark, d, "customer", "nation")
    rows = spark.sql(LEGAL.replace("FROM customer JOIN nation", "FROM {customer} JOIN {nation}"), customer=customer, nation=nation)
    return rows.withColumns({"token_estimate": text.estimate_tokens(F.col("text")), "has_tables": F.col("num") % 7 == 0})


def document_lines(spark: SparkSession, d: str) -> DataFrame:
    """documents as lines: pages of 40 lines, y from the place on the page, size and weight by the line's content."""
    (docs,) = load(spark, d, "documents")
    own = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    size = F.when(F.length("text") <= 40, 14.0).when(F.length("text") <= 80, 12.0).otherwise(11.0)
    return own.select("doc_id", F.floor(F.col("pos") / 40).cast("int").alias("page"), (F.col("pos") % 40).cast("int").alias("line_idx"), "text", size.alias("size"), (F.length("text") <= 30).alias("bold"), ((F.col("pos") % 40 + 0.5) / 40).alias("y"))


# ids, text


def content_ids(spark, d):
    (docs,) = load(spark, d, "documents")
    return docs.select("doc_id", ids.content_id(F.col("text")).alias("content_id"))


def content_duplicates(spark, d):
    own = content_ids(spark, d)
    return own.groupBy("content_id").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).filter("n > 1")


def token_estimate(spark, d):
    (docs,) = load(spark, d, "documents")
    return docs.select("doc_id", text.estimate_tokens(F.col("text")).alias("tokens"))


def text_quality_counts(spark, d):
    (docs,) = load(spark, d, "documents")
    return docs.select("doc_id", F.size(text.words(F.col("text"))).alias("words"), F.size(text.lettered_words(F.col("text"))).alias("lettered"))


def line_signatures(spark, d):
    return document_lines(spark, d).filter("text <> ''").groupBy(text.signature(F.col("text")).alias("signature")).agg(F.count("*").alias("n"))


def repeated_edges(spark, d):
    return cleaning.repeated_edges(document_lines(spark, d)).select("doc_id", "signature", "pages")


def clean_text_lengths(spark, d):
    lines = document_lines(spark, d)
    after = cleaning.clean_pages(lines).groupBy("doc_id").agg(F.sum("char_count").alias("after"))
    before = lines.groupBy("doc_id").agg(F.sum(F.length("text")).alias("before"))
    return before.join(after, "doc_id")


def telegraphic_notes(spark, d):
    (turns,) = load(spark, d, "conversations")
    return turns.select("conv_id", "turn", text.telegraphic(F.col("text")).alias("note"))


# terms, classes


def keyword_counts(spark, d):
    return cls.keyword_counts(legal_sections(spark, d)).select("section_id", *[f"{k.lower()}_words" for k in cls.TYPES])


def class_scores(spark, d):
    own = cls.raw_scores(legal_sections(spark, d))
    return own.select("section_id", *[F.round(F.col(f"raw_{k.lower()}") * 100000.0 / F.col("token_estimate")).cast("long").alias(f"{k.lower()}_x100") for k in cls.TYPES])


def class_types(spark, d):
    own = cls.classify(legal_sections(spark, d))
    return own.select("section_id", F.array_join("types", ",").alias("types"), "unclear")


def skip_reasons(spark, d):
    return cls.classify(legal_sections(spark, d)).select("section_id", "skip_reason")


def class_summary(spark, d):
    """The flagship: sections and documents by first type and reason to skip."""
    (docs,) = load(spark, d, "documents")
    own = docs.select(F.concat(F.lit("text_"), F.col("doc_id").cast("string")).alias("section_id"), F.lit("").alias("title"), "text", text.estimate_tokens(F.col("text")).alias("token_estimate"), F.lit(False).alias("has_tables"))
    both = dealt(legal_sections(spark, d)).select(*own.columns).unionByName(dealt(own))
    found = cls.classify(both)
    return found.groupBy(F.coalesce(F.get("types", F.lit(0)), F.lit("")).alias("first_type"), F.coalesce("skip_reason", F.lit("")).alias("skip_reason")).agg(F.count("*").alias("n"))


def legal_terms(spark, d):
    return trm.terms(legal_sections(spark, d), "section_id")


def term_keys(spark, d):
    customer, nation = load(spark, d, "customer", "nation")
    own = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    names = own.select(F.explode(F.array(
        F.struct(F.lit("case_name").alias("kind"), F.concat(F.lit("The "), F.initcap("c_mktsegment"), F.lit(" Company  vs. "), F.initcap("n_name"), F.lit(" Private Limited,")).alias("value")),
        F.struct(F.lit("provision").alias("kind"), F.concat(F.lit("S. "), F.col("c_custkey").cast("string"), F.lit("-F")).alias("value")),
    )).alias("t")).select("t.*").distinct()
    return names.select("kind", "value", trm.normalise(F.col("kind"), F.col("value")).alias("normal"), trm.term_key(F.col("kind"), F.col("value")).alias("term_key"))


def protected_terms(spark, d):
    return trm.protected_terms(legal_terms(spark, d), "section_id").select("section_id", "kind", "term_key", "mentions", "display")


# structure


def body_size(spark, d):
    return headings.body_size(document_lines(spark, d))


def part_titles(spark, d):
    """Parts as heading texts: labels of every kind by turns."""
    (part,) = load(spark, d, "part")
    k = F.col("p_partkey")
    label = F.element_at(F.array(F.concat(k % 9 + 1, F.lit(" ")), F.concat(k % 9 + 1, F.lit("."), k % 5 + 1, F.lit(" ")), F.concat(F.lit("Chapter "), k % 20 + 1, F.lit(": ")), F.lit("(a) "), F.lit("")), (k % 5 + 1).cast("int"))
    return part.select("p_partkey", F.concat(label, "p_type", F.when(k % 7 == 0, ",").otherwise("")).alias("title"))


def heading_texts(spark, d):
    own, t = part_titles(spark, d), F.col("title")
    return own.select("p_partkey", headings.strip_numbering(t).alias("bare"), headings.numbering_depth(t).cast("int").alias("depth"), headings.heading_like(t).alias("heading"), headings.is_caps(t).alias("caps"))


def bookmark_headings(spark, d):
    """Part titles as bookmarks of their brands' documents, lines that repeat some of them on the same page."""
    (part,) = load(spark, d, "part")
    toc = part.select(F.col("p_brand").alias("doc_id"), F.col("p_partkey").alias("ord"), (F.col("p_size") % 5).alias("level"), F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("title"), F.col("p_partkey").alias("page"))
    lines = part.select(F.col("p_brand").alias("doc_id"), F.col("p_partkey").alias("page"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("line_idx"), "p_name", "p_size")
    lines = lines.select("doc_id", "page", "line_idx", F.when((F.col("line_idx") == 2) & (F.col("p_size") % 2 == 0), F.col("p_name")).otherwise(F.lit("0")).alias("text"))
    documents = part.groupBy(F.col("p_brand").alias("doc_id")).agg(F.max("p_partkey").alias("page_count"))  # a part a page: the last one ends the document
    return headings.bookmarks_to_headings(headings.clean_bookmarks(toc, documents), lines).select("doc_id", "page", "level", "title", "line_idx")


def event_headings(spark, d):
    """events as headings: a user's events in order of time, levels from the event type."""
    (events,) = load(spark, d, "events")
    level = F.length("event_type") % 4 + 1
    return events.select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("n"), level.alias("level"), F.col("event_type").alias("title"))


def normalised_levels(spark, d):
    return headings.normalise_levels(event_headings(spark, d)).select("doc_id", "n", "level")


def parent_heading(spark, d):
    own = headings.topic_tree(headings.normalise_levels(event_headings(spark, d)).withColumn("page", F.lit(1)), 10)
    numbers = own.select(F.col("node_id").alias("parent_id"), F.col("n").alias("parent_n"))
    return own.join(numbers, "parent_id", "left").select("doc_id", "n", "level", "parent_n")


def topic_paths(spark, d):
    own = headings.topic_paths(headings.normalise_levels(event_headings(spark, d)), 4)
    return own.filter("level <= 4").select("doc_id", "n", F.array_join("topic_path", " > ").alias("path"))


def block_assignment(spark, d):
    """Lines of each block of the documents, headings being lines of at most 30 characters."""
    lines = document_lines(spark, d)
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "line_idx")) - 1
    heads = lines.filter("bold").select("doc_id", n.alias("n"), "page", "line_idx", text.strip(F.col("text")).alias("title"), F.array("text").alias("topic_path"))
    titles = lines.select("doc_id", F.lit("document").alias("title")).distinct()
    return sec.block_lines(lines, heads, titles).groupBy("doc_id", "block").agg(F.count("*").alias("n_lines"))


def detected_headings(spark, d):
    return headings.topic_paths(headings.find_headings(document_lines(spark, d))).select("doc_id", "n", "level", "title", "page", "line_idx", F.array_join("topic_path", " > ").alias("path"))


def section_pieces(spark, d):
    lines = document_lines(spark, d)
    heads = headings.topic_paths(headings.find_headings(lines))
    titles = lines.select("doc_id", F.concat(F.lit("Document "), "doc_id").alias("title")).distinct()
    cast = lambda df: df.withColumn("doc_id", F.col("doc_id").cast("string"))
    own = sec.make_sections(cast(lines), cast(heads), cast(titles), sizes=sec.Sizes(600, 900, 50, 40))
    return own.select("section_id", "doc_id", "index", "title", "page_start", "page_end", "token_estimate")


def page_ranges(spark, d):
    (lineitem,) = load(spark, d, "lineitem")
    return export.page_ranges(lineitem, "l_partkey", "l_linenumber").withColumnRenamed("l_partkey", "part")


# overlap


def plain_words(text_column):
    return F.filter(F.split(F.lower(text_column), r"[^a-z0-9]+"), lambda w: w != "")


def _texts_and_benchmark(spark, d):
    docs, bench = load(spark, d, "documents", "benchmark")
    return dealt(docs).select("doc_id", plain_words(F.col("text")).alias("words")), bench.select("item_id", plain_words(F.col("text")).alias("words"))


def ngram_containment(spark, d):
    docs, bench = _texts_and_benchmark(spark, d)
    return overlap.gram_containment(docs, bench, "doc_id")


def longest_shared_run(spark, d):
    docs, bench = _texts_and_benchmark(spark, d)
    return overlap.longest_shared_runs(docs, bench, "doc_id", "item_id")


def interval_merge(spark, d):
    (orders,) = load(spark, d, "orders")
    own = orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("start_day"), F.date_add(F.col("o_orderdate").cast("date"), 60).alias("end_day"))
    return overlap.merged_intervals(own, "o_custkey", "start_day", "end_day")


def best_sentence(spark, d):
    """Each answer against the sentences of the question before it."""
    (turns,) = load(spark, d, "conversations")
    question = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("source"))
    own = turns.join(question, ["conv_id", "turn"]).withColumns({"texts": F.array("text"), "exact": F.array().cast("array<string>")})
    return overlap.check_overlap(own).select("conv_id", "turn", "overlap.max_run", "overlap.ratio", "overlap.sentence_similarity")


# records and validation


def extracted(spark, d):
    """Items, composed statements and sections for the record builder, written from the legal sections."""
    own = legal_sections(spark, d).withColumns({"index": (F.col("num") % 1000).cast("int"), "topic_path": F.array("nat", "seg"), "page_start": (F.col("num") % 90 + 1).cast("int")}).withColumn("page_end", F.col("page_start") + 1)
    kind = F.element_at(F.array(*map(F.lit, ("CASE", "CONCEPT", "RULE", "EXAMPLE", "COMPARISON"))), (F.col("num") % 5 + 1).cast("int"))
    name = F.when(kind == "CASE", F.concat(F.lit("Acme vs. "), "nat")).otherwise(F.concat("seg", F.lit(" levy")))
    identifier = lambda k, v, when: F.when(when, F.struct(F.lit(k).alias("kind"), v.alias("value"), F.lit("").alias("role"), F.array("page_start").alias("pages")))
    found = F.filter(F.array(identifier("case_name", name, kind == "CASE"), identifier("date", F.lit("12 March 1999"), kind == "CASE"), identifier("provision", F.concat(F.lit("S. "), "num", F.lit("-F")), kind == "RULE")), lambda x: x.isNotNull())
    fact = lambda i, note: F.struct(F.lit(i).alias("id"), F.lit("fact").alias("fact_type"), note.alias("note"), F.array(F.col("page_start"), F.lit(999)).alias("pages"), F.lit("explicit").alias("support"), F.lit(False).alias("proprietary"))
    none = F.expr("cast(array() as array<struct<name:string,type:string,relation:string>>)")
    items = own.select("section_id", F.lit(0).alias("ord"), F.lit("i1").alias("key"), kind.alias("record_type"), name.alias("name"), F.lit("").alias("heading"), found.alias("identifiers"), F.array(fact("f1", F.concat(F.lit("claims fail in "), "nat")), fact("f2", F.concat("seg", F.lit(" firms pay a charge")))).alias("facts"), none.alias("related"), F.lit(False).alias("proprietary"), F.lit("").alias("proprietary_reason"), F.lit("").alias("quoted_provision"))
    statement = lambda f, t, cited: F.struct(F.lit(f).alias("field"), t.alias("text"), F.lit("source").alias("basis"), F.array(*map(F.lit, cited)).alias("facts"))
    composed = own.select("section_id", F.lit("i1").alias("key"), F.array(statement("key_points", F.concat(F.lit("Claims fail in "), "nat"), ["[F1]"]), statement("definition", F.concat(F.lit("A charge that "), "seg", F.lit(" firms pay")), [])).alias("statements"),
        F.array(F.struct(F.lit("Early").alias("subject"), F.lit("pay").alias("attribute"), F.lit("none").alias("value"), F.array(F.lit("2")).alias("facts"))).alias("comparison_items"), F.array(F.concat("seg", F.lit(" levy"))).alias("concept_illustrated"))
    return items, composed, own


def built(spark, d):
    items, composed, own = extracted(spark, d)
    return records.single_statements(records.build_records(records.repaired_items(items), composed, own)), own


def built_records(spark, d):
    own, _ = built(spark, d)
    return own.select("record_id", "record_type", "section_id", "case_name", F.size("statements").alias("n_statements"), F.size("evidence").alias("n_evidence"), F.col("topic.id").alias("topic_id"), F.col("subtopic.id").alias("subtopic_id"))


def validated_records(spark, d):
    own, sections = built(spark, d)
    return validate.validate(own, sections).select("record_id", "section_id", "status", F.array_join("review_reasons", "; ").alias("reasons"), "similarity")


def merged_records(spark, d):
    own, _ = built(spark, d)
    return link.merged_records(own).select("record_id", "record_type", "n_merged", F.size("statements").alias("n_statements"), F.size("evidence").alias("n_evidence"))


def entity_registry(spark, d):
    """Nations as entities: spellings of customers' nations by segment, first spelling kept."""
    customer, nation = load(spark, d, "customer", "nation")
    own = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    mentions = own.select(F.col("n_name").alias("entity_id"), F.lit("STATUTE").alias("entity_type"), F.concat(F.lower("c_mktsegment"), F.lit(" code")).alias("canonical"), F.concat(F.lower("c_mktsegment"), F.lit(" code")).alias("alias"), F.col("c_custkey").alias("seq"))
    return link.entities(mentions, ("seq",)).select("entity_id", "canonical", F.size("aliases").alias("n_aliases"), F.array_join("aliases", ", ").alias("aliases"))


def record_relations(spark, d):
    own, _ = built(spark, d)
    return link.relations(own)


def relation_edges(spark, d):
    lineitem, orders = load(spark, d, "lineitem", "orders")
    own = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return own.select(F.concat(F.lit("c"), "o_custkey").alias("from_id"), F.when(F.col("l_returnflag") == "R", "distinguishes").otherwise("cites").alias("relation"), F.concat(F.lit("s"), "l_suppkey").alias("to_id"), F.col("o_orderstatus").alias("basis"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))


def relation_dedupe(spark, d):
    return link.last_write(relation_edges(spark, d), "seq").select("from_id", "relation", "to_id", "basis")


def relations_of(spark, d):
    return link.relations_of(relation_dedupe(spark, d), "s7")


# validation on plain tables


def broken_evidence(spark, d):
    """Built records of which every seventh has lost its second piece of evidence."""
    own, _ = built(spark, d)
    number = F.regexp_extract("section_id", r"(\d+)", 1).cast("long")
    return records.broken_evidence(own.withColumn("evidence", F.when(number % 7 == 0, F.slice("evidence", 1, 1)).otherwise(F.col("evidence")))).select("record_id", "section_id", "pos", "evidence")


def pages_outside_section(spark, d):
    (lineitem,) = load(spark, d, "lineitem")
    own = lineitem.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_set("l_linenumber")), lambda p: p).alias("pages"))
    rows = own.select("l_orderkey", F.array(F.struct(F.concat(F.lit("e"), "l_orderkey").alias("id"), F.lit("d").alias("doc_id"), "pages")).alias("evidence"), F.expr("cast(array() as array<struct<text:string,basis:string,evidence:array<string>>>)").alias("statements"), F.lit("d").alias("section_doc"), F.lit(1).alias("page_start"), F.lit(5).alias("page_end"))
    return rows.select("l_orderkey", F.explode(validate.grounding_errors()).alias("error"))


def identifier_support(spark, d):
    """Which segment names stand, loosely spelled, in the legal sections of their nation."""
    own = legal_sections(spark, d)
    return own.select("section_id", F.contains(text.loose(F.col("text")), text.loose(F.col("nat"))).alias("has_nation"), F.contains(text.loose(F.col("text")), text.loose(F.concat("seg", F.lit(" levy")))).alias("has_levy"))


def verdicts(spark, d):
    (lineitem,) = load(spark, d, "lineitem")
    reasons = F.when(F.col("l_linenumber") == 7, F.array(F.lit("r"))).otherwise(F.array().cast("array<string>"))
    for_attempt = lambda a: validate.verdict(F.col("l_discount") < 0.1, F.col("l_tax") < 0.08, F.col("l_quantity") > 1, F.col("l_returnflag") != "R", reasons, a)
    return lineitem.groupBy(for_attempt(0).alias("first"), for_attempt(1).alias("again")).agg(F.count("*").alias("n"))


def statements_check(spark, d):
    own, _ = built(spark, d)
    return own.select("section_id", F.array_join(validate.schema_errors(), "; ").alias("errors"))


# library


def topic_tree_counts(spark, d):
    region, nation, customer = load(spark, d, "region", "nation", "customer")
    topics = region.select(F.concat(F.lit("r"), "r_regionkey").alias("topic_id"), F.col("r_name").alias("name"), F.lit(None).cast("string").alias("parent_id"))
    topics = topics.unionByName(nation.select(F.concat(F.lit("n"), "n_nationkey").alias("topic_id"), F.col("n_name").alias("name"), F.concat(F.lit("r"), "n_regionkey").alias("parent_id")))
    own = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("r"), "n_regionkey").alias("topic_id"), F.concat(F.lit("n"), "n_nationkey").alias("subtopic_id"))
    return library.topic_tree(topics, own)


def stage_events(spark, d):
    (events,) = load(spark, d, "events")
    status = F.when(F.col("event_type") == "view", "running").when(F.col("event_type") == "error", "failed").otherwise("done")
    return events.select(F.col("user_id").alias("doc_id"), F.col("event_type").alias("stage"), (F.col("event_id") % 50).alias("unit_id"), status.alias("status"), "event_id")


def _state(spark, d):
    """Per user and unit, whatever the event type."""
    return library.stage_state(stage_events(spark, d).withColumn("stage", F.lit("extract")))


def upsert_latest(spark, d):
    return _state(spark, d)


def stage_summary(spark, d):
    return library.stage_summary(_state(spark, d).withColumn("stage", F.concat(F.lit("s"), F.col("unit_id") % 4)))


def recover_interrupted(spark, d):
    own = library.recovered(_state(spark, d).withColumn("error", F.lit(None).cast("string")))
    return own.groupBy("status", F.coalesce("error", F.lit("")).alias("error")).agg(F.count("*").alias("n"))


def todo_units(spark, d):
    own = _state(spark, d)
    return library.to_do(own.select("doc_id", "stage", "unit_id"), own)


def review_pending(spark, d):
    docs, labels = load(spark, d, "documents", "labels")
    queue = labels.join(docs, "doc_id").select(F.col("doc_id").alias("review_id"), F.when((F.col("quality") == 0) | (F.col("toxic") == 1), "pending").otherwise("approved").alias("status"), F.col("n_chars").alias("created_at"), "source")
    return library.reviews(queue).select("review_id", "source", "created_at")


def merged_library(spark, d):
    """Customers upserted with their orders' totals: balances kept, priority filled."""
    customer, orders = load(spark, d, "customer", "orders")
    table = customer.select("c_custkey", "c_name", F.col("c_acctbal").alias("amount"))
    updates = orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("priority"), F.col("o_orderkey").alias("at"))
    return library.merged(table, updates, ["c_custkey"], "at", {"amount": "keep"}).select("c_custkey", "c_name", "amount", "priority")


# search


QUERY = "mit license"


def keyword_and(spark, d):
    (docs,) = load(spark, d, "documents")
    return search.scan_search(dealt(docs), "doc_id", ("source", "text"), QUERY, limit=None).select("doc_id")


def bm25_top(spark, d):
    (docs,) = load(spark, d, "documents")
    own = search.scan_search(dealt(docs), "doc_id", ("source", "text"), QUERY)
    return own.select("doc_id", F.round("score", 6).alias("score"))


def phrase_search(spark, d):
    """The inverted index: turns of conversations that hold two words one after the other."""
    (turns,) = load(spark, d, "conversations")
    own = turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "role", "text")
    postings = search.index(own, "id", ("role", "text"))
    return search.keyword_search(postings, search.lengths(postings, "id"), own.count(), "id", "user the-of", limit=None).select("id", F.round("score", 6).alias("score"))


def search_snippets(spark, d):
    (docs,) = load(spark, d, "documents")
    return search.snippets(keyword_and(spark, d).join(docs, "doc_id"), "text", QUERY).select("doc_id", "snippet")


def vector_topk(spark, d):
    (vectors,) = load(spark, d, "embeddings")
    query = vectors.filter("vec_id = 7").first()
    own = search.vector_search(vectors, "vec_id", "embedding", query["embedding"] if query else [], 10 if query else 0)
    return own.select("vec_id", F.round("score", 5).alias("score"))


def vector_topk_each(spark, d):
    """The whole set of searches: every row whose id is divisible by 20 against all rows."""
    (vectors,) = load(spark, d, "embeddings")
    own = search.vector_search_each(vectors, vectors.filter("vec_id % 20 = 0"), "vec_id", "embedding")
    return own.select(F.col("query").alias("query_id"), "vec_id", F.round("score", 5).alias("score"))


# usage and exports


def usage_cost(spark, d):
    (events,) = load(spark, d, "events")
    own = events.select(F.col("event_type").alias("model"), F.lit(1).alias("calls"), F.col("user_id").alias("input_tokens"), (F.col("event_id") % 100).alias("output_tokens"), (F.col("event_id") % 7).alias("cache_read_tokens"), (F.col("event_id") % 3).alias("cache_write_tokens"))
    prices = spark.createDataFrame([("view", 4.0, 20.0), ("click", 2.0, 10.0), ("error", 1.0, 5.0)], "model string, input_per_m double, output_per_m double")
    return usage.usage_cost(own, prices)


def cost_estimate(spark, d):
    own = legal_sections(spark, d)
    own = own.withColumn("skip_reason", cls.skip_reason(F.col("title"), F.col("text"), F.col("token_estimate")))
    return usage.cost_estimate(own, (2.0, 10.0), (4.0, 20.0))


def run_totals(spark, d):
    (orders,) = load(spark, d, "orders")
    own = orders.select(F.lit(1).alias("sections"), F.length("o_orderpriority").alias("skipped"), (F.col("o_orderkey") % 5).alias("stored"))
    return usage.run_totals(own, ("sections", "skipped", "stored"))


def export_sources(spark, d):
    """Orders as records, their lines as evidence: parts as documents, line numbers as pages."""
    lineitem, part = load(spark, d, "lineitem", "part")
    evidence = lineitem.select(F.col("l_orderkey").alias("record_id"), F.col("l_linenumber").alias("pos"), F.col("l_partkey").alias("doc_id"), F.col("l_linenumber").alias("page"))
    own = export.sources(evidence, part.select(F.col("p_partkey").alias("doc_id"), F.col("p_name").alias("filename")))
    first = F.get("sources", F.lit(0))
    return own.select("record_id", first["document_id"].alias("first_doc"), first["original_file"].alias("first_file"), first["page_start"].alias("page_start"), first["page_end"].alias("page_end"), (F.size("sources") - 1).alias("n_more"))


def checked_records(spark, d):
    own, sections = built(spark, d)
    checked = validate.validate(own, sections).filter("status <> 'REGENERATE'")
    return checked, sections.select("doc_id", F.concat("doc_id", F.lit(".pdf")).alias("filename")).distinct()


def written_once(rows: DataFrame) -> DataFrame:
    """Rows that an export reads twice, for their content and for their sources, on the executors' disks: they are built and checked once. Without what
    no export shows."""
    hidden = ("overlap", "identifiers", "errors", "warnings", "copied", "reasons")
    return rows.drop(*hidden).localCheckpoint(storageLevel=StorageLevel.DISK_ONLY)


def knowledge_export(spark, d):
    checked, files = checked_records(spark, d)
    out = export.knowledge_records(written_once(checked), files)
    return out.select("record_id", "content_type", "title", "topic", "subtopic", "knowledge", F.col("source.document_id").alias("document"), F.col("source.page_start").alias("page_start"), F.col("validation.reason").alias("reason"))


def export_overview(spark, d):
    own, _ = built(spark, d)
    return export.overview(own.withColumn("status", F.when(F.col("record_type") == "RULE", "HUMAN_REVIEW").otherwise("PASS"))).select("record_id", "type", "title", "topic", "subtopic", "documents", "pages", "proprietary", "needs_review")


def merged_knowledge(spark, d):
    """What is exported of checked records that were merged."""
    checked, files = checked_records(spark, d)
    out = export.knowledge_records(written_once(link.merged_records(checked)), files)
    return out.select("record_id", "content_type", F.col("validation.status").alias("status"), (F.size("additional_sources") + 1).alias("n_sources"))


def contents(spark, d):
    (part,) = load(spark, d, "part")
    own = part.select(F.col("p_brand").alias("topic"), F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_type")).alias("subtopic"))
    return export.topic_counts(own)


# small functions and the store


def small_functions(spark, d):
    (part,) = load(spark, d, "part")
    name, k = F.col("p_name"), F.col("p_partkey")
    return part.select(
        "p_partkey", text.clean_title(F.concat(F.regexp_replace(name, " ", "__"), F.lit(" "), k)).alias("title"), text.note_id(F.concat(F.lit("[F-"), k, F.lit("]"))).alias("note"), text.date_precision(F.when(k % 2 == 0, F.lit("1978")).otherwise("12 March 1978")).alias("precision"),
        text.page_marker(k).alias("marker"), text.format_table(F.array(F.array(name, F.lit(None)), F.array("p_brand", "p_type"))).alias("table"), text.text_quality(F.concat(name, F.lit(" 12 x"))).alias("quality"),
        text.needs_ocr(F.substring(name, 1, 40), F.col("p_size") / 100).alias("scan"), text.image_coverage(F.array(F.col("p_size") * 1.0, F.lit(30.0)).cast("array<double>"), F.lit(64.0)).alias("images"),
    )


def table_cells(spark, d):
    """Nations as tables: the first row names subjects, the first column attributes."""
    (nation,) = load(spark, d, "nation")
    rows = F.array(F.array(F.lit(""), F.col("n_name"), F.lit("All")), F.array(F.lit("key"), F.col("n_nationkey").cast("string"), F.lit("")), F.array(F.lit("region"), F.col("n_regionkey").cast("string"), F.lit(" 9 ")))
    return records.table_triples(nation.select(F.col("n_nationkey").alias("table_id"), rows.alias("rows")))


def entity_ids(spark, d):
    (customer,) = load(spark, d, "customer")
    kinds = F.explode(F.array(*map(F.lit, ("CASE", "STATUTE", "PROVISION", "COURT"))))
    own = customer.select("c_custkey", kinds.alias("entity_type"), "c_name")
    return own.select("c_custkey", "entity_type", link.entity_id(F.col("entity_type"), F.concat(F.lit("The "), "c_name", F.lit(" Act"))).alias("entity_id"))


def law_entities(spark, d):
    own, _ = built(spark, d)
    return link.with_entities(own.filter("record_type = 'RULE'")).select("section_id", F.explode("laws").alias("law")).select("section_id", "law.provision", "law.entity_id")


def record_topics(spark, d):
    own, _ = built(spark, d)
    return link.topics_of(own)


def record_counts(spark, d):
    own, _ = built(spark, d)
    return library.counts(own, "record_type")


def record_evidence(spark, d):
    own, _ = built(spark, d)
    return link.merged_evidence(own)


def requests(spark, d):
    """Lengths of the first requests, and the lines of notes that the second one shows."""
    items, _, own = extracted(spark, d)
    first = records.extract_request(own.withColumns({"types": F.array("seg"), "prompt": F.lit(None).cast("string")})).select("section_id", F.length("request").alias("n"))
    notes = records.note_for_composer(records.repaired_items(items), own).groupBy("section_id").agg(F.array_join(F.array_sort(F.collect_list("line")), " ").alias("notes"))
    return first.join(notes, "section_id")


def _units(spark, d):
    (orders,) = load(spark, d, "orders")
    return orders.select(F.col("o_custkey").cast("string").alias("doc_id"), F.lit("extract").alias("stage"), F.col("o_orderkey").cast("string").alias("unit_id"), F.concat(F.lit("e"), "o_orderkey").alias("error"), F.when(F.col("o_orderkey") % 2 == 0, "out").alias("output_path"), F.col("o_orderdate").alias("updated_at"), "o_orderkey")


def stage_cycle(spark, d):
    """Units started, every third started again, every fifth failed, the others done, those of one document reset."""
    units = _units(spark, d)
    state = library.started(library.started(None, units), units.filter("o_orderkey % 3 = 0"))
    state = library.finished(library.finished(state, units.filter("o_orderkey % 5 = 0"), "failed"), units.filter("o_orderkey % 5 <> 0"), "done")
    return library.reset(state, "7").select("doc_id", "unit_id", "status", "attempts", F.when(F.col("status") == "failed", F.col("error")).alias("error"), "output_path")


def stage_failures(spark, d):
    units = _units(spark, d)
    state = library.finished(library.finished(None, units.filter("o_orderkey % 5 = 0"), "failed"), units.filter("o_orderkey % 5 <> 0"), "done")
    return library.failures(state).select("doc_id", "unit_id", "error")


def documents_by_status(spark, d):
    (docs,) = load(spark, d, "documents")
    own = docs.select("doc_id", F.when(F.col("n_chars") > 1000, "done").otherwise("failed").alias("status"), F.col("n_chars").alias("added_at"))
    changed = own.filter("doc_id % 10 = 0").select("doc_id", F.lit("pending").alias("status"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("timestamp").alias("updated_at"))
    return library.documents_by_status(library.with_status(own, changed), "failed").select("doc_id", "status")


QUERIES = (
    content_ids, content_duplicates, token_estimate, text_quality_counts, line_signatures, repeated_edges, clean_text_lengths, telegraphic_notes, keyword_counts, class_scores, class_types, skip_reasons, class_summary, legal_terms, term_keys, protected_terms,
    body_size, heading_texts, bookmark_headings, normalised_levels, parent_heading, topic_paths, block_assignment, detected_headings, section_pieces, page_ranges, ngram_containment, longest_shared_run, interval_merge, best_sentence, built_records, validated_records, merged_records,
    entity_registry, record_relations, relation_dedupe, relations_of, broken_evidence, pages_outside_section, identifier_support, verdicts, statements_check, topic_tree_counts, upsert_latest, stage_summary, recover_interrupted, todo_units, review_pending, merged_library,
    keyword_and, bm25_top, phrase_search, search_snippets, vector_topk, vector_topk_each, usage_cost, cost_estimate, run_totals, export_sources, knowledge_export, export_overview, merged_knowledge, contents,
    small_functions, table_cells, entity_ids, law_entities, record_topics, record_counts, record_evidence, requests, stage_cycle, stage_failures, documents_by_status,
)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}
