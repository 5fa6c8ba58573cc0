"""Sections, classes, copying, records, verdicts, links, the library and exports on small fixtures."""

import pytest
from pyspark.sql import functions as F

from docloom.operators import classify, export, headings, library, link, overlap, records, search, sections, usage, validate

SOURCE = "[[p. 3]]\nThe tribunal found that the worker had been dismissed without any notice and that the employer never paid the compensation that was due to him."


def book(spark, repeat=4):
    lines = []

    def page(n, *rows):
        for i, (text, size, bold) in enumerate(rows):
            lines.append(("d1", n, i, text, size, bold, 0.2 + 0.6 * i / max(1, len(rows))))

    body = [(f"Body sentence number {k} of the chapter goes on for a while.", 11.0, False) for k in range(repeat)]
    page(1, ("Chapter 1 Retrenchment", 18.0, True), *body)
    page(2, ("1.1 Meaning of Retrenchment", 13.0, True), *body)
    page(3, ("Chapter 2 Strikes", 18.0, True), ("and Lock-outs", 18.0, True), *body)
    page(4, ("2.2 Lock-outs", 13.0, True), *body)
    return spark.createDataFrame(lines, "doc_id string, page int, line_idx int, text string, size double, bold boolean, y double")


def titles(spark):
    return spark.createDataFrame([("d1", "Book")], "doc_id string, title string")


def test_headings_and_sections(spark):
    lines = book(spark)
    found = headings.topic_paths(headings.find_headings(lines)).orderBy("n").collect()
    assert [(h.level, h.title) for h in found] == [(1, "Chapter 1 Retrenchment"), (2, "1.1 Meaning of Retrenchment"), (1, "Chapter 2 Strikes and Lock-outs"), (2, "2.2 Lock-outs")]
    assert found[3].topic_path == ["Chapter 2 Strikes and Lock-outs", "2.2 Lock-outs"]
    heads = headings.topic_paths(headings.find_headings(lines))
    got = sections.make_sections(lines, heads, titles(spark), sizes=sections.Sizes(600, 900, 5, 10)).orderBy("index").collect()
    assert [tuple(s.topic_path) for s in got] == [("Chapter 1 Retrenchment",), ("Chapter 1 Retrenchment", "1.1 Meaning of Retrenchment"), ("Chapter 2 Strikes and Lock-outs",), ("Chapter 2 Strikes and Lock-outs", "2.2 Lock-outs")]
    assert got[0].text.startswith("[[p. 1]]\n") and got[0].page_start == got[0].page_end == 1
    tables = spark.createDataFrame([("d1", 4, 0, "| a | b |\n| 1 | 2 |")], "doc_id string, page int, table_idx int, text string")
    got = sections.make_sections(lines, heads, titles(spark), tables, sections.Sizes(600, 900, 5, 10)).filter("has_tables").collect()
    assert len(got) == 1 and got[0]["index"] == 3 and "[TABLE [[p. 4]]]\n| a | b |" in got[0].text
    tree = headings.topic_tree(heads).orderBy("n").collect()
    assert tree[1].parent_id == tree[0].node_id and tree[0].parent_id == tree[2].parent_id != tree[0].node_id


def test_long_sections_are_split(spark):
    lines = book(spark, 120)
    heads = headings.topic_paths(headings.find_headings(lines))
    got = sections.make_sections(lines, heads, titles(spark), sizes=sections.Sizes(600, 900, 50, 40)).collect()
    parts = [s for s in got if "(part " in s.title]
    assert len(parts) >= 8 and all(s.token_estimate <= 1200 for s in got)
    assert sorted(s["index"] for s in got) == list(range(len(got)))


def test_small_blocks_merge():
    block = lambda t, path, n: sections.Block(t, path, [(1, "x" * 40)] * n, [])
    sizes = sections.Sizes(600, 900, 50, 40)
    out = sections.merged([block("Book", ["Book"], 1), block("A", ["A"], 30), block("A.1", ["A", "A.1"], 2), block("A.1 more", ["A", "A.1"], 2)], sizes)
    assert [b.title for b in out] == ["A", "A.1 more"] and out[1].path == ["A", "A.1"]
    assert list(sections.cuts([10] * 5, [False] * 5, sections.Sizes(5, 9, 1, 0)))[0] == (0, 2)


def test_classes(spark):
    rows = [
        ("c", "Section 1", "In Smith v. Jones Co, the court held that the plaintiff won. " * 3 + "word " * 40, 60, False),
        ("r", "Section 2", "Under Section 25F the employer shall pay and must give notice unless exempt. " * 3 + "word " * 40, 60, False),
        ("x", "Index", "word " * 80, 100, False),
        ("s", "Section 3", "short", 3, False),
        ("t", "Section 4", "\n".join(f"Chapter {i} ........ {i}" for i in range(29)), 150, False),
        ("p", "Section 5", "nothing of note here " * 30, 150, True),
        ("v", "Section 6", "In our view the form 12 is useful. Practice tip: use it. " + "plain " * 60, 100, False),
    ]
    got = {r.section_id: r for r in classify.classify(spark.createDataFrame(rows, "section_id string, title string, text string, token_estimate int, has_tables boolean")).collect()}
    assert got["c"].types[0] == "CASE" and got["r"].types[0] == "RULE" and got["p"].types == ["COMPARISON"]
    assert (got["x"].skip_reason, got["s"].skip_reason, got["t"].skip_reason) == ("front/back matter (Index)", "too short", "table of contents")
    assert got["v"].types == ["CONCEPT"] and got["v"].unclear and got["v"].signals == ["form 12", "in our view", "practice tip"]


def test_overlap_measure():
    copied = ["the worker had been dismissed without any notice and that the employer never paid the compensation"]
    run, ratio, near, sentence, phrases = overlap.measure(copied, SOURCE)
    assert run == 16 and ratio == 1.0 and near > 0.7 and sentence == copied[0] and phrases == copied
    assert overlap.measure(["A person lost a job and got nothing for it"], SOURCE)[:2] == (1, 0.0) or overlap.measure(["A person lost a job and got nothing for it"], SOURCE)[0] <= 2
    masked = overlap.masked_words("Under Section 25F the res judicata rule of Smith v. Jones Co applies", overlap.SOURCE)
    assert masked == ["under", overlap.SOURCE, "the", overlap.SOURCE, "rule", "of", overlap.SOURCE, "applies"]
    assert overlap.merged_spans([(5, 9), (0, 3), (3, 4)]) == [(0, 4), (5, 9)]


def test_longest_run_equals_plain_search():
    import random

    rng = random.Random(1)
    for _ in range(100):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 12))] for _ in range(2))
        want = max((n for i in range(len(a)) for n in range(1, len(a) - i + 1) if any(a[i : i + n] == b[j : j + n] for j in range(len(b)))), default=0)
        assert overlap.longest_common_run(a, b)[0] == want


def case_item(**change):
    note = lambda i, text, pages, support="explicit": {"id": i, "fact_type": "fact", "note": text, "pages": pages, "support": support, "proprietary": False}
    named = lambda k, v, role="": {"kind": k, "value": v, "role": role, "pages": [3]}
    item = {
        "section_id": "s1", "ord": 0, "key": "k1", "record_type": "CASE", "name": "Roe vs. Acme Ltd.", "heading": "",
        "identifiers": [named("case_name", "Roe vs. Acme Ltd."), named("citation", "109 F3d 642"), named("court", "Supreme Court of India"), named("date", "1978"), named("provision", "S. 25-F", "Industrial Disputes Act"), named("party", "Roe", "plaintiff")],
        "facts": [note("f1", "worker dismissed without notice", [3]), note("f2", "compensation never paid", [3, 99]), note("f3", "maybe bad faith", [4], "inferred")],
        "related": [], "proprietary": False, "proprietary_reason": "", "quoted_provision": "",
    }
    return item | change


@pytest.fixture(scope="module")
def built(spark):
    items = spark.createDataFrame([case_item(), case_item(key="k1", record_type="COMPARISON", name="Two", identifiers=[], ord=1), case_item(key="", record_type="RULE", name="Notice", ord=2), case_item(key="z", record_type="NOTHING", ord=3)], records.ITEM)
    made = lambda f, t, cited, basis="source": {"field": f, "text": t, "basis": basis, "facts": cited}
    composed = spark.createDataFrame(
        [
            {"section_id": "s1", "key": "k1", "statements": [made("material_facts", "A worker lost the job without warning", ["[F1]"]), made("definition", "No money was given", ["2"]), made("decision", "Perhaps in bad faith", ["f3"]), made("principles", " ", ["f1"])], "comparison_items": [], "concept_illustrated": []},
            {"section_id": "s1", "key": "rule-3", "statements": [made("key_points", "compensation never paid", [])], "comparison_items": [], "concept_illustrated": []},
        ],
        records.COMPOSED,
    )
    own = spark.createDataFrame([("s1", "d1", 0, ["Labour law", "Dismissal"], "T", 3, 4, SOURCE + " Roe v. Acme Ltd., 109 F3d 642, Supreme Court of India, Section 25F of the Industrial Disputes Act.")], "section_id string, doc_id string, index int, topic_path array<string>, title string, page_start int, page_end int, text string")
    return records.single_statements(records.build_records(records.repaired_items(items), composed, own)).cache(), own


def test_build_records(built):
    rows = {r.key: r for r in built[0].collect()}
    assert set(rows) == {"k1", "comparison-2", "rule-3"}
    case = rows["k1"]
    assert case.case_name == "Roe v. Acme Ltd." and case.citation == "109 F3d 642" and case.date.precision == "year" and case.parties[0].role == "plaintiff"
    assert [(s.field, s.evidence) for s in case.statements] == [("material_facts", ["s1:f1"]), ("principles", ["s1:f2"])]
    assert [(e.id, e.pages) for e in case.evidence] == [("s1:f1", [3]), ("s1:f2", [3])]
    assert case.laws[0].statute == "Industrial Disputes Act" and case.laws[0].provision == "Section 25F"
    assert case.topic.name == "Labour law" and case.subtopic.name == "Dismissal"
    assert rows["comparison-2"].subjects == ["(unspecified)"] * 2
    assert [(s.field, s.evidence) for s in rows["rule-3"].statements] == [("requirements", ["s1:rule-3-f2"])]


def test_same_case_has_one_id(spark):
    own = spark.createDataFrame([("Roe vs. Acme Limited",), ("The Roe v. Acme Ltd",)], "name string")
    assert own.select(records.record_id(F.lit("CASE"), F.col("name")).alias("r")).distinct().count() == 1


def test_validate(spark, built):
    rows = {r.key: r for r in validate.validate(*built).collect()}
    assert rows["k1"].status == "PASS" and not rows["k1"].errors, rows["k1"].errors
    assert rows["comparison-2"].status == "HUMAN_REVIEW" and "comparison has no items" in rows["comparison-2"].errors
    bad = built[0].filter("key = 'k1'").withColumns({"citation": F.lit("999 F3d 1"), "statements": F.expr("transform(statements, s -> named_struct('field', s.field, 'text', 'We found that the worker had been dismissed without any notice and that the employer never paid the compensation', 'basis', s.basis, 'evidence', s.evidence))")})
    row = validate.validate(bad, built[1]).first()
    assert row.status == "HUMAN_REVIEW" and "citation not found in source: '999 F3d 1'" in row.errors and any("too close" in e for e in row.errors) and "first-person wording (author's voice)" in row.review_reasons
    copied = bad.withColumn("citation", F.lit("109 F3d 642"))
    assert validate.validate(copied, built[1]).first().status == "REGENERATE"
    again = validate.validate(copied, built[1], attempt=1).first()
    assert again.status == "HUMAN_REVIEW" and "still too similar after regeneration" in again.review_reasons
    assert validate.validated(copied, built[1], lambda r: copied.join(r.select("section_id", "key"), ["section_id", "key"], "left_semi")).first().status == "HUMAN_REVIEW"
    assert validate.in_section_list("42 USC § 1981", "under 42 USC §§ 1983, 1981 and others") and not validate.in_section_list("42 USC § 1981", "1981 was a year")


def test_merge_links_and_topics(spark, built):
    twice = built[0].unionByName(built[0].withColumns({"doc_id": F.lit("d2"), "court": F.lit("High Court"), "evidence": F.expr("transform(evidence, e -> named_struct('id', concat('x', e.id), 'doc_id', 'd2', 'pages', e.pages))"), "statements": F.expr("transform(statements, s -> named_struct('field', s.field, 'text', upper(s.text), 'basis', s.basis, 'evidence', transform(s.evidence, e -> concat('x', e))))")}))
    rows = {(r.record_type, r.n_merged): r for r in link.merged_records(twice).collect()}
    case = rows["CASE", 2]
    assert case.court == "Supreme Court of India" and [s.evidence for s in case.statements] == [["s1:f1", "xs1:f1"], ["s1:f2", "xs1:f2"]] and len(case.evidence) == 4
    edges = {(e.relation, e.from_id == case.record_id) for e in link.relations(built[0]).collect()}
    assert {("part_of", True), ("interprets", True), ("defines", False), ("part_of", False)} <= edges
    found = link.entities(link.entity_mentions(built[0])).collect()
    assert {"CASE", "COURT", "STATUTE", "PROVISION"} == {e.entity_type for e in found}
    assert {t.name for t in link.topics_of(built[0]).collect()} == {"Labour law", "Dismissal"}


def test_library(spark, tmp_path):
    lib = library.Library(spark, str(tmp_path / "lib"))
    first = spark.createDataFrame([("a", 1, "x", 1), ("a", 2, "y", 2), ("b", 1, None, 1)], "id string, n int, note string, at int")
    lib.merge("t", first, ["id"], "at")
    lib.merge("t", spark.createDataFrame([("b", 9, None, 5), ("c", 3, "z", 5)], "id string, n int, note string, at int"), ["id"], "at", {"note": "fill", "n": "keep"})
    assert {(r.id, r.n, r.note) for r in lib.read("t").collect()} == {("a", 2, "y"), ("b", 1, None), ("c", 3, "z")}
    units = spark.createDataFrame([("d", "extract", "1", None, None, 1), ("d", "extract", "2", "boom" * 900, "out", 1)], "doc_id string, stage string, unit_id string, error string, output_path string, updated_at int")
    state = library.started(None, units)
    state = library.started(state, units.filter("unit_id = '2'"))
    state = library.finished(state, units.filter("unit_id = '2'"), "failed")
    got = {r.unit_id: r for r in state.collect()}
    assert (got["1"].status, got["1"].attempts, got["2"].status, got["2"].attempts, len(got["2"].error)) == ("running", 1, "failed", 2, 2000)
    assert {(r.unit_id, r.error) for r in library.failures(library.recovered(state)).select("unit_id", F.substring("error", 1, 11).alias("error")).collect()} == {("1", "interrupted"), ("2", "boomboomboo")}
    assert library.reset(state, "d").count() == 0 and library.to_do(units, library.finished(state, units.filter("unit_id = '1'"), "done")).count() == 1


def test_search(spark):
    docs = spark.createDataFrame([("a", "Café law", "retrenched notice under Section 25-F"), ("b", "Other", "notice of insurance"), ("c", "Third", "nothing")], "id string, title string, body string")
    postings = search.index(docs, "id", ("title", "body"))
    sizes = search.lengths(postings, "id")
    hits = lambda q: [r.id for r in search.keyword_search(postings, sizes, 3, "id", q).collect()]
    assert hits("25-F") == ["a"] and hits("cafe § notice") == ["a"] and hits("insurance retrenched") == [] and hits("") == [] and set(hits("notice")) == {"a", "b"}
    assert search.snippet("one two three notice five", "Notice", 2) == " … three [notice] … " or "[notice]" in search.snippet("one two three notice five", "Notice", 2)


def test_usage_and_exports(spark, built):
    log = spark.createDataFrame([("m", 1, 1000, 200, 0, 0), ("n", 1, 5, 5, 0, 0)], "model string, calls long, input_tokens long, output_tokens long, cache_read_tokens long, cache_write_tokens long")
    prices = spark.createDataFrame([("m", 4.0, 20.0)], "model string, input_per_m double, output_per_m double")
    assert {r.model: r.cost for r in usage.usage_cost(log, prices).collect()} == {"m": 0.008, "n": 0.0}
    files = spark.createDataFrame([("d1", "book.pdf")], "doc_id string, filename string")
    checked = validate.validate(*built)
    rows = export.knowledge_records(checked, files)
    case = rows.filter("content_type = 'CASE'").first()
    assert case.source.original_file == "book.pdf" and '"case_name":"Roe v. Acme Ltd."' in case.knowledge and '"year":"1978"' in case.knowledge
    page = export.html_page(rows)
    assert "<h2>Labour law</h2>" in page and "Roe v. Acme Ltd." in page
    assert export.overview(built[0]).first().pages == "3"
    pages = spark.createDataFrame([("r", p) for p in (425, 426, 427, 431)], "id string, page int")
    assert export.page_ranges(pages, "id").first().ranges == "425–427, 431"


def test_requests_hide_the_source(spark, built):
    items = records.repaired_items(spark.createDataFrame([case_item(facts=[{"id": "f1", "fact_type": "fact", "note": "the worker had been dismissed without any notice", "pages": [3], "support": "explicit", "proprietary": False}])], records.ITEM))
    notes = records.note_for_composer(items, built[1])
    assert notes.first().line == "- [f1] (fact, explicit) worker dismissed without notice"
    too_close = spark.createDataFrame([("s1", "k1", ["copied words"])], "section_id string, key string, phrases array<string>")
    text = records.compose_request(items, notes, too_close).first().request
    assert "tribunal" not in text and '- "copied words"' in text and "Allowed fields: material_facts" in text
    tables = spark.createDataFrame([("t", [["", "A", "B"], ["pay", "1", ""], ["leave", "2", "3"]])], "table_id string, rows array<array<string>>")
    assert {(r.subject, r.attribute, r.value) for r in records.table_triples(tables).collect()} == {("A", "pay", "1"), ("A", "leave", "2"), ("B", "leave", "3")}


def test_files_and_streams(spark, tmp_path):
    from docloom.sources import files
    from docloom.streaming import incremental

    inbox = tmp_path / "in"
    (inbox / "sub").mkdir(parents=True)
    for name, content in (("a.pdf", b"one"), ("sub/B.PDF", b"two"), ("same.pdf", b"one"), (".hidden.pdf", b"x"), ("note.txt", b"y"), ("bad.pdf", b"!")):
        (inbox / name).write_bytes(content)
    found = files.scan_inbox(spark, str(inbox))
    assert sorted(r.filename for r in found.collect()) == ["B.PDF", "a.pdf", "bad.pdf"]

    def parser(content):
        if content == b"!":
            raise ValueError("not a document")
        return [{"text": content.decode(), "lines": [{"text": "l", "size": 1.0, "bold": False, "y": 0.5}], "tables": [[["a", " b "], ["", ""], ["1", "2"]]], "image_share": 0.0}]

    pages, bad = files.parse_documents(found, parser)
    assert {r.text for r in pages.collect()} == {"one", "two"} and pages.first().tables == [[["a", "b"], ["1", "2"]]]
    assert [r.error for r in bad.collect()] == ["ValueError: not a document"] and files.page_lines(pages).count() == 2

    lib = library.Library(spark, str(tmp_path / "lib"))
    source = tmp_path / "stream"
    for k in range(2):
        spark.createDataFrame([("a", k), ("b", 1)], "id string, n int").coalesce(1).write.mode("append").parquet(str(source))
        incremental.merge_stream(spark.readStream.schema("id string, n int").parquet(str(source)), lib, "t", ["id"], "n", str(tmp_path / "ck")).awaitTermination()
    assert {(r.id, r.n) for r in lib.read("t").collect()} == {("a", 1), ("b", 1)}
