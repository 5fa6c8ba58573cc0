"""A run from an inbox to a library: resume, failures, fatal faults, merges across documents, reviews and exports."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from docloom.operators import export, library, link, records
from docloom.pipeline import FatalRunError, Pipeline
from docloom.settings import Settings, load_prompt, load_settings, project_root, system_prompt

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the parser below goes to the workers
BODY = "Under Section 25F of the Industrial Disputes Act, 1947 the employer shall give notice and must pay unless the worker is exempt from it by order. "


def parser(content):
    if content.startswith(b"!"):
        raise ValueError("not a document")
    lines = [{"text": t, "size": 18.0 if t.startswith("Chapter") else 11.0, "bold": t.startswith("Chapter"), "y": 0.3 + k / 100} for k, t in enumerate(content.decode().split("\n"))]
    return [{"text": content.decode(), "lines": lines, "tables": [], "image_share": 0.0}]


class Models:
    def __init__(self, spark):
        self.spark, self.calls, self.fail = spark, 0, None

    def extract(self, requests):
        self.calls += 1
        identifiers = F.array(F.struct(F.lit("provision").alias("kind"), F.lit("S. 25-F").alias("value"), F.lit("Industrial Disputes Act, 1947").alias("role"), F.array(F.lit(1)).alias("pages")))
        fact = F.array(F.struct(F.lit("f1").alias("id"), F.lit("requirement").alias("fact_type"), F.lit("notice owed before dismissal").alias("note"), F.array(F.lit(1)).alias("pages"), F.lit("explicit").alias("support"), F.lit(False).alias("proprietary")))
        related = F.array(F.struct(F.lit("Retrenchment").alias("name"), F.lit("CONCEPT").alias("type"), F.lit("related_to").alias("relation")))
        out = requests.select("section_id", F.lit(0).alias("ord"), F.lit("i1").alias("key"), F.lit("RULE").alias("record_type"), F.lit("Notice of retrenchment").alias("name"), F.lit("").alias("heading"), identifiers.alias("identifiers"), fact.alias("facts"), related.alias("related"), F.lit(False).alias("proprietary"), F.lit("").alias("proprietary_reason"), F.lit("").alias("quoted_provision"))
        wrong = F.col("request").contains(self.fail[0]) if self.fail else F.lit(False)
        errors = requests.select("section_id", F.when(wrong, self.fail[1] if self.fail else "").alias("error_kind"), F.when(wrong, "no answer").alias("error"))
        return out.join(errors, "section_id")

    def compose(self, requests):
        self.calls += 1
        made = F.array(F.struct(F.lit("requirements").alias("field"), F.lit("Workers hear of it in good time").alias("text"), F.lit("source").alias("basis"), F.array(F.lit("[F1]")).alias("facts")))
        none = F.expr("cast(array() as array<struct<subject:string,attribute:string,value:string,facts:array<string>>>)")
        return requests.select("section_id", F.lit("i1").alias("key"), made.alias("statements"), none.alias("comparison_items"), F.expr("cast(array() as array<string>)").alias("concept_illustrated"))


def project(spark, folder, documents):
    (folder / "inbox").mkdir()
    for name, text in documents.items():
        (folder / "inbox" / name).write_bytes(text.encode())
    models = Models(spark)
    own = Pipeline(spark, Settings(root=str(folder)), parser, models.extract, models.compose)
    own.library.buckets = 1  # the tables here have a few rows
    return own, models


def test_run_resume_and_exports(spark, tmp_path):
    p, models = project(spark, tmp_path, {"one.pdf": "Chapter 1 Dismissal\n" + BODY * 5, "two.pdf": "Chapter 1 Lay-off\n" + BODY * 6, "bad.pdf": "!"})
    report = {r.filename: r for r in p.run().collect()}
    assert (report["one.pdf"].status, report["one.pdf"].records_saved, report["bad.pdf"].status) == ("done", 1, "quarantined")
    lib = p.library
    row = lib.read("records").collect()
    assert len(row) == 1 and row[0].n_merged == 2 and {e.doc_id for e in row[0].evidence} == {r.doc_id for r in report.values() if r.status == "done"}  # one rule from two documents
    assert row[0].status == "PASS" and len(row[0].statements) == 1 and row[0].laws[0].entity_id.startswith("ent_")
    assert [e.entity_type for e in lib.read("entities").filter("entity_type = 'PROVISION'").collect()] == ["PROVISION"]
    assert {"part_of", "defines", "related_to"} <= {e.relation for e in lib.read("relations").collect()}
    calls = models.calls
    again = {r.filename: r for r in p.run().collect()}
    assert models.calls == calls and again["one.pdf"].records_saved == 0  # nothing is asked twice
    lib.vacuum("stage_status")
    assert lib.read("stage_status").count() > 0
    out = p.knowledge().first()
    assert out.content_type == "RULE" and len(out.additional_sources) == 1 and out.validation.status == "PASS"
    assert "Section 25F" in out.knowledge and "Notice of retrenchment" in export.html_page(p.knowledge())
    export.html_pages(p.knowledge(), str(tmp_path / "html"))
    pages = spark.read.text(str(tmp_path / "html")).collect()
    assert any("Notice of retrenchment" in r.value for r in pages)
    export.export_library(lib.read("records"), lib.read("relations"), library.topic_tree(lib.read("topics"), lib.read("records")), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out" / "topics.jsonl")).count() >= 1
    export.write_csv_file(export.overview(lib.read("records")), str(tmp_path / "all.csv"))
    assert (tmp_path / "all.csv").read_bytes().startswith(b"\xef\xbb\xbfrecord_id,type,title,topic,subtopic,documents,pages,proprietary,needs_review")
    assert set(json.loads(p.schemas())) == {*records.FIELDS, "relation"}
    folder = p.write_report(p.report(p.run_classify(), None))
    assert spark.read.json(f"{folder}/totals").first().documents == 3
    p.reprocess(report["one.pdf"].doc_id)
    assert [r.doc_id for r in p.todo(p.run_classify()).collect()] == [report["one.pdf"].doc_id]


def test_failed_section_is_retried_and_fatal_stops(spark, tmp_path):
    p, models = project(spark, tmp_path, {"one.pdf": "Chapter 1 Dismissal\n" + BODY * 5, "two.pdf": "Chapter 1 Lay-off\n" + BODY * 6})
    dry = {r.filename: r.status for r in p.run(dry_run=True).collect()}
    assert set(dry.values()) == {"estimated"} and models.calls == 0
    models.fail, classes = ("Lay-off", "refusal"), p.run_classify()
    assert p.estimate(classes).first().n == 2
    report = {r.filename: r for r in p.report(classes, p.run_sections(classes)).collect()}
    assert (report["two.pdf"].status, report["two.pdf"].sections_failed, report["one.pdf"].status) == ("partial", 1, "done") and "no answer" in report["two.pdf"].errors[0]
    assert [r.error for r in library.failures(p.library.read("stage_status")).collect()] == ["no answer"]
    models.fail = ("Lay-off", "fatal")
    with pytest.raises(FatalRunError):
        p.run_sections(classes)
    assert p.library.read("stage_status").filter("status = 'running'").count() == 0
    models.fail, calls = None, models.calls
    assert {r.status for r in p.report(classes, p.run_sections(classes)).collect()} == {"done"} and models.calls == calls + 2


def test_review_queue(spark, tmp_path):
    p, models = project(spark, tmp_path, {"one.pdf": "Chapter 1 Dismissal\n" + BODY * 5})
    whole = models.compose
    models_compose = lambda requests: whole(requests).withColumn("statements", F.expr("transform(statements, s -> named_struct('field', s.field, 'text', 'We think that one should wait', 'basis', s.basis, 'facts', s.facts))"))
    p.compose = models_compose
    assert p.run().first().records_for_review == 1
    waiting = p.reviews().first()
    assert waiting.title == "Notice of retrenchment" and waiting.status == "pending" and json.loads(waiting.data)["record_id"] == waiting.record_id
    assert p.library.read("records").count() == 0
    p.decide(waiting.review_id, "approved")
    stored = p.library.read("records").first()
    assert p.reviews().count() == 0 and stored.needs_review and p.knowledge().first().validation.reason == "approved by reviewer"


def test_broken_version_leaves_the_old_table(spark, tmp_path):
    lib = library.Library(spark, str(tmp_path / "lib"), buckets=4)
    rows = spark.range(20).select("id", F.lit("a").alias("v"))
    lib.merge("t", rows, ["id"])
    # a driver that dies after the data, and one that dies inside the list of folders
    rows.withColumn("v", F.lit("broken")).write.parquet(f"{tmp_path}/lib/t/data/00000002")
    (tmp_path / "lib" / "t" / "versions" / "00000003").mkdir()
    assert {r.v for r in lib.read("t").collect()} == {"a"} and lib.version("t") == 1
    lib.merge("t", spark.createDataFrame([(3, "b", 7), (99, "c", 8)], "id long, v string, extra int"), ["id"])
    got = {r.id: (r.v, r.extra) for r in lib.read("t").collect()}
    assert len(got) == 21 and got[3] == ("b", 7) and got[99] == ("c", 8) and got[4] == ("a", None)
    folders = lib._listed("t")["folders"].values()
    assert {f.split("/")[1] for f in folders} == {"00000001", "00000004"}  # untouched buckets stay where they are


def test_settings_and_prompts(tmp_path, monkeypatch):
    (tmp_path / "config.yaml").write_text("sectioning: {target: 2500, most: 4000}\nvalidation: {max_shared_word_run: 9}\n")
    (tmp_path / ".env").write_text("# keys\nDOCLOOM_TEST_KEY='x'\n")
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "prompts").mkdir()
    (tmp_path / "prompts" / "case.md").write_text("Own words on cases.\n")
    monkeypatch.delenv("DOCLOOM_TEST_KEY", raising=False)
    assert project_root(tmp_path / "a" / "b") == tmp_path.resolve()
    own = load_settings(tmp_path / "config.yaml")
    assert own.sectioning.target == 2500 and own.validation.max_shared_word_run == 9 and own.path("inbox") == f"{tmp_path.resolve()}/inbox"
    import os

    assert os.environ["DOCLOOM_TEST_KEY"] == "x"
    assert load_prompt("case", str(tmp_path)) == "Own words on cases.\n" and system_prompt(str(tmp_path)).count("\n\n") == 5
    (tmp_path / "bad.json").write_text('{"nothing": 1}')
    with pytest.raises(ValueError):
        load_settings(tmp_path / "bad.json")


def test_last_answer_wins_and_citations_join(spark):
    two = spark.createDataFrame([("s", "k", 0, "first"), ("s", "k", 1, "second")], "section_id string, key string, pos int, t string")
    two = two.select("section_id", "key", "pos", F.array("t").alias("statements"), F.array().cast("array<string>").alias("comparison_items"), F.array().cast("array<string>").alias("concept_illustrated"))
    assert [r.statements for r in records.last_answers(two).collect()] == [["second"]]
    own = spark.createDataFrame([(["109 F3d 642", "F3d 642", "1 AC 5"],), ([],)], "c array<string>")
    assert [r.c for r in own.select(link.merged_citations(F.col("c")).alias("c")).collect()] == ["109 F3d 642; 1 AC 5", None]
