"""What only shows on larger tables, on small ones."""

import pytest
from pyspark.sql import functions as F


def test_bookmarks_of_large_part_keys(spark, tmp_path):
    from docloom.plans import oracle, queries

    duck = pytest.importorskip("duckdb").connect()
    own = [(0, "hot bolt", "Brand#1", 2), (1, "hot bolt", "Brand#1", 2), (1_000_001, "old plate", "Brand#1", 3), (1_200_000, "blue ring", "Brand#2", 9)]
    spark.createDataFrame(own, "p_partkey bigint, p_name string, p_brand string, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    duck.sql(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    got = queries.queries()["bookmark_headings"](spark, str(tmp_path))
    want = duck.sql(oracle.oracle_sql()["bookmark_headings"])
    assert got.columns == want.columns and len(want.fetchall()) == 3
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())


def test_tied_intervals_are_one(spark):
    from docloom.operators import overlap

    days = [(1, 0, 60), (1, 200, 260), (1, 200, 260), (1, 200, 260), (1, 261, 300), (2, 5, 65), (2, 5, 65), (2, 65, 70)]
    got = overlap.merged_intervals(spark.createDataFrame(days, "k int, a int, b int").repartition(3), "k", "a", "b")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 0, 60, 1), (1, 200, 260, 3), (1, 261, 300, 1), (2, 5, 70, 3)]


def occurrences(spark, n):
    """A rule that n sections have: each with a provision and evidence of its own, all with one statement but for its case."""
    notes = "array(concat('s', id, ':f1'), concat('s', id, ':f2'))"
    return spark.range(n).selectExpr(
        "'rec_1' AS record_id", "'RULE' AS record_type", "concat('s', id) AS section_id", "concat('d', id % 97) AS doc_id", "cast(id AS int) AS section_index", "0 AS ord", "'i1' AS key", "'levy' AS name", "cast(null AS string) AS case_name", "cast(null AS string) AS citation",
        "cast(null AS string) AS court", "cast(null AS struct<value:string,precision:string>) AS date", "cast(null AS array<struct<name:string,role:string>>) AS parties", "array(named_struct('statute', '', 'provision', concat('Section ', id, 'F'), 'quoted_provision', cast(null AS string))) AS laws",
        f"array(named_struct('field', 'requirements', 'text', if(id % 2 = 0, 'Notice is given', 'notice is GIVEN'), 'basis', 'source', 'evidence', {notes})) AS statements", "cast(array() AS array<struct<subject:string,attribute:string,value:string,evidence:array<string>>>) AS comparison",
        "cast(null AS array<string>) AS subjects", "cast(null AS array<string>) AS dimensions", "cast(null AS array<string>) AS concept_illustrated", "cast(array() AS array<struct<name:string,type:string,relation:string>>) AS related",
        f"transform({notes}, e -> named_struct('id', e, 'doc_id', concat('d', id % 97), 'pages', array(1))) AS evidence", "named_struct('id', 't', 'name', 'T') AS topic", "named_struct('id', 'u', 'name', 'U') AS subtopic", "false AS proprietary", "cast(array() AS array<string>) AS reasons",
        "array(named_struct('kind', 'provision', 'value', concat('S. ', id, '-F'), 'role', '', 'pages', array(1))) AS identifiers",
    )


def test_merge_of_many_occurrences(spark):
    import time

    from docloom.operators import link

    began, n = time.monotonic(), 12_000
    own = occurrences(spark, n)
    (row,) = link.merged_records(own.unionByName(own.withColumn("ord", F.lit(1)))).collect()  # each of them twice
    assert row.n_merged == 2 * n and len({e.id for e in row.evidence}) == len(row.evidence) == 2 * n and len(row.laws) == len(row.identifiers) == n
    assert [(s.field, s.text, len(s.evidence)) for s in row.statements] == [("requirements", "Notice is given", 2 * n)]
    assert [e.id for e in row.evidence[:3]] == ["s0:f1", "s0:f2", "s97:f1"] and row.laws[1].provision == "Section 97F"
    assert time.monotonic() - began < 60


def test_evidence_of_many_occurrences(spark):
    import time

    from docloom.operators import library, link

    began, n = time.monotonic(), 12_000
    own = occurrences(spark, n)
    moved = own.withColumn("ord", F.lit(1)).withColumn("evidence", F.expr("transform(evidence, e -> named_struct('id', e.id, 'doc_id', 'other', 'pages', array(9)))"))
    rows = library.evidence_rows(link.merged_records(own.unionByName(moved))).collect()  # of equal ids the first occurrence's stays
    assert sorted((r.evidence_id, r.doc_id, r.page_start, r.page_end) for r in rows) == sorted((f"s{i}:{f}", f"d{i % 97}", 1, 1) for i in range(n) for f in ("f1", "f2"))
    assert time.monotonic() - began < 60


def test_exact_terms_need_no_pattern_of_all_terms():
    from docloom.operators import overlap

    overlap._patterns.clear()
    text = "Under Section 7F the employer shall give due process and due notice to the worker, whatever the district court said of it in its long opinion."
    for i in range(40):  # none of them stands in the text
        overlap.measure(["Notice is given to all workers"], text, (f"S. {i}-G", f"levy {i}"))
    assert len(overlap._patterns) <= 2
    # a longer exact term goes before a term of art that begins with it, one that begins later doesn't
    assert overlap.masked_words("they give due process rights to all", "#", ("Due  Process rights",)) == ["they", "give", "#", "to", "all"]
    assert overlap.masked_words("they give due process rights to all", "#", ("process rights",)) == ["they", "give", "#", "rights", "to", "all"]


@pytest.mark.parametrize("name", ["knowledge_export", "merged_knowledge"])
def test_exports_check_records_once(spark, name):
    from docloom.plans import queries

    plan = queries.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "EvalPython" not in plan and "MapInPandas" not in plan  # what needs Python was done before both sides read it


def test_merged_evidence_needs_no_folding(spark):
    from docloom.operators import library, link
    from docloom.plans import queries

    own = occurrences(spark, 200)
    moved = own.withColumns({"ord": F.lit(1), "evidence": F.expr("transform(evidence, e -> named_struct('id', e.id, 'doc_id', 'other', 'pages', array(9, 4)))")})
    blank = own.filter("section_index < 9").withColumns({"record_id": F.lit(None).cast("string"), "evidence": F.expr("if(section_index % 3 = 0, null, if(section_index % 3 = 1, slice(evidence, 1, 0), array_repeat(evidence[0], 2)))")})
    unnamed = own.withColumns({"ord": F.lit(2), "evidence": F.expr("array(named_struct('id', cast(null AS string), 'doc_id', 'd', 'pages', array(1)), named_struct('id', concat('n', section_index % 7), 'doc_id', doc_id, 'pages', cast(array() AS array<int>)))")})
    both = moved.unionByName(own).unionByName(blank).unionByName(unnamed)
    got, want = link.merged_evidence(both), library.evidence_rows(link.merged_records(both))
    assert got.columns == want.columns
    order = lambda rows: sorted(map(str, rows.collect()))
    assert order(got) == order(want) and got.count() == 2 * 200 + 3 + 7
    plan = queries.queries()["record_evidence"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("ArrowEvalPython [") == 1  # first by id, and texts go to Python once


def test_likest_notes_of_many_items():
    import random
    import time

    import pandas as pd

    from docloom.functions.similarity import token_set_ratio
    from docloom.operators.records import NOTE_SCORE, likest_notes

    dice, words = random.Random(5), "claims fail pay a charge firms levy late Notice".split()
    text = lambda n: " ".join(dice.choices(words, k=n))
    for _ in range(300):
        wanted, ids, notes = text(4).lower(), dice.choices(["f1", "f2", "f10", "ä", "Z"], k=4), [text(dice.randint(0, 5)) for _ in range(4)]
        scores = pd.Series({i: token_set_ratio(wanted, n.lower()) for i, n in zip(ids, notes, strict=True)}, dtype=float).sort_index(ascending=False)
        assert likest_notes(wanted, ids, notes) == scores[scores >= NOTE_SCORE].sort_values(ascending=False, kind="stable").index[:2].tolist()
    began = time.monotonic()
    for _ in range(20_000):
        likest_notes("a charge that machinery firms pay", ["f1", "f2"], ["claims fail in France", "Machinery firms pay a charge"])
    assert time.monotonic() - began < 2


def test_items_of_many_notes(spark):
    import time

    from docloom.operators import records

    n, rows = 500, 24
    fact = "named_struct('id', concat('n-', f), 'fact_type', 'fact', 'note', concat('claim ', f), 'pages', array(f % 7, 3), 'support', 'explicit', 'proprietary', false)"
    items = spark.range(rows).selectExpr(
        "concat('s', id) AS section_id", "0 AS ord", "'i1' AS key", "'RULE' AS record_type", "'levy' AS name", "'' AS heading", "cast(array() AS array<struct<kind:string,value:string,role:string,pages:array<int>>>) AS identifiers", f"transform(sequence({n}, 1, -1), f -> {fact}) AS facts",
        "cast(array() AS array<struct<name:string,type:string,relation:string>>) AS related", "false AS proprietary", "'' AS proprietary_reason", "'' AS quoted_provision",
    )
    cited = "array('[N-7]', '7', 'f7', 'note500', 'n-500', '501', 'f 500')"  # 7 is the last part of n-7 and the number of n-494: the first of both has it
    composed = items.selectExpr("section_id", "key", f"array(named_struct('field', 'requirements', 'text', 'Pay', 'basis', 'source', 'facts', {cited})) AS statements", "cast(array() AS array<struct<subject:string,attribute:string,value:string,facts:array<string>>>) AS comparison_items", "array('') AS concept_illustrated")
    sections = items.selectExpr("section_id", "'d' AS doc_id", "1 AS index", "array('T', 'U') AS topic_path", "2 AS page_start", "4 AS page_end")
    began = time.monotonic()
    got = records.build_records(items, composed, sections).select("section_id", "evidence").collect()
    assert time.monotonic() - began < 20 and len(got) == rows
    assert {tuple((e.id.split(":")[1], tuple(e.pages)) for e in r.evidence) for r in got} == {(("n-7", (3,)), ("n-494", (3, 4)), ("n-1", (3,)), ("n-500", (3, 3)))}
