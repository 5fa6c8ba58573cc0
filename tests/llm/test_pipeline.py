"""The pipeline's stages one after another: what each may drop, keep and repeat."""

import collections
import os
import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
pytest.importorskip("public_tokenizers")
FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables aren't here")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark):
    from docloom.llm import common, exact_dedup, near_dedup, toxicity

    docs = common.table(spark, FOLDER, "documents")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out, _ = common.saved(stage(spark, kept[-1], FOLDER))
        if name != "pack":
            assert out.columns == docs.columns
        kept.append(out)
    rows = [[r.asDict() for r in k.collect()] for k in kept]
    ids = [collections.Counter(r["doc_id"] for r in k) for k in rows]

    flagged = {r.doc_id for r in toxicity.toxicity(docs, common.table(spark, FOLDER, "labels")).filter("predicted = 1").collect()}
    assert set(ids[0]) - set(ids[1]) == flagged

    stays = {}
    for r in rows[1]:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"] or "")
        stays[text] = max(stays.get(text, -1), r["doc_id"])
    assert set(ids[2]) == set(stays.values())

    classes = {r.doc_id: r.class_id for r in near_dedup.near_classes(kept[2]).collect()}
    assert set(ids[3]) == set(classes.values())

    size = lambda t: len(WORD.findall(t or ""))
    whole = {r["doc_id"]: size(r["text"]) for r in rows[3]}
    mixed = collections.Counter()
    for r in rows[4]:
        mixed[r["doc_id"]] += size(r["text"])
    assert set(ids[4]) <= set(ids[3]) and all(mixed[i] <= 3 * whole[i] for i in mixed) and abs(sum(mixed.values()) - sum(whole.values())) <= len({r["source"] for r in rows[3]})

    pieces = collections.Counter()
    for r in rows[5]:
        pieces[r["sequence_id"]] += r["length"]
    assert set(ids[5]) == set(ids[4]) and max(pieces.values()) <= 4096


def test_run_equals_its_stages(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None
