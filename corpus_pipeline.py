"""The corpus pipeline: operators of docloom.llm applied one after another to `documents`.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.

toxicity     rejects documents predicted toxic by a model learned from `labels`
exact_dedup  keeps of equal texts the row with the largest id
near_dedup   keeps one document of each near-duplicate class
mix          draws documents by source weights; a document comes once for each draw
pack         cuts and packs the mix into token sequences

Defined results: null texts count as empty in every stage; an empty table gives none; rows equal in id and text are one after exact dedup; columns
beside those of `documents` are dropped by a stage, whatever their names; very long texts are read whole.

ORACLE_SQL is None: the model, the signatures, the draws and the tokenizer are beyond SQL. tests/llm/test_pipeline.py holds the stages
against plain Python forms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.llm import common, exact_dedup, mixing, near_dedup, packing, queries, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = toxicity.toxicity(docs.select(*COLUMNS), common.table(spark, sf_dir, "labels"))
    return out.filter("predicted = 0").select(*COLUMNS)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs).select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(docs).select(*COLUMNS)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select(*COLUMNS)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, queries.tokenizer_path())


STAGES = [("toxicity", toxicity_stage), ("exact_dedup", exact_dedup_stage), ("near_dedup", near_dedup_stage), ("mix", mix_stage), ("pack", pack_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written below the checkpoint folder and read again; the last one's rows."""
    docs, before = common.table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs, path = common.saved(stage(spark, docs, sf_dir))
        if before:
            common.discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
