"""The registered queries of this subpackage: each operator on its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, licenses, mixing, near_dedup, packing, quality_classifier, quality_rules, suffix_dedup, toxicity, warc
from .common import scratch, table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted", "n_passages")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_classifier.quality(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.draws(table(spark, sf_dir, "documents"))
    shards = F.concat_ws(",", F.transform("draws", lambda d: d["shard"].cast("string")))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", shards.alias("shards"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "n_links", "kept")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = warc.arc_to_warc(warc.pages_to_arc(pages, "page_id", "url", "html"), scratch(spark, "warc"))
    own = {c: warc.key_of(F.col(c)).try_cast(pages.schema["page_id"].dataType) for c in ("key", "refers_to")}
    return out.select(own["key"].alias("page_id"), "payload_bytes", "payload_digest", "record_type", own["refers_to"].alias("refers_to"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *licenses.OUTPUT)


def queries() -> dict:
    own = (op1_toxicity, op2_quality_rules, op3_quality_classifier, op4_source_mix, op5_suffix_dedup, op6_exact_dedup, op7_minhash_near_dedup, op8_packing, op9_warc, op10_license_scan)
    return {f.__name__: f for f in own}
