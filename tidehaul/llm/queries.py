"""One query for each operator, over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidehaul.llm import chat, divergence, licenses, merkle, repeats
from tidehaul.llm.chat import chat_format
from tidehaul.llm.decontaminate import contaminated
from tidehaul.llm.fingerprints import edited_fingerprints
from tidehaul.llm.html_text import extract_main_text
from tidehaul.llm.minhash import near_duplicates
from tidehaul.llm.mixing import document_mix
from tidehaul.llm.shards import document_shards
from tidehaul.llm.toxicity import document_toxicity
from tidehaul.llm.tokens import read_vocabulary, token_counts


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_edit_fingerprints(spark, sf_dir):
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op2_near_duplicates(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "documents"), words=3, part=85, whole=100)


def op3_hilbert_shards(spark, sf_dir):
    return document_shards(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark, sf_dir):
    return document_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_mix_sources(spark, sf_dir):
    return document_mix(_table(spark, sf_dir, "documents"))


def op6_token_counts(spark, sf_dir):
    return token_counts(_table(spark, sf_dir, "documents"), read_vocabulary())


def op7_main_text(spark, sf_dir):
    return extract_main_text(_table(spark, sf_dir, "pages"))


def op8_chat_format(spark, sf_dir):
    return chat_format(_table(spark, sf_dir, "conversations"))


def op9_decontamination(spark, sf_dir):
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_license_scan(spark, sf_dir):
    return licenses.license_scan(_table(spark, sf_dir, "documents"))


def op11_source_divergence(spark, sf_dir):
    return divergence.source_divergence(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark, sf_dir):
    return merkle.manifest_proofs(_table(spark, sf_dir, "documents"))


def op13_substring_dedup(spark, sf_dir):
    return repeats.repeated_passages(_table(spark, sf_dir, "documents"))


def queries():
    return {
        "op1_edit_fingerprints": op1_edit_fingerprints,
        "op2_near_duplicates": op2_near_duplicates,
        "op3_hilbert_shards": op3_hilbert_shards,
        "op4_toxicity": op4_toxicity,
        "op5_mix_sources": op5_mix_sources,
        "op6_token_counts": op6_token_counts,
        "op7_main_text": op7_main_text,
        "op8_chat_format": op8_chat_format,
        "op9_decontamination": op9_decontamination,
        "op10_license_scan": op10_license_scan,
        "op11_source_divergence": op11_source_divergence,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_substring_dedup": op13_substring_dedup,
    }


def oracle_sql():
    return {
        "op8_chat_format": chat.oracle(),
        "op10_license_scan": licenses.oracle(),
        "op11_source_divergence": divergence.oracle(),
        "op12_merkle_manifest": merkle.oracle(),
        "op13_substring_dedup": repeats.oracle(),
    }
