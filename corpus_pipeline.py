"""A corpus from raw documents to shards: each stage works on what the one before has kept.

Rows with NULL or empty texts hold nothing that a stage looks for: they pass
toxicity, near_dedup and decontamination, stay once in mixing, and are put in
shards. Rows with a NULL id pass the first three stages, too; mixing takes of them what it
takes of others. Of rows that share an id, near_dedup
keeps one, and decontamination takes out all or none. Texts of any length are
read whole. An empty table stays empty. Columns besides those of ``documents``
are carried along, but for ``shard``, ``slot`` and ``curve``, which sharding
gives. Rows come in no particular order; ties are broken by id and text, so
reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidehaul.llm.common import text_or_empty
from tidehaul.llm.decontaminate import decontaminated
from tidehaul.llm.minhash import deduplicated
from tidehaul.llm.mixing import mixed_documents
from tidehaul.llm.shards import hilbert_shards
from tidehaul.llm.toxicity import without_toxic
from tidehaul.session import written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity field rejects go; it learns from the labels of these documents."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words at 0.8 stays, that of the least id."""
    return deduplicated(docs, words=5, part=80, whole=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark, or a paraphrase of it, go."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as many words of each source as the mix of sources takes of it."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot along a Hilbert curve over size, source and language."""
    text = text_or_empty("text")
    return hilbert_shards(
        docs, [F.octet_length(text).cast("long"), F.col("source"), F.col("lang")], [F.xxhash64(text), F.col("doc_id")]
    )


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# Learned weights, sketches and a decomposition decide; SQL cannot say the same.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; each result is a table in the shared folder before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
