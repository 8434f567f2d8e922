"""Corpus pipeline: language identification, near duplicates, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet and gives what it reads back to
the next stage. All but the last keep the columns of documents. The last returns the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veloframe.llm import common, decontamination, jaccard, languages, packing, pii
from veloframe.session import ship


_loaded: list[languages.Identifier] = []


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars anew, where documents have it."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents that are not held out; texts in none of their languages, or without letters, go."""
    ship(spark)
    model = languages.learned(docs.filter(~languages.held_out()))
    _loaded.append(model)
    return languages.keep_identified(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that similarity links, one of the least doc_id stays."""
    ship(spark)
    while _loaded:  # the language models are of no more use
        _loaded.pop().unload()
    return jaccard.drop_similar(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut; documents that are mostly such passages go."""
    ship(spark)
    return _counted(decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become their kind in brackets."""
    ship(spark)
    return _counted(pii.redact(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids: sequence_id, n_tokens, ids, pieces and their doc_ids."""
    ship(spark)
    return packing.pack_documents(docs).withColumn("doc_ids", F.col("pieces.doc_id"))


STAGES = [
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

#: SQL cannot express tokenisation or the learned stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.staged(stage(spark, docs, sf_dir), name)
        if name != STAGES[0][0]:
            common.release(spark, before)
        before = docs
    return docs
