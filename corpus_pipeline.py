"""A corpus pipeline: documents in, packed training sequences out.

Each stage gets what its predecessor kept, written as Parquet and read again, and returns the columns of
``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from arealens.llm.decontaminate import drop_leaks
from arealens.llm.divergence import fit_references, keep_usual
from arealens.llm.importance import fit_importance, keep_drawn
from arealens.llm.jaccard_join import keep_one
from arealens.llm.packing import pack_documents
from arealens.operators.materialize import materialize

TOKENIZER = "word_bpe_49k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling towards those labelled good."""
    model, _ = fit_importance(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return keep_drawn(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose histograms are usual for their language."""
    return keep_usual(docs, fit_references(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingle similarity of 0.8 or more."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, be it with other values."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: No SQL for the fitted models; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``; every stage is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
