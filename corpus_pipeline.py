"""Corpus pipeline over `documents`: toxicity, quality, exact copies, near copies, packing.

Every stage takes the rows that the one before it kept, written as Parquet and read again, and its decisions take effect.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import exact_dedup, minhash, packing, quality, toxicity
from tidewater.llm.labelled import informed
from tidewater.llm.shared import materialize


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _scored(docs: DataFrame, score: Callable[[DataFrame], DataFrame], keep: Column) -> DataFrame:
    """The rows whose score keep holds for, with the columns they came with, whatever their names."""
    return score(docs.select("text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_x_row"))).filter(keep).select("_x_row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 for toxicity; all where no labelled rows of both classes teach a model."""
    model = toxicity.train_toxicity(docs, _labels(spark, sf_dir))
    if not informed(model):
        return docs
    return _scored(docs, lambda rows: toxicity.score_toxicity(rows, model), F.col("score") < 0.5)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more for quality; all where no labelled rows of both classes teach a model."""
    model = quality.train_quality(docs, _labels(spark, sf_dir))
    if not informed(model):
        return docs
    return _scored(docs, lambda rows: quality.score_quality(rows, model), F.col("score") >= 0.5)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (five-word shingles, similarity 0.8 or more), the row with the least id."""
    return minhash.drop_near_copies(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("packing", pack),
]

#: SQL can't express the fitted classifiers or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over sf_dir's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
