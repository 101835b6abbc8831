"""Corpus pipeline over `documents`, each stage reading what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from annalist.llm import language_id
from annalist.llm.decontaminate import without_contaminated
from annalist.llm.mixing import mixed
from annalist.llm.ngram_join import one_of_each
from annalist.llm.token_output import training_order
from annalist.llm.workspace import materialise


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a sufficient margin, the labels given being what is learned from."""
    return language_id.accepted(docs, language_id.fit(docs))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sources_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    return mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids in training order."""
    return training_order(docs)


STAGES = [
    ("language id", identified),
    ("n-gram jaccard join", unique),
    ("benchmark decontamination", decontaminated),
    ("source mixing", sources_mixed),
    ("token output", tokens),
]
#: Compression, Jaccard components, alignment and tokenisation are beyond SQL; the pipeline is tested stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
