"""From raw documents to training shards: stages that each keep, cut or repeat documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import decontaminate, mixing, neardup, quality, shards
from tidewatch.session import materialize


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = quality.fit_held_in(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).filter("predicted = 1").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return neardup.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    marked = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.filter("NOT contaminated").select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.repeat(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training shards in the shared folder, and the place of every document in them."""
    return shards.materialise(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source mix", source_mix),
    ("token output", token_output),
]

#: Fitted and encoded stages have no SQL form; the tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over what its predecessor kept, written and read again in between."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
