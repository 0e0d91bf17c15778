"""A training corpus from ``documents``: language, near duplicates, benchmark leaks, mixture, token shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet before the
next stage reads it; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from qoeflow.llm import chosen_path, common, decontam, langid, mixing, token_shards


#: A text goes when less than half of its letters are in scripts that the corpus's languages are written in.
SUPPORT = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go."""
    return langid.keep_identified(docs, support=SUPPORT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest id."""
    return chosen_path.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are contaminated with benchmark items go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: The smaller sources are read up to a quarter more often than the largest; none loses a document.
MIXTURE = mixing.MixConfig(max_passes=1.25)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the temperature mixture has it, once at least."""
    return mixing.mixed_documents(docs, MIXTURE)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in training order; a row per sequence."""
    return token_shards.materialise(docs, common.fresh_path(spark, "corpus-shards"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: No SQL: language models, min-hash joins and the byte shards have no counterpart in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, keep: str | None = None) -> DataFrame:
    """Apply the stages to ``documents``; each is written and read back before the next one starts.

    ``keep``: a folder for the stages' tables. A run that finds a stage's whole table there goes on from it,
    so a run that failed is taken up at the stage that failed. Without it every run has tables of its own.
    """
    root = keep or common.fresh_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES[:-1], 1):
        place = f"{root}/{number}-{name}"
        schema = docs.schema
        if not common.written(spark, place):
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(place)
        docs = spark.read.schema(schema).parquet(place)
    return STAGES[-1][1](spark, docs, sf_dir)
