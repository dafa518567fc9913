"""Clean and mix a corpus: language, near copies, repeated passages, benchmark leaks, mixture.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame with the columns
of ``documents``; the last adds the mixture. ``run`` writes each result to the
shared folder and reads it back, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import decontaminate, langid, mixing, nearcopies, repeats
from footfall.sources.scratch import stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those that are ``und`` go, and a null ``lang`` is filled in."""
    return langid.keep_known(docs, langid.fit(docs.where(F.col("lang").isNotNull())))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the least id."""
    return nearcopies.keep_first(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay in the first document that has them and are cut from the others."""
    return repeats.cut(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have no window of the benchmark."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the number of copies and the words taken."""
    return mixing.mixed(docs)


STAGES = [
    ("language", known_language),
    ("near_copies", one_of_near_copies),
    ("repeated_passages", without_repeats),
    ("benchmark", without_benchmark),
    ("mixture", mixture),
]

#: Kernels, alignment and random rounding have no SQL form; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
