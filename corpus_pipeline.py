"""Corpus pipeline: documents in, training mix out.

``STAGES`` are (name, function) in order. A function takes ``(spark, docs, sf_dir)``
and returns a DataFrame; it is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents`` (extra
columns stay); the last adds ``mix_copy``, the number of the copy.

Stages keep null ids, repeated rows and empty tables; each operator's docstring
tells what it does with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contrail.llm import decontam, jaccard, langid, mixing, suffix
from contrail.llm.common import table
from contrail.session import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go."""
    return langid.identified_documents(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard.distinct_documents(spark, docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings that a document of smaller id has are cut."""
    return suffix.deduplicated_documents(spark, docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut."""
    return decontam.decontaminate(spark, docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights."""
    return mixing.mixed_documents(spark, docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeats", repeats), ("benchmark", benchmark), ("mix", mix)]

#: The language model and the interval tree have no SQL form; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of ``documents``, every stage on all that the one before it kept, each stage's rows written in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
