"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Every stage but the last returns the columns of ``documents``, whatever they are called besides the
known ones, and works on all that the stage before it kept.  Rows without an id pass the stages that
compare documents.  Null, empty and letterless texts go with the first stage; repeated rows, and copies,
near or exact, with the second, which keeps the least id and of one id's texts the least digest.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, jaccard, language, substrings
from millrace.llm.queries import token_digests
from millrace.llm.store import staged

#: A document stays if one language has this share of its letters; texts of two or three languages do.
LEAST_SCORE = 0.25


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; those without letters, or without a main language, go."""
    found = language.identify(docs, language.learn(docs), out="__language")
    sure = (F.col("__language.lang_pred") != language.UNDETERMINED) & (F.col("__language.score") >= LEAST_SCORE)
    return found.filter(sure).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of similar ones."""
    return jaccard.one_of_each(docs).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document of a lower id has; emptied ones go."""
    return substrings.remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    return decontaminate.without_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of the text they decode to."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_digests(bpe.round_trip(docs.select("doc_id", "text"), vocabulary, public_tokenizers.PATTERN))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: SQL expresses none of the stages' models; tests hold the pipeline against a plain version of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
