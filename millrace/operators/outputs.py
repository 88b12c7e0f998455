"""Output quality and ingestion volume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.rules import Rule
from millrace.schemas import MIN_QUALITY_SCORE


def is_valid(min_score: float = MIN_QUALITY_SCORE) -> Column:
    """No errors, and a score that is absent or high enough."""
    score = F.col("quality_score")
    return (F.size("validation_errors") == 0) & (score.isNull() | (score >= min_score))


def valid_outputs(df: DataFrame, min_score: float = MIN_QUALITY_SCORE) -> DataFrame:
    return df.filter(is_valid(min_score))


def quality_summary(df: DataFrame, min_score: float = MIN_QUALITY_SCORE) -> DataFrame:
    """Per output type: rows, valid share, mean score, mean compression ratio."""
    valid = F.count_if(is_valid(min_score))
    total = F.count(F.lit(1))
    return df.groupBy("output_type").agg(
        total.alias("outputs"),
        valid.alias("valid"),
        (valid / total).alias("valid_share"),
        F.avg("quality_score").alias("mean_score"),
        F.avg("compression_ratio").alias("mean_compression_ratio"),
    )


def error_counts(df: DataFrame) -> DataFrame:
    """Per output type and error: number of rows."""
    return (
        df.select("output_type", F.explode("validation_errors").alias("error"))
        .groupBy("output_type", "error")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_errors(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent errors overall."""
    counts = df.select(F.explode("validation_errors").alias("error")).groupBy("error").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.orderBy(F.desc("n"), "error").limit(n)


def integrity_rules(payload: str, algorithm: str = "sha256") -> list[Rule]:
    """Stored checksum and byte size against the payload; absent ones pass."""
    if algorithm not in ("sha256", "md5"):
        raise ValueError(f"unsupported checksum: {algorithm}")
    digest = F.sha2(payload, 256) if algorithm == "sha256" else F.md5(payload)
    checksum, size = F.col("checksum"), F.col("size_bytes")
    return [
        Rule("checksum", "mismatch", checksum.isNull() | (checksum == digest)),
        Rule("size_bytes", "mismatch", size.isNull() | (size == F.octet_length(payload))),
    ]


def ingest_volume(df: DataFrame) -> DataFrame:
    """Rows, bytes, first and last time by source type and topic, with subtotals.

    ``level`` is 0 for a detail row, 1 for a source type, 3 for the total.
    """
    return df.rollup("source_type", "topic").agg(
        F.grouping_id().cast("long").alias("level"),
        F.count(F.lit(1)).alias("records"),
        F.sum("size_bytes").alias("bytes"),
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
    )


def ingest_volume_by_partition(df: DataFrame, partition: str = "partition") -> DataFrame:
    """Rows, bytes, first and last time by source type, topic and log partition."""
    return df.groupBy("source_type", "topic", partition).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("size_bytes").alias("bytes"),
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
    )
