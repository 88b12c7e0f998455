"""Service health from recorded checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CRITICAL = ("database", "kafka")


def latest_checks(checks: DataFrame) -> DataFrame:
    """The newest status of each service."""
    return checks.groupBy("service").agg(F.max_by("status", F.struct("ts", "id")).alias("status"))


def health_overall(checks: DataFrame) -> DataFrame:
    """One row: a sick database makes the whole unhealthy, a sick log degraded."""
    sick = F.col("status") == "unhealthy"
    flags = latest_checks(checks).agg(
        F.coalesce(F.bool_or(sick & (F.col("service") == "database")), F.lit(False)).alias("_database"),
        F.coalesce(F.bool_or(sick & (F.col("service") == "kafka")), F.lit(False)).alias("_kafka"),
        F.count(F.lit(1)).alias("services"),
    )
    status = F.when(F.col("_database"), "unhealthy").when(F.col("_kafka"), "degraded").otherwise("healthy")
    return flags.select(status.alias("overall_status"), "services")


def health_ready(checks: DataFrame, critical: Sequence[str] = CRITICAL) -> DataFrame:
    """One row: every critical service was seen and none is unhealthy."""
    known = latest_checks(checks.filter(F.col("service").isin(*critical)))
    every = F.count(F.lit(1)) == len(critical)
    return known.agg(
        (every & F.coalesce(F.bool_and(F.col("status") != "unhealthy"), F.lit(False))).alias("ready")
    )
