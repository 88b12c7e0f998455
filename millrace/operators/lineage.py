"""Joins between inputs, jobs and outputs.

``ingestion.id`` and ``jobs.job_id`` are unique; ``jobs.input_data_id`` and
``outputs.job_id`` may repeat heavily.  The repeating side is always the one
adaptive execution can split (the left side of an inner, left, semi or anti
join); where only the existence of a key matters, keys are made distinct
before they are moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import seconds_between


def _matches_input(jobs: DataFrame, ingestion: DataFrame) -> Column:
    return jobs["input_data_id"] == ingestion["id"]


def _keys(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.select(F.col(column).alias(name)).distinct()


def jobs_with_input(jobs: DataFrame, ingestion: DataFrame, how: str = "inner") -> DataFrame:
    """Jobs next to their input record; ``how`` is inner or left."""
    record = ingestion.select(
        F.col("id").alias("input_id"),
        "source_type",
        "source_id",
        F.col("created_at").alias("input_created_at"),
    )
    return jobs.join(record, jobs["input_data_id"] == record["input_id"], how)


def outputs_with_job(outputs: DataFrame, jobs: DataFrame, how: str = "inner") -> DataFrame:
    """Outputs next to the job that made them; ``how`` is inner or left."""
    job = jobs.select(
        F.col("job_id").alias("_job_id"), "job_name", "status", "input_data_id", "started_at", "completed_at"
    )
    return outputs.join(job, outputs["job_id"] == job["_job_id"], how).drop("_job_id")


def unprocessed(ingestion: DataFrame, jobs: DataFrame) -> DataFrame:
    """Ingestion records that no job refers to."""
    keys = _keys(jobs, "input_data_id", "_key")
    return ingestion.join(keys, ingestion["id"] == keys["_key"], "left_anti")


def orphan_jobs(jobs: DataFrame, ingestion: DataFrame) -> DataFrame:
    """Jobs whose input record does not exist."""
    return jobs.join(ingestion, _matches_input(jobs, ingestion), "left_anti")


def orphan_outputs(outputs: DataFrame, jobs: DataFrame) -> DataFrame:
    """Outputs whose job does not exist."""
    return outputs.join(jobs, "job_id", "left_anti")


def jobs_with_output(jobs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Jobs that produced at least one output."""
    return jobs.join(_keys(outputs, "job_id", "job_id"), "job_id", "left_semi")


def lineage(ingestion: DataFrame, jobs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Input, job and output in one row, with the latency of each hop.

    Every ingestion record appears; job and output are null where missing.
    The left joins are written as an inner join (its repeating side on the
    left, so a hot key can be split) plus the rows without a partner.
    """
    named = [F.col("id").alias("input_id"), F.col("source_type"), F.col("created_at").alias("ingested_at")]
    record = ingestion.select(*named)
    job = jobs.select(
        F.col("job_id"), F.col("input_data_id"), "status",
        F.col("created_at").alias("job_created_at"), "started_at", "completed_at",
    )
    output = outputs.select(
        F.col("id").alias("output_id"), F.col("job_id").alias("_job_id"), F.col("created_at").alias("output_at")
    )

    # Every job with its outputs first, so that the records are read once for all of them.
    made = _keys(outputs, "job_id", "_job_id")
    finished = output.join(job, output["_job_id"] == job["job_id"]).drop("_job_id")
    unfinished = job.join(made, job["job_id"] == made["_job_id"], "left_anti")
    done = finished.unionByName(unfinished, allowMissingColumns=True)
    started = done.join(record, done["input_data_id"] == record["input_id"]).drop("input_data_id")
    idle = unprocessed(ingestion, jobs).select(*named)
    rows = started.unionByName(idle, allowMissingColumns=True)
    return rows.select(
        "input_id", "source_type", "ingested_at", "job_id", "status", "output_id",
        seconds_between("ingested_at", "job_created_at").alias("queue_seconds"),
        seconds_between("started_at", "completed_at").alias("run_seconds"),
        seconds_between("completed_at", "output_at").alias("publish_seconds"),
    )
