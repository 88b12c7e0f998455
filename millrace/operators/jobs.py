"""Job life cycle: state from events, retries, time-outs, summary."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import naive, plus, seconds_between
from millrace.schemas import JOB_TIMEOUT_SECONDS, RETRY_DELAY_SECONDS

# Event names of a job's history.
CREATED, STARTED, COMPLETED, FAILED = "created", "started", "completed", "failed"


def fold_jobs(events: DataFrame) -> DataFrame:
    """Newest state of each job from ``(job_id, ts, event, seq, error_message)``.

    Starting sets the state to processing.  Completing sets progress to 100;
    failing leaves progress as it was.  Both stamp ``completed_at`` and, if the
    job had been started by then, the duration.  Nothing is ever cleared.

    Each column is a ``max``/``max_by`` that is combined before the shuffle, so
    a job with very many events is no heavier than any other.  The start that
    belongs to the last finish may not be the last start; that needs a second
    look only for jobs started again after they finished.
    """
    at = F.struct("ts", "seq")
    is_start = F.col("event") == STARTED
    is_finish = F.col("event").isin(COMPLETED, FAILED)
    is_change = is_start | is_finish
    summary = events.groupBy("job_id").agg(
        F.min(F.when(F.col("event") == CREATED, F.col("ts"))).alias("created_at"),
        F.max_by("event", F.when(is_change, at)).alias("_event"),
        F.max(F.when(is_change, F.col("ts"))).alias("updated_at"),
        F.max(F.when(is_start, at)).alias("_start"),
        F.max(F.when(is_finish, at)).alias("_finish"),
        F.max_by("error_message", F.when(F.col("event") == FAILED, at)).alias("error_message"),
        F.count_if(F.col("event") == COMPLETED).alias("_completions"),
    )
    again = summary.filter(F.col("_start") > F.col("_finish")).select("job_id", "_finish")
    starts = events.filter(is_start).select("job_id", at.alias("_at"))
    earlier = (
        starts.join(again, "job_id")
        .filter(F.col("_at") < F.col("_finish"))
        .groupBy("job_id")
        .agg(F.max("_at").alias("_earlier"))
    )
    start_of_run = F.when(F.col("_start") < F.col("_finish"), F.col("_start")).otherwise(F.col("_earlier"))
    status = (
        F.when(F.col("_event") == STARTED, F.lit("processing"))
        .when(F.col("_event").isNull(), F.lit("pending"))
        .otherwise(F.col("_event"))
    )
    return summary.join(earlier, "job_id", "left").select(
        "job_id",
        status.alias("status"),
        F.when(F.col("_completions") > 0, 100.0).otherwise(0.0).alias("progress_percentage"),
        "error_message",
        "created_at",
        F.col("_start.ts").alias("started_at"),
        F.col("_finish.ts").alias("completed_at"),
        seconds_between(start_of_run["ts"], F.col("_finish.ts")).alias("duration_seconds"),
        "updated_at",
    )


def current_state(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest version of each key from a table of versions.

    ``max_by`` over the whole row, combined before the shuffle: only one
    version per key and task is moved.
    """
    newest = F.struct(F.coalesce(F.col("updated_at"), F.col("created_at")), F.col("id"))
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), newest).alias("_row")).select(*keys, "_row.*")


def _can_retry() -> Column:
    return (F.col("status") == "failed") & (F.col("retry_count") < F.col("max_retries"))


def retryable(df: DataFrame) -> DataFrame:
    """Failed jobs with retries left."""
    return df.filter(_can_retry())


def retry_schedule(df: DataFrame, delay_seconds: int = RETRY_DELAY_SECONDS) -> DataFrame:
    """Retryable jobs with the time of the next attempt."""
    return retryable(df).withColumns(
        {
            "next_attempt_at": plus(F.col("completed_at"), seconds=delay_seconds),
            "attempt": (F.col("retry_count") + 1).cast("long"),
        }
    )


def timed_out(df: DataFrame, as_of: datetime, limit_seconds: int = JOB_TIMEOUT_SECONDS) -> DataFrame:
    """Started jobs that ran, or have been running, longer than the limit."""
    elapsed = seconds_between(F.col("started_at"), F.coalesce(F.col("completed_at"), naive(as_of)))
    return df.withColumn("elapsed_seconds", elapsed).filter(F.col("elapsed_seconds") > limit_seconds)


def job_summary(df: DataFrame) -> DataFrame:
    """Per status: jobs, mean progress, mean duration, retries used."""
    return df.groupBy("status").agg(
        F.count(F.lit(1)).alias("jobs"),
        F.avg("progress_percentage").alias("mean_progress"),
        F.avg("duration_seconds").alias("mean_duration_seconds"),
        F.sum("retry_count").cast("long").alias("retries_used"),
    )
