"""Windowed roll-ups and joins of streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import micros
from millrace.operators.requests import rolling_clients, rolling_counts
from millrace.streaming.source import event_time


def rolling_stream(log: DataFrame, window: str, delay: str, slide: str | None = None) -> DataFrame:
    """Requests per window; a window is emitted once the watermark passes its end.

    The same function serves batch and stream, only the watermark differs.
    """
    return rolling_counts(event_time(log, "ts", delay), window, slide)


def rolling_clients_stream(log: DataFrame, window: str, delay: str, slide: str) -> DataFrame:
    """Distinct clients per sliding window, from one sketch for each step; see ``rolling_clients``."""
    return rolling_clients(event_time(log, "ts", delay), window, slide, approximate=True)


def outputs_of_jobs(jobs: DataFrame, outputs: DataFrame, delay: str, within_seconds: int) -> DataFrame:
    """Match outputs with the start of their job, at most ``within_seconds`` later.

    ``jobs`` is ``(job_id, started_at)``, ``outputs`` ``(job_id, output_at)``.
    Both watermarks and the time bound let the engine drop old state.
    """
    left = event_time(jobs, "started_at", delay)
    right = event_time(outputs.withColumnRenamed("job_id", "_job_id"), "output_at", delay)
    bound = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(within_seconds)))
    matched = left.join(
        right,
        (F.col("job_id") == F.col("_job_id"))
        & (F.col("output_at") >= F.col("started_at"))
        & (F.col("output_at") <= F.col("started_at") + bound),
    )
    return matched.drop("_job_id").withColumn(
        "seconds", (micros("output_at") - micros("started_at")) / F.lit(1_000_000)
    )
