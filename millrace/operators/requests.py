"""Reports over the request log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import minus, naive
from millrace.schemas import DURATION_BOUNDS


def request_counts(log: DataFrame) -> DataFrame:
    """Requests by method, endpoint and status."""
    return log.groupBy("method", "endpoint", "status_code").agg(F.count(F.lit(1)).alias("requests"))


def histogram_columns(value: Column, bounds: Sequence[float]) -> list[Column]:
    """One cumulative count per bound, in one pass."""
    return [F.count_if(value <= F.lit(b)) for b in bounds]


def cumulative_histogram(
    df: DataFrame, keys: Sequence[str], value: Column, bounds: Sequence[float]
) -> DataFrame:
    """Rows ``(keys, le, n, total, sum)``; the last bucket of each key is +Inf.

    All buckets are counted by one aggregation and unfolded afterwards, so the
    number of rows moved does not grow with the number of buckets.
    """
    counts = histogram_columns(value, bounds)
    wide = df.groupBy(*keys).agg(
        F.array(*counts, F.count(value)).alias("_counts"),
        F.count(value).alias("total"),
        F.sum(value).alias("sum"),
    )
    limits = F.array(*[F.lit(float(b)) for b in bounds], F.lit(float("inf")))
    pairs = F.explode(F.arrays_zip(limits.alias("le"), F.col("_counts").alias("n")))
    return wide.select(*keys, pairs.alias("_b"), "total", "sum").select(
        *keys, F.col("_b.le").alias("le"), F.col("_b.n").alias("n"), "total", "sum"
    )


def duration_histogram(log: DataFrame, bounds: Sequence[float] = DURATION_BOUNDS) -> DataFrame:
    """Request durations in seconds as a cumulative histogram per endpoint."""
    return cumulative_histogram(log, ["method", "endpoint"], F.col("process_time_ms") / 1000, bounds)


def app_metrics(
    requests: DataFrame, messages: DataFrame, as_of: datetime, minutes: int = 5, approximate: bool = False
) -> DataFrame:
    """One row of application metrics over the last ``minutes``.

    ``messages`` is ``(ts, ok)``: true for processed, false for failed, null
    for still queued.  Queued messages count whatever their age.
    """
    start = minus(naive(as_of), minutes=minutes)
    recent = F.col("ts") >= start
    both = (
        requests.filter(recent)
        .select(
            F.lit(True).alias("_request"),
            F.col("client_id"),
            F.col("process_time_ms"),
            (F.col("status_code") >= 500).alias("_error"),
        )
        .unionByName(
            messages.filter(recent | F.col("ok").isNull()).select(
                F.lit(False).alias("_request"), F.col("ok").alias("_ok")
            ),
            allowMissingColumns=True,
        )
    )
    is_request = F.col("_request")
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    n = F.count_if(is_request)
    share = F.count_if(is_request & F.col("_error")) / n * 100
    return both.agg(
        distinct(F.col("client_id")).alias("active_connections"),
        (n / F.lit(minutes * 60)).alias("requests_per_second"),
        F.coalesce(F.avg("process_time_ms"), F.lit(0.0)).alias("average_response_time_ms"),
        F.when(n > 0, share).otherwise(0.0).alias("error_rate_percent"),
        F.count_if(~is_request & F.col("_ok").isNull()).alias("queue_size"),
        F.count_if(~is_request & F.col("_ok")).alias("processed_messages"),
        F.count_if(~is_request & ~F.col("_ok")).alias("failed_messages"),
    )


def rolling_counts(log: DataFrame, window: str, slide: str | None = None) -> DataFrame:
    """Requests, rate and error share per time window (tumbling or sliding)."""
    slot = F.window("ts", window, slide) if slide else F.window("ts", window)
    n = F.count(F.lit(1))
    errors = F.count_if(F.col("status_code") >= 500)
    return (
        log.groupBy(slot.alias("_w"))
        .agg(
            n.alias("requests"),
            errors.alias("errors"),
            (errors / n * 100).alias("error_rate_percent"),
            F.avg("process_time_ms").alias("mean_ms"),
        )
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                "requests", "errors", "error_rate_percent", "mean_ms")
    )


def rolling_clients(
    log: DataFrame, window: str, slide: str, approximate: bool = False, client: str = "client_id", ts: str = "ts"
) -> DataFrame:
    """Distinct clients of each sliding window: ``window_start, window_end, clients``.

    Exactly, a client is kept once per step of ``slide`` and then counted in
    every window that holds the step.  ``approximate`` keeps one sketch per
    step instead and unites those of a window: memory and rows moved do not
    grow with the clients, and the count is within about 5 % (three standard
    errors of the sketch).  The sketch form also serves streams with a
    watermark; the window must be a whole number of steps.
    """
    step = F.window(ts, slide).alias("_step")
    if approximate:
        steps = log.groupBy(step).agg(F.hll_sketch_agg(F.coalesce(F.col(client), F.lit("")), F.lit(SKETCH_BITS)).alias("_seen"))
        count = F.hll_sketch_estimate(F.hll_union_agg("_seen"))
    else:
        steps = log.select(step, F.coalesce(F.col(client), F.lit("")).alias("_client")).distinct()
        count = F.count_distinct("_client")
    frames = steps.groupBy(F.window(F.window_time("_step"), window, slide).alias("_w")).agg(count.alias("clients"))
    return frames.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "clients")


# Registers of a sketch as a power of two: a standard error of 1.04 / 2^6.
SKETCH_BITS = 12
