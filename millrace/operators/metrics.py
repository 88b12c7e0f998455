"""Metric roll-ups, moving averages, threshold rules and sustained breaches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.ordered import (
    BUCKET_SECONDS,
    exact_quantiles,
    latest_before,
    quantile_bracket,
    runs,
    trailing_mean,
    trailing_rows,
)
from millrace.functions.scalars import time_bucket
from millrace.operators.requests import cumulative_histogram, histogram_columns
from millrace.schemas import DURATION_BOUNDS
from millrace.sources.workspace import shared_folder

# Up to this many rules, given as a list, are sent to every task; more are joined.
BROADCAST_RULES = 10_000


@dataclass(frozen=True)
class Trigger:
    """Breached while the value of ``metric`` compares ``op`` to ``threshold``;
    sustained after ``steps`` consecutive time steps."""

    metric: str
    op: str
    threshold: float
    steps: int = 1


# Scaling conditions per minute.
DEFAULT_TRIGGERS = (
    Trigger("cpu_usage_percent", ">", 70.0, 5),
    Trigger("memory_usage_percent", ">", 80.0, 5),
    Trigger("queue_size", ">", 1000.0, 1),
    Trigger("average_response_time_ms", ">", 2000.0, 1),
    Trigger("error_rate_percent", ">", 5.0, 2),
)

_OPS = (">", ">=", "<", "<=", "=")


def trigger_table(spark: SparkSession, triggers: Sequence[Trigger] | DataFrame) -> DataFrame:
    """The rules as a table ``(metric, op, threshold, steps)``.

    A list of checked size is marked for broadcast.  A table of rules may have
    any size: how it is joined is left to adaptive execution.
    """
    if isinstance(triggers, DataFrame):
        return triggers.select("metric", "op", F.col("threshold").cast("double"), F.col("steps").cast("int")).filter(
            F.col("op").isin(*_OPS)
        )
    for t in triggers:
        if t.op not in _OPS:
            raise ValueError(f"unknown comparison: {t.op}")
    rows = [(t.metric, t.op, float(t.threshold), t.steps) for t in triggers]
    table = spark.createDataFrame(rows, "metric string, op string, threshold double, steps int")
    return F.broadcast(table) if len(rows) <= BROADCAST_RULES else table


def breached(value: Column) -> Column:
    limit = F.col("threshold")
    return (
        F.when(F.col("op") == ">", value > limit)
        .when(F.col("op") == ">=", value >= limit)
        .when(F.col("op") == "<", value < limit)
        .when(F.col("op") == "<=", value <= limit)
        .otherwise(value == limit)
    )


def threshold_hits(points: DataFrame, triggers: Sequence[Trigger] | DataFrame) -> DataFrame:
    """Metric points that breach a rule.

    A list of rules is broadcast, so the points are not moved at all; rules
    whose comparison is unknown are refused in a list and ignored in a table.
    """
    rules = trigger_table(points.sparkSession, triggers)
    return (
        points.join(rules, points["name"] == rules["metric"])
        .filter(breached(F.col("value")))
        .drop("metric", "steps")
    )


def sustained_breach(points: DataFrame, triggers: Sequence[Trigger] | DataFrame, step_seconds: int = 60) -> DataFrame:
    """Runs of consecutive steps whose mean value breaches a rule long enough.

    ``points`` is ``(metric, ts, value)``.  Points are averaged per metric and
    step first, so the ordered part sees one row per metric and step.  A step
    without points ends a run.
    """
    steps = (
        points.withColumn("_step", time_bucket("ts", step_seconds))
        .groupBy("metric", "_step")
        .agg(F.avg("value").alias("_mean"))
    )
    rules = trigger_table(points.sparkSession, triggers)
    hits = steps.join(rules, "metric").filter(breached(F.col("_mean")))
    rule = ["metric", "op", "threshold", "steps"]

    def moment(step: Column) -> Column:
        return F.timestamp_seconds(step * step_seconds).cast("timestamp_ntz")

    return (
        runs(hits, rule, "_step", "_run")
        .groupBy(*rule, "_run")
        .agg(
            F.min("_step").alias("_first"),
            F.max("_step").alias("_last"),
            F.count(F.lit(1)).alias("length"),
            F.max("_mean").alias("peak"),
        )
        .filter(F.col("length") >= F.col("steps"))
        .select(
            "metric", "op", "threshold",
            moment(F.col("_first")).alias("started_at"),
            moment(F.col("_last") + 1).alias("ended_at"),
            "length", "peak",
        )
    )


def request_points(log: DataFrame) -> DataFrame:
    """The request log as metric points: response time and error rate."""
    error = F.when(F.col("status_code") >= 500, 100.0).otherwise(0.0)
    pairs = F.array(
        F.struct(F.lit("average_response_time_ms").alias("metric"), F.col("process_time_ms").alias("value")),
        F.struct(F.lit("error_rate_percent").alias("metric"), error.alias("value")),
    )
    return log.select("ts", F.explode(pairs).alias("_p")).select("_p.metric", "ts", "_p.value")


def system_points(samples: DataFrame) -> DataFrame:
    """System samples as metric points."""
    names = ("cpu_usage_percent", "memory_usage_percent", "disk_usage_percent")
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])
    return samples.select(F.col("created_at").alias("ts"), F.explode(pairs).alias("_p")).select(
        "_p.metric", "ts", "_p.value"
    )


def alert_current_values(
    alerts: DataFrame, metrics: DataFrame, bucket_seconds: int = BUCKET_SECONDS
) -> DataFrame:
    """Alerts with the newest value of their metric at or before their creation."""
    probes = alerts.drop("current_value")
    points = metrics.select(
        F.col("name").alias("metric_name"), "created_at", "value", F.col("id").alias("_point_id")
    )
    return latest_before(
        probes, points, "metric_name", "created_at",
        F.col("value"), [F.col("_point_id")], "current_value", bucket_seconds,
    )


def moving_average_rows(
    df: DataFrame, key: str, ts: str, tie: str, value: str, rows: int,
    chunk_rows: int = 1_000_000, bucket_seconds: int | None = None,
) -> DataFrame:
    """Mean of the current and the preceding ``rows - 1`` values of the key.

    ``bucket_seconds`` numbers the rows by time buckets instead of staging them.
    """
    bucket = time_bucket(ts, bucket_seconds) if bucket_seconds else None
    order = [F.col(ts), F.col(tie)]
    return trailing_rows(df, [key], order, bucket, rows, {"moving_average": F.avg(value)}, chunk_rows)


def moving_average_range(df: DataFrame, key: str, ts: str, value: str, seconds: int) -> DataFrame:
    """Mean of the key's values in the last ``seconds``, the current row included."""
    return trailing_mean(df, [key], ts, value, seconds)


def label_key(labels: Column | str) -> Column:
    """A label map as a group key: its entries in key order, as text."""
    return F.to_json(F.array_sort(F.map_entries(labels)))


def counter_totals(metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        metrics.filter(F.col("type") == "counter")
        .groupBy(*keys)
        .agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("points"))
    )


def gauge_latest(metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        metrics.filter(F.col("type") == "gauge")
        .groupBy(*keys)
        .agg(
            F.max_by("value", F.struct("created_at", "id")).alias("value"),
            F.count(F.lit(1)).alias("points"),
        )
    )


def histogram_buckets(
    metrics: DataFrame, keys: Sequence[str], bounds: Sequence[float] = DURATION_BOUNDS
) -> DataFrame:
    return cumulative_histogram(metrics.filter(F.col("type") == "histogram"), keys, F.col("value"), bounds)


def summary_quantiles(
    metrics: DataFrame, keys: Sequence[str], probs: Sequence[float] = (0.5, 0.9, 0.99)
) -> DataFrame:
    return exact_quantiles(metrics.filter(F.col("type") == "summary"), keys, "value", probs)


def metric_rollup(
    metrics: DataFrame,
    keys: Sequence[str],
    bounds: Sequence[float] = DURATION_BOUNDS,
    probs: Sequence[float] = (0.5, 0.9, 0.99),
) -> DataFrame:
    """All metric types in one long table ``(keys, stat, value)``.

    Counters are summed, gauges keep their last value, histograms become
    cumulative buckets and summaries exact quantiles.  One aggregate serves all
    types; it is kept as a table of one row per group, and only the values of
    summaries are read again, to be ranked inside the brackets found.
    """
    kind = F.col("type")

    def of(name: str, value: Column | str = "value") -> Column:
        return F.when(kind == name, F.col(value) if isinstance(value, str) else value)

    counts = [*histogram_columns(of("histogram"), bounds), F.count(of("histogram"))]
    grouped = metrics.groupBy(*keys).agg(
        *[F.count_if(kind == name).alias(f"_n_{name}") for name in ("counter", "gauge", "histogram")],
        F.sum(of("counter")).alias("_sum"),
        F.max_by(of("gauge"), of("gauge", F.struct("created_at", "id"))).alias("_last"),
        *[c.alias(f"_le{i}") for i, c in enumerate(counts)],
        *quantile_bracket(of("summary"), probs),
    )
    path = shared_folder(metrics.sparkSession, "rollup")
    grouped.write.parquet(path)
    grouped = metrics.sparkSession.read.schema(grouped.schema).parquet(path)

    def entry(stat: Column, value: str) -> Column:
        return F.struct(stat.alias("stat"), F.col(value).cast("double").alias("value"))

    def when(name: str, *entries: Column) -> Column:
        return F.when(F.col(f"_n_{name}") > 0, F.array(*entries))

    named = [*[F.concat(F.lit("le_"), F.lit(float(b)).cast("string")) for b in bounds], F.lit("le_inf")]
    found = F.concat(
        *[
            F.coalesce(part, F.array().cast("array<struct<stat: string, value: double>>"))
            for part in (
                when("counter", entry(F.lit("total"), "_sum")),
                when("gauge", entry(F.lit("last"), "_last")),
                when("histogram", *[entry(name, f"_le{i}") for i, name in enumerate(named)]),
            )
        ]
    )
    plain = grouped.select(*keys, F.inline(found))
    brackets = grouped.filter(F.col("_total") > 0).select(*keys, "_edges", "_total")
    ranked = exact_quantiles(metrics.filter(kind == "summary"), keys, "value", probs, brackets=brackets)
    quantiles = ranked.select(*keys, F.concat(F.lit("q_"), F.col("p").cast("string")).alias("stat"), F.col("quantile").cast("double").alias("value"))
    return plain.unionByName(quantiles)


def system_rollup(samples: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Long table ``(keys, measure, item, value)`` of system samples.

    Mean and peak of the percentages, sums of the byte maps by key, and the
    element-wise mean of the load averages.
    """

    def entry(kind: str, item: Column, value: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), item.cast("string").alias("item"), value.cast("double").alias("value")
        )

    def entries(values: Column) -> Column:
        return F.coalesce(values, F.array().cast("array<struct<kind:string,item:string,value:double>>"))

    # All measurements of a sample as one list: one scan and one shuffle for all of them.
    percents = ("cpu_usage_percent", "memory_usage_percent", "disk_usage_percent")
    listed = [F.array(*[entry(p, F.lit(None), F.col(p)) for p in percents])]

    def bytes_of(name: str) -> Column:
        return entries(F.transform(F.map_entries(name), lambda e: entry(name, e["key"], e["value"])))

    listed += [bytes_of("network_io_bytes"), bytes_of("disk_io_bytes")]
    listed.append(entries(F.transform("load_average", lambda x, i: entry("load_average", i, x))))
    sums = (
        samples.select(*keys, F.inline(F.concat(*listed)))
        .groupBy(*keys, "kind", "item")
        .agg(F.avg("value").alias("avg"), F.max("value").alias("max"), F.sum("value").alias("sum"))
    )

    def measure(fn: str) -> Column:
        return F.struct(F.concat(F.lit(f"{fn}_"), "kind").alias("measure"), F.col(fn).alias("value"))

    chosen = (
        F.when(F.col("kind").isin(*percents), F.array(measure("avg"), measure("max")))
        .when(F.col("kind") == "load_average", F.array(measure("avg")))
        .otherwise(F.array(measure("sum")))
    )
    return sums.select(*keys, "item", F.inline(chosen))
