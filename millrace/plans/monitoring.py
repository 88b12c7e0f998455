"""Queries: request log, metrics, alerts, health, rate limit."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.ordered import trailing_mean
from millrace.functions.scalars import minus, naive
from millrace.operators import alerts as alert_ops
from millrace.operators import algorithms, health
from millrace.operators import metrics as metric_ops
from millrace.operators import requests as request_ops
from millrace.operators.metrics import Trigger
from millrace.operators.ratelimit import rate_limit
from millrace.plans import records
from millrace.plans.records import AS_OF, ctes
from millrace.plans.registry import query
from millrace.sources.tables import load


@query(
    "request_counts",
    ctes("request_log")
    + """select method, endpoint, status_code, count(*) as requests
from request_log group by method, endpoint, status_code""",
)
def request_counts(spark, folder):
    return request_ops.request_counts(records.request_log(spark, folder))


_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)


def _bucket_rows(keys: str, value: str, table: str, bounds) -> str:
    """One select per bucket, united."""
    parts = [
        f"select {keys}, {b!r}::double as le, count(*) filter (where {value} <= {b!r}::double) as n, "
        f"count(*) as total, sum({value}) as sum from {table} group by {keys}"
        for b in bounds
    ]
    parts.append(
        f"select {keys}, 'inf'::double as le, count(*) as n, count(*) as total, sum({value}) as sum "
        f"from {table} group by {keys}"
    )
    return "\nunion all\n".join(parts)


@query(
    "duration_histogram",
    ctes("request_log")
    + ",\nbuckets as ("
    + _bucket_rows("method, endpoint", "process_time_ms / 1000", "request_log", _BOUNDS)
    + ")\nselect method, endpoint, le, n, total, round(sum, 6) as sum from buckets",
)
def duration_histogram(spark, folder):
    out = request_ops.duration_histogram(records.request_log(spark, folder))
    return out.withColumn("sum", F.round("sum", 6))


_MESSAGES_SQL = """messages as (
select ts, case when ts >= timestamp '2024-01-31 00:00:00' - interval 2 hour then null
  else event_type <> 'error' end as ok
from events)"""


def _messages(spark, folder):
    """The log as seen by a consumer: the last two hours are still queued."""
    log = records.request_log(spark, folder)
    queued = F.col("ts") >= minus(naive(AS_OF), hours=2)
    return log.select("ts", F.when(~queued, F.col("status_code") < 500).alias("ok"))


@query(
    "app_metrics",
    ctes("request_log")
    + f""",
{_MESSAGES_SQL},
r as (select * from request_log where ts >= timestamp '2024-01-31 00:00:00' - interval 1440 minute),
m as (select * from messages where ok is null or ts >= timestamp '2024-01-31 00:00:00' - interval 1440 minute)
select (select count(distinct client_id) from r) as active_connections,
  round((select count(*) from r) / (1440 * 60), 9) as requests_per_second,
  round((select avg(process_time_ms) from r), 6) as average_response_time_ms,
  round((select 100.0 * count(*) filter (where status_code >= 500) / count(*) from r), 6) as error_rate_percent,
  (select count(*) from m where ok is null) as queue_size,
  (select count(*) from m where ok) as processed_messages,
  (select count(*) from m where not ok) as failed_messages""",
)
def app_metrics(spark, folder):
    """A day instead of five minutes: the given log is thin at its end."""
    out = request_ops.app_metrics(
        records.request_log(spark, folder), _messages(spark, folder), AS_OF, minutes=1440
    )
    return out.withColumns(
        {
            "requests_per_second": F.round("requests_per_second", 9),
            "average_response_time_ms": F.round("average_response_time_ms", 6),
            "error_rate_percent": F.round("error_rate_percent", 6),
        }
    )


@query(
    "rolling_clients",
    ctes("request_log")
    + """,
steps as (select distinct time_bucket(interval 6 hour, ts, timestamp '1970-01-01') as step, client_id from request_log),
frames as (select step - to_hours(6 * k) as window_start, client_id from steps, range(4) as r(k))
select window_start, window_start + interval 24 hour as window_end, count(distinct client_id) as clients
from frames group by window_start""",
)
def rolling_clients(spark, folder):
    """Distinct clients of the last day, every six hours."""
    out = request_ops.rolling_clients(records.request_log(spark, folder), "24 hours", "6 hours")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


_ROLLUP_BOUNDS = (5.0, 10.0, 25.0, 50.0, 75.0, 100.0, 250.0, 500.0)


def _quantile_sql(p: float) -> str:
    return (
        f"select name, label_slot, 'q_{p}' as stat, min(value) as value from ranked "
        f"where upto >= greatest(ceil({p}::double * total), 1) group by name, label_slot"
    )


@query(
    "metric_rollup",
    ctes("metrics")
    + """,
slots as (select *, cast(label_user as bigint) % 3 as label_slot from metrics),
h as (select * from slots where type = 'histogram'),
ranked as (
  select name, label_slot, value,
    row_number() over (partition by name, label_slot order by value) as upto,
    count(*) over (partition by name, label_slot) as total
  from slots where type = 'summary'),
buckets as ("""
    + _bucket_rows("name, label_slot", "value", "h", _ROLLUP_BOUNDS)
    + """),
rolled as (
select name, label_slot, 'total' as stat, sum(value) as value from slots where type = 'counter'
group by name, label_slot
union all
select name, label_slot, 'last', arg_max(value, (created_at, id)) from slots where type = 'gauge'
group by name, label_slot
union all
select name, label_slot, case when isinf(le) then 'le_inf' else 'le_' || cast(le as varchar) end, cast(n as double)
from buckets
union all """
    + " union all ".join(_quantile_sql(p) for p in (0.5, 0.9, 0.99))
    + ")\nselect name, label_slot, stat, round(value, 6) as value from rolled",
)
def metric_rollup(spark, folder):
    slots = records.metrics(spark, folder).withColumn("label_slot", F.col("label_user").cast("long") % 3)
    out = metric_ops.metric_rollup(slots, ["name", "label_slot"], _ROLLUP_BOUNDS)
    return out.withColumn("value", F.round("value", 6))


@query(
    "label_totals",
    ctes("metrics")
    + """select name, '[{"key":"user","value":"' || label_user || '"}]' as labels,
  round(sum(value), 6) as value, count(*) as points
from metrics where type = 'counter' group by name, label_user""",
)
def label_totals(spark, folder):
    """Counters by name and label map; a map becomes a group key as text."""
    points = records.metrics(spark, folder).withColumn(
        "labels", metric_ops.label_key(F.create_map(F.lit("user"), F.col("label_user")))
    )
    out = metric_ops.counter_totals(points, ["name", "labels"])
    return out.withColumn("value", F.round("value", 6))


@query(
    "system_rollup",
    ctes("system_samples")
    + """,
clean as (select * from system_samples where memory_usage_percent between 0 and 100
  and not isnan(memory_usage_percent)),
long as ("""
    + " union all ".join(
        f"select host, '{fn}_{c}' as measure, cast(null as varchar) as item, {fn}({c}) as value "
        "from clean group by host"
        for c in ("cpu_usage_percent", "memory_usage_percent", "disk_usage_percent")
        for fn in ("avg", "max")
    )
    + " union all "
    + " union all ".join(
        f"select host, 'sum_{m}', '{item}', cast(sum({e}) as double) from clean group by host"
        for m, item, e in (
            ("network_io_bytes", "rx", "id * 10"),
            ("network_io_bytes", "tx", "user_id * 5"),
            ("disk_io_bytes", "read", "id * 3"),
            ("disk_io_bytes", "write", "user_id"),
        )
    )
    + " union all "
    + " union all ".join(
        f"select host, 'avg_load_average', '{i}', avg(value / {d}) from clean group by host"
        for i, d in ((0, 1), (1, 2), (2, 4))
    )
    + ")\nselect host, measure, item, round(value, 6) as value from long",
)
def system_rollup(spark, folder):
    samples = records.system_samples(spark, folder)
    memory = F.col("memory_usage_percent")
    clean = samples.filter(memory.between(0, 100) & ~F.isnan(memory))
    out = metric_ops.system_rollup(clean, ["host"])
    return out.select("host", "measure", "item", F.round("value", 6).alias("value"))


_LATEST_SQL = """latest as (
select service, arg_max(status, (ts, id)) as status from health_checks group by service)"""


@query(
    "health_overall",
    ctes("health_checks")
    + f""",
{_LATEST_SQL}
select case when bool_or(status = 'unhealthy' and service = 'database') then 'unhealthy'
  when bool_or(status = 'unhealthy' and service = 'kafka') then 'degraded' else 'healthy' end as overall_status,
  count(*) as services from latest""",
)
def health_overall(spark, folder):
    return health.health_overall(records.health_checks(spark, folder))


@query(
    "health_ready",
    ctes("health_checks")
    + f""",
{_LATEST_SQL}
select count(*) = 2 and bool_and(status <> 'unhealthy') as ready from latest
where service in ('database', 'kafka')""",
)
def health_ready(spark, folder):
    return health.health_ready(records.health_checks(spark, folder))


@query(
    "health_latest",
    ctes("health_checks") + f",\n{_LATEST_SQL}\nselect service, status from latest",
)
def health_latest(spark, folder):
    return health.latest_checks(records.health_checks(spark, folder))


@query(
    "alert_summary",
    ctes("alerts")
    + """select severity, service, count(*) as alerts, count(*) filter (where resolved_at is null) as active,
  round(avg((epoch_us(acknowledged_at) - epoch_us(created_at)) / 1e6), 6) as mean_ack_seconds,
  round(avg((epoch_us(resolved_at) - epoch_us(created_at)) / 1e6), 6) as mean_resolve_seconds
from alerts group by severity, service""",
)
def alert_summary(spark, folder):
    out = alert_ops.alert_summary(records.alerts(spark, folder))
    return out.withColumns({c: F.round(c, 6) for c in ("mean_ack_seconds", "mean_resolve_seconds")})


@query(
    "alert_matrix",
    ctes("alerts")
    + "select service, "
    + ", ".join(
        f"count(*) filter (where resolved_at is null and severity = '{s}') as {s}"
        for s in ("info", "warning", "error", "critical")
    )
    + " from alerts group by service",
)
def alert_matrix(spark, folder):
    return alert_ops.active_by_service(records.alerts(spark, folder))


@query(
    "alert_asof_metric",
    """with points as (
select user_id, ts, arg_max(value, event_id) as value from events where event_type <> 'error'
group by user_id, ts),
a as (select event_id as id, user_id, ts as created_at from events where event_type = 'error')
select a.id, 'user_' || cast(a.user_id as varchar) as metric_name, a.created_at, p.value as current_value
from a asof left join points p on a.user_id = p.user_id and a.created_at >= p.ts""",
)
def alert_asof_metric(spark, folder):
    """Alerts on a per-user metric take the newest point of that metric."""
    events = records.metrics(spark, folder)
    name = F.concat(F.lit("user_"), F.col("label_user"))
    is_error = F.col("name") == "events_error_value"
    points = events.filter(~is_error).select("id", name.alias("name"), "value", "created_at")
    alerts = events.filter(is_error).select(
        "id", name.alias("metric_name"), "created_at", F.lit(None).cast("double").alias("current_value")
    )
    return metric_ops.alert_current_values(alerts, points)


_RULES = (
    Trigger("events_error_value", ">", 100.0),
    Trigger("events_click_value", ">=", 75.0),
    Trigger("events_view_value", "<", 2.5),
    Trigger("events_view_value", ">", 400.0),
)


@query(
    "threshold_hits",
    ctes("metrics")
    + """,
rules(metric, op, threshold) as (values ('events_error_value', '>', 100e0), ('events_click_value', '>=', 75e0),
  ('events_view_value', '<', 2.5e0), ('events_view_value', '>', 400e0))
select m.*, op, threshold from metrics m join rules r on m.name = r.metric
where case op when '>' then value > threshold when '>=' then value >= threshold else value < threshold end""",
)
def threshold_hits(spark, folder):
    return metric_ops.threshold_hits(records.metrics(spark, folder), _RULES)


@query(
    "threshold_table",
    ctes("metrics")
    + """,
rules as (select 'events_' || event_type || '_value' as metric, '>' as op, 2 * avg(value) as threshold from events group by event_type)
select m.id, m.name, op, round(threshold, 6) as threshold from metrics m join rules r on m.name = r.metric where m.value > threshold""",
)
def threshold_table(spark, folder):
    """Rules from a table: twice the mean of each metric."""
    events = load(spark, folder, "events")
    rules = events.groupBy(F.format_string("events_%s_value", "event_type").alias("metric")).agg(
        F.lit(">").alias("op"), (2 * F.avg("value")).alias("threshold"), F.lit(1).alias("steps")
    )
    hits = metric_ops.threshold_hits(records.metrics(spark, folder), rules)
    return hits.select("id", "name", "op", F.round("threshold", 6).alias("threshold"))


_CONDITIONS = (
    ("click", "cpu_usage_percent", 1.0),
    ("view", "memory_usage_percent", 1.0),
    ("purchase", "queue_size", 12.0),
    ("signup", "average_response_time_ms", 25.0),
    ("error", "error_rate_percent", 0.1),
)
_CONDITION_VALUES = ", ".join(f"('{e}', '{m}', {f}e0)" for e, m, f in _CONDITIONS)


@query(
    "scaling_conditions",
    f"""with kind(event_type, metric, factor) as (values {_CONDITION_VALUES}),
rule(metric, threshold, need) as (values ('cpu_usage_percent', 70e0, 5), ('memory_usage_percent', 80e0, 5),
  ('queue_size', 1000e0, 1), ('average_response_time_ms', 2000e0, 1), ('error_rate_percent', 5e0, 2)),
step as (select metric, epoch_us(ts) // 21600000000 as step, avg(value * factor) as mean
  from events join kind using (event_type) group by all),
hit as (select *, step - row_number() over (partition by metric order by step) as island
  from step join rule using (metric) where mean > threshold)
select metric, threshold, make_timestamp(min(step) * 21600000000) as started_at, count(*) as length
from hit group by metric, threshold, need, island having count(*) >= need""",
)
def scaling_conditions(spark, folder):
    """The five stated conditions, over steps of six hours of values scaled to their ranges."""
    kinds = F.create_map(*[x for e, m, f in _CONDITIONS for x in (F.lit(e), F.struct(F.lit(m), F.lit(f)))])
    kind = kinds[F.col("event_type")]
    points = load(spark, folder, "events").select(
        kind["col1"].alias("metric"), "ts", (F.col("value") * kind["col2"]).alias("value")
    )
    out = metric_ops.sustained_breach(points, metric_ops.DEFAULT_TRIGGERS, step_seconds=21600)
    return out.select("metric", "threshold", "started_at", "length")


_SUSTAINED = (
    Trigger("average_response_time_ms", ">", 30.0, 3),
    Trigger("average_response_time_ms", ">", 60.0, 2),
    Trigger("error_rate_percent", ">", 25.0, 2),
)

_SUSTAINED_SQL = """points as (
select 'average_response_time_ms' as metric, ts, process_time_ms as value from request_log
union all
select 'error_rate_percent', ts, case when status_code >= 500 then 100e0 else 0e0 end from request_log),
steps as (
select metric, epoch_us(ts) // 3600000000 as step, avg(value) as mean from points group by all),
rules(metric, op, threshold, need) as (values ('average_response_time_ms', '>', 30e0, 3),
  ('average_response_time_ms', '>', 60e0, 2), ('error_rate_percent', '>', 25e0, 2)),
hits as (
select s.metric, op, threshold, need, step, mean,
  step - row_number() over (partition by s.metric, op, threshold, need order by step) as island
from steps s join rules r on s.metric = r.metric where mean > threshold),
islands as (
select metric, op, threshold, need, island, min(step) as first, max(step) as last, count(*) as length,
  max(mean) as peak
from hits group by all having count(*) >= need)"""


@query(
    "sustained_breach",
    ctes("request_log")
    + f""",
{_SUSTAINED_SQL}
select metric, op, threshold, make_timestamp(first * 3600000000) as started_at,
  make_timestamp((last + 1) * 3600000000) as ended_at, length, round(peak, 6) as peak
from islands""",
)
def sustained_breach(spark, folder):
    """Hourly steps: the given log has about one request in four minutes."""
    points = metric_ops.request_points(records.request_log(spark, folder))
    out = metric_ops.sustained_breach(points, _SUSTAINED, step_seconds=3600)
    return out.withColumn("peak", F.round("peak", 6))


@query(
    "moving_avg_rows",
    ctes("ingestion")
    + """select e.event_id as id, 'sensor-' || cast(user_id as varchar) as source_id, value,
  round(avg(value) over (partition by user_id order by ts, event_id rows between 4 preceding and current row), 6)
    as moving_average
from events e""",
)
def moving_avg_rows(spark, folder):
    """Chosen by name, as a job's configuration does."""
    rows = records.metrics(spark, folder).select(
        "id", F.concat(F.lit("sensor-"), F.col("label_user")).alias("source_id"), "value", "created_at"
    )
    out = algorithms.run(rows, {"algorithm": "moving_average", "window_size": 5})
    return out.select("id", "source_id", "value", F.round("moving_average", 6).alias("moving_average"))


@query(
    "moving_avg_range",
    """select event_id as id, 'sensor-' || cast(user_id as varchar) as source_id, value,
  round(avg(value) over w, 6) as moving_average, count(*) over w as points
from events
window w as (partition by user_id order by ts range between interval 1 day preceding and current row)""",
)
def moving_avg_range(spark, folder):
    rows = records.metrics(spark, folder).select(
        "id", F.concat(F.lit("sensor-"), F.col("label_user")).alias("source_id"), "value", "created_at"
    )
    out = algorithms.run(rows, {"algorithm": "moving_average", "window_seconds": 86400})
    return out.select(
        "id", "source_id", "value", F.round("moving_average", 6).alias("moving_average"), "points"
    )


_WILD = """case when event_id % 97 = 0 then cast('nan' as double) when event_id % 89 = 0 then cast('infinity' as double)
  when event_id % 83 = 0 then 1e17 else value end"""


@query(
    "moving_avg_range_wild",
    f"""select id, points, case when isnan(mean) then 'nan' when isinf(mean) then 'inf' else 'finite' end as kind,
  case when isnan(mean) or isinf(mean) then null when mean > 1e10 then round(mean / 1e12, 3) else round(mean, 6) end as mean
from (select event_id as id, avg({_WILD}) over w as mean, count(*) over w as points from events
window w as (partition by user_id order by ts range between interval 1 day preceding and current row))""",
)
def moving_avg_range_wild(spark, folder):
    """NaN, infinity and huge values touch only the frames they are in."""
    rows = load(spark, folder, "events").select(
        F.col("event_id").alias("id"), "user_id", "ts", F.expr(_WILD).alias("value")
    )
    out = trailing_mean(rows, ["user_id"], "ts", "value", 86400)
    mean = F.col("moving_average")
    infinite = mean == float("inf")
    return out.select(
        "id",
        "points",
        F.when(F.isnan(mean), "nan").when(infinite, "inf").otherwise("finite").alias("kind"),
        F.when(F.isnan(mean) | infinite, None)
        .when(mean > 1e10, F.round(mean / 1e12, 3))
        .otherwise(F.round(mean, 6))
        .cast("double")
        .alias("mean"),
    )


RATE_SQL = (
    ctes("request_log", recursive=True)
    + """,
numbered as (
select *, row_number() over (partition by client_id order by ts, request_id) as rn from request_log),
walk as (
select client_id, request_id, ts, rn, [ts] as kept, true as allowed, 2 as remaining from numbered where rn = 1
union all
select client_id, request_id, ts, rn,
  case when len(live) < 3 then list_append(live, ts) else live end,
  len(live) < 3,
  greatest(0, 3 - len(live) - 1)
from (
  select n.client_id, n.request_id, n.ts, n.rn,
    list_filter(w.kept, lambda k: k >= n.ts - interval 1 day) as live
  from walk w join numbered n on n.client_id = w.client_id and n.rn = w.rn + 1))
select request_id, client_id, ts, allowed, cast(remaining as bigint) as remaining,
  epoch_us(ts) // 1000000 + 86400 as reset
from walk"""
)


@query("rate_limit", RATE_SQL)
def rate_limit_query(spark, folder):
    """Three requests a day: the given clients make about two."""
    log = records.request_log(spark, folder).select("request_id", "client_id", "ts")
    return rate_limit(log, limit=3, window_seconds=86400)


def _tumbling_sql(step: str, source: str = "request_log") -> str:
    return f"""select window_start, window_start + interval {step} as window_end, count(*) as requests,
  count(*) filter (where status_code >= 500) as errors,
  round(100.0 * count(*) filter (where status_code >= 500) / count(*), 6) as error_rate_percent,
  round(avg(process_time_ms), 6) as mean_ms
from {source} group by window_start"""


TUMBLING_SQL = (
    ctes("request_log")
    + ",\nslotted as (select *, time_bucket(interval 1 minute, ts, timestamp '1970-01-01') as window_start "
    "from request_log)\n" + _tumbling_sql("1 minute", "slotted")
)
SLIDING_SQL = (
    ctes("request_log")
    + """,
slotted as (
select r.*, time_bucket(interval 1 minute, ts, timestamp '1970-01-01') - to_minutes(k) as window_start
from request_log r, range(5) as s(k))
"""
    + _tumbling_sql("5 minute", "slotted")
)


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("error_rate_percent", "mean_ms")})


@query("tumbling", TUMBLING_SQL)
def tumbling(spark, folder):
    return _rounded(request_ops.rolling_counts(records.request_log(spark, folder), "1 minute"))


@query("sliding", SLIDING_SQL)
def sliding(spark, folder):
    return _rounded(request_ops.rolling_counts(records.request_log(spark, folder), "5 minutes", "1 minute"))
