"""Queries: the operators as streams over the given tables, run until drained."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.metrics import Trigger, request_points
from millrace.plans import records
from millrace.plans.log import PAYLOAD, payload_rules
from millrace.plans.monitoring import RATE_SQL
from millrace.plans.records import ctes
from millrace.plans.registry import query
from millrace.schemas import ENVELOPE
from millrace.sources.workspace import shared_folder
from millrace.streaming import ingest, rollups, source, state


def _naive(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


_MESSAGE_SQL = """msgs as (
select event_id as log_offset, cast(user_id as varchar) as msg_key, cast(user_id % 12 as int) as part_id, ts,
  user_id % 10 <> 0 as readable, cast(props ->> '$.k' as bigint) as k,
  case when user_id % 10 = 0 then substr(props, 1, 5) else props end as value
from events)"""


def _messages(spark, folder):
    """Events as a stream of log messages, some of them unreadable."""
    events = source.table_stream(spark, folder, "events")
    user = F.col("user_id")
    return events.select(
        user.cast("string").alias("key"),
        F.when(user % 10 == 0, F.substring("props", 1, 5)).otherwise(F.col("props")).alias("value"),
        F.lit("data.ingestion").alias("topic"),
        (user % 12).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def _ingested(spark, folder):
    base = shared_folder(spark, "ingest")
    paths = {n: f"{base}/{n}" for n in ("table", "dead", "checkpoint")}
    writer = ingest.ingest_writer(
        _messages(spark, folder), PAYLOAD, payload_rules(), paths["table"], paths["dead"], paths["checkpoint"]
    )
    source.drain(writer)
    return paths


_POSITION = [f for f in ENVELOPE.fields if f.name in ("topic", "partition", "offset", "key", "timestamp")]


@query(
    "stream_ingest",
    f"with {_MESSAGE_SQL}\nselect msg_key, part_id, log_offset, ts, k from msgs where readable and k <= 90",
)
def stream_ingest(spark, folder):
    paths = _ingested(spark, folder)
    schema = T.StructType([*_POSITION, T.StructField("k", T.LongType())])
    rows = _naive(source.read_batches(spark, paths["table"], schema), "timestamp")
    return rows.select(
        F.col("key").alias("msg_key"), F.col("partition").alias("part_id"),
        F.col("offset").alias("log_offset"), F.col("timestamp").alias("ts"), "k",
    )


@query(
    "stream_dlq",
    f"""with {_MESSAGE_SQL}
select part_id, log_offset, value, case when readable then 'k:range' else 'k:range,value:json' end as errors
from msgs where not readable or k > 90""",
)
def stream_dlq(spark, folder):
    paths = _ingested(spark, folder)
    schema = T.StructType(
        [*_POSITION, T.StructField("value", T.StringType()),
         T.StructField("validation_errors", T.ArrayType(T.StringType()))]
    )
    rows = source.read_batches(spark, paths["dead"], schema)
    return rows.select(
        F.col("partition").alias("part_id"), F.col("offset").alias("log_offset"), "value",
        F.array_join(F.array_sort("validation_errors"), ",").alias("errors"),
    )


@query(
    "stream_dedup",
    "select cast(user_id % 12 as int) as part_id, event_id as log_offset, ts from events",
)
def stream_dedup(spark, folder):
    """Every third message is delivered twice; one copy of each is kept."""
    messages = _messages(spark, folder)
    twice = F.when(F.col("offset") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    replayed = messages.withColumn("_copy", F.explode(twice)).drop("_copy")
    base = shared_folder(spark, "dedup")
    source.drain(
        ingest.file_writer(ingest.without_replays(replayed, "1 hour"), f"{base}/out", f"{base}/checkpoint")
    )
    rows = _naive(spark.read.parquet(f"{base}/out"), "timestamp")
    return rows.select(
        F.col("partition").alias("part_id"), F.col("offset").alias("log_offset"), F.col("timestamp").alias("ts")
    )


def _closed_windows_sql(step_minutes: int, slides: int) -> str:
    return (
        ctes("request_log")
        + f""",
slotted as (
select r.*, time_bucket(interval 1 minute, ts, timestamp '1970-01-01') - to_minutes(k) as window_start
from request_log r, range({slides}) as s(k))
select window_start, window_start + to_minutes({step_minutes}) as window_end, count(*) as requests,
  count(*) filter (where status_code >= 500) as errors,
  round(100.0 * count(*) filter (where status_code >= 500) / count(*), 6) as error_rate_percent,
  round(avg(process_time_ms), 6) as mean_ms
from slotted
where window_start + to_minutes({step_minutes}) <= (select max(ts) from request_log) - interval 10 minute
group by window_start"""
    )


def _rolled(spark, folder, window, slide=None):
    log = records.request_log(spark, folder, source.table_stream)
    stream = rollups.rolling_stream(log, window, "10 minutes", slide)
    base = shared_folder(spark, "rollup")
    source.drain(ingest.file_writer(stream, f"{base}/out", f"{base}/checkpoint"))
    rows = _naive(spark.read.parquet(f"{base}/out"), "window_start", "window_end")
    return rows.withColumns({c: F.round(c, 6) for c in ("error_rate_percent", "mean_ms")})


@query("stream_tumbling", _closed_windows_sql(1, 1))
def stream_tumbling(spark, folder):
    """Windows the watermark has closed: all but the last ten minutes."""
    return _rolled(spark, folder, "1 minute")


@query("stream_sliding", _closed_windows_sql(5, 5))
def stream_sliding(spark, folder):
    return _rolled(spark, folder, "5 minutes", "1 minute")


@query(
    "stream_jobs",
    ctes("jobs")
    + """select job_id, case when status = 'retrying' then 'processing' else status end as status,
  case when status = 'completed' then 100e0 else 0e0 end as progress_percentage,
  started_at, completed_at, round(duration_seconds, 3) as duration_seconds, error_message,
  case when completed_at is not null then duration_seconds > 300
    when started_at is not null then started_at + interval 300 second < mark else false end as timed_out
from jobs, (select max(t) - interval 1 hour as mark
  from (select greatest(created_at, started_at, completed_at) as t from jobs))""",
)
def stream_jobs(spark, folder):
    events = records.job_events(spark, folder, source.table_stream)
    base = shared_folder(spark, "jobs")
    lifecycle = state.job_lifecycle(events, "1 hour")
    source.drain(ingest.batch_writer(lifecycle, f"{base}/out", f"{base}/checkpoint", "update"))
    versions = source.read_batches(spark, f"{base}/out", lifecycle.schema)
    newest = versions.groupBy("job_id").agg(F.max_by(F.struct(*lifecycle.columns), "batch_id").alias("j"))
    return newest.select("j.*").drop("events").withColumn("duration_seconds", F.round("duration_seconds", 3))


@query("stream_rate_limit", RATE_SQL)
def stream_rate_limit(spark, folder):
    log = records.request_log(spark, folder, source.table_stream).select("request_id", "client_id", "ts")
    base = shared_folder(spark, "rate")
    decided = state.rate_limit_stream(log, "1 day", limit=3, window_seconds=86400)
    source.drain(ingest.file_writer(decided, f"{base}/out", f"{base}/checkpoint"))
    rows = spark.read.parquet(f"{base}/out")
    ts = F.timestamp_micros("ts_us").cast("timestamp_ntz")
    return rows.select("request_id", "client_id", ts.alias("ts"), "allowed", "remaining", "reset")


_STREAM_RULES = (
    Trigger("average_response_time_ms", ">", 30.0, 3),
    Trigger("error_rate_percent", ">", 25.0, 2),
)


@query(
    "stream_alerts",
    ctes("request_log")
    + """,
points as (
select 'average_response_time_ms' as metric, ts, process_time_ms as value from request_log
union all
select 'error_rate_percent', ts, case when status_code >= 500 then 100e0 else 0e0 end from request_log),
steps as (
select metric, epoch_us(ts) // 3600000000 as step, avg(value) as mean from points group by all),
closed as (
select s.*, need, case when metric = 'error_rate_percent' then 25e0 else 30e0 end as threshold
from (select *, case when metric = 'error_rate_percent' then 2 else 3 end as need from steps
  where (step + 1) * 3600000000 <= (select epoch_us(max(ts)) from request_log) - 600000000) s),
hits as (
select *, step - row_number() over (partition by metric order by step) as island from closed where mean > threshold),
islands as (
select metric, threshold, need, min(step) as first, max(step) as last, count(*) as length
from hits group by metric, threshold, need, island having count(*) >= need)
select metric, threshold, 'open' as action, make_timestamp((first + need) * 3600000000) as at,
  make_timestamp(first * 3600000000) as since, cast(need as bigint) as length from islands
union all
select metric, threshold, 'resolve', make_timestamp((last + 1) * 3600000000),
  make_timestamp(first * 3600000000), length
from islands where last < (select max(step) from closed c where c.metric = islands.metric)""",
)
def stream_alerts(spark, folder):
    points = request_points(records.request_log(spark, folder, source.table_stream))
    base = shared_folder(spark, "alerts")
    steps = state.step_means(points, "10 minutes", step_seconds=3600)
    source.drain(ingest.file_writer(steps, f"{base}/steps", f"{base}/checkpoint-steps"))
    closed = source.file_stream(spark, f"{base}/steps", steps.schema, max_files=None)
    alerts = state.alert_stream(closed, _STREAM_RULES, step_seconds=3600)
    source.drain(ingest.file_writer(alerts, f"{base}/out", f"{base}/checkpoint"))
    rows = spark.read.parquet(f"{base}/out")
    return rows.select(
        "metric", "threshold", "action",
        F.timestamp_micros("at_us").cast("timestamp_ntz").alias("at"),
        F.timestamp_micros("since_us").cast("timestamp_ntz").alias("since"), "length",
    )


_SILENT_RULES = (Trigger("early", ">", 5.0, 2), Trigger("whole", ">", 30.0, 3))


@query(
    "stream_alerts_silent",
    """with points as (
select 'whole' as metric, ts, value from events
union all
select 'early', ts, value from events where ts < timestamp '2024-01-12 00:00:00'),
steps as (
select metric, epoch_us(ts) // 3600000000 as step, avg(value) as mean from points group by all),
closed as (
select *, case when metric = 'early' then 2 else 3 end as need, case when metric = 'early' then 5e0 else 30e0 end as threshold
from steps where (step + 1) * 3600000000 <= (select epoch_us(max(ts)) from events) - 600000000),
hits as (
select *, step - row_number() over (partition by metric order by step) as island from closed where mean > threshold),
islands as (
select metric, need, min(step) as first, max(step) as last, count(*) as length
from hits group by metric, need, island having count(*) >= need)
select metric, 'open' as action, make_timestamp((first + need) * 3600000000) as at from islands
union all
select metric, 'resolve', make_timestamp((last + 1) * 3600000000) from islands
where last < (select max(step) from closed c where c.metric = islands.metric)
  or last + 4 <= (select max(step) from closed)""",
)
def stream_alerts_silent(spark, folder):
    """A metric that falls silent while another goes on is resolved."""
    events = source.table_stream(spark, folder, "events")
    point = F.struct(F.lit("whole").alias("metric"), "ts", "value")
    early = F.when(F.col("ts") < "2024-01-12", F.struct(F.lit("early").alias("metric"), "ts", "value"))
    points = events.select(F.inline(F.array_compact(F.array(point, early))))
    base = shared_folder(spark, "silent")
    steps = state.step_means(points, "10 minutes", step_seconds=3600)
    source.drain(ingest.file_writer(steps, f"{base}/steps", f"{base}/checkpoint-steps"))
    closed = source.file_stream(spark, f"{base}/steps", steps.schema, max_files=None)
    alerts = state.alert_stream(closed, _SILENT_RULES, step_seconds=3600)
    source.drain(ingest.file_writer(alerts, f"{base}/out", f"{base}/checkpoint"))
    at = F.timestamp_micros("at_us").cast("timestamp_ntz")
    return spark.read.parquet(f"{base}/out").select("metric", "action", at.alias("at"))


_NO_TIME = "case when event_id % 50 = 0 then null else ts end"


@query(
    "stream_rate_limit_nulls",
    f"""select event_id as request_id, cast(user_id as varchar(20)) as client_id, ts is null as untimed,
  ts is not null and n <= 100000 as allowed
from (select *, count(*) over (partition by user_id order by ts) as n
  from (select event_id, user_id, {_NO_TIME} as ts from events))""",
)
def stream_rate_limit_nulls(spark, folder):
    """Requests without a time are answered, and do not end the stream."""
    events = source.table_stream(spark, folder, "events")
    log = events.select(
        F.col("event_id").alias("request_id"),
        F.col("user_id").cast("string").alias("client_id"),
        F.expr(_NO_TIME).alias("ts"),
    )
    base = shared_folder(spark, "rate-nulls")
    decided = state.rate_limit_stream(log, "1 day", limit=100_000, window_seconds=86400)
    source.drain(ingest.file_writer(decided, f"{base}/out", f"{base}/checkpoint"))
    rows = spark.read.parquet(f"{base}/out")
    return rows.select("request_id", "client_id", F.col("ts_us").isNull().alias("untimed"), "allowed")


@query(
    "stream_join",
    ctes("jobs")
    + """select job_id, started_at, completed_at as output_at, duration_seconds as seconds from jobs
where completed_at is not null and duration_seconds <= 600""",
)
def stream_join(spark, folder):
    """Starts and finishes of jobs as two streams, matched within ten minutes."""
    starts = records.jobs(spark, folder, source.table_stream).select("job_id", "started_at")
    ends = records.jobs(spark, folder, source.table_stream).select("job_id", F.col("completed_at").alias("output_at"))
    base = shared_folder(spark, "join")
    joined = rollups.outputs_of_jobs(
        starts.filter("started_at is not null"), ends.filter("output_at is not null"), "2 hours", 600
    )
    source.drain(ingest.file_writer(joined, f"{base}/out", f"{base}/checkpoint"))
    return _naive(spark.read.parquet(f"{base}/out"), "started_at", "output_at")


@query(
    "stream_upsert",
    """select user_id, arg_max(event_id, (ts, event_id)) as id, arg_max(event_type, (ts, event_id)) as state,
  max(ts) as created_at
from events group by user_id""",
)
def stream_upsert(spark, folder):
    """The newest event of each user, kept by upserts."""
    events = source.table_stream(spark, folder, "events").select(
        "user_id", F.col("event_id").alias("id"), F.col("event_type").alias("state"),
        F.col("ts").alias("created_at"), F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )
    base = shared_folder(spark, "upsert")
    source.drain(ingest.upsert_writer(events, ["user_id"], f"{base}/out", f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/out").select("user_id", "id", "state", "created_at")
