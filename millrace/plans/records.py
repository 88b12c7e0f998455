"""Record tables derived from the given tables, as DataFrames and as SQL.

``SQL`` holds the same projections as common table expressions for the SQL
twins; ``ctes`` joins those a query needs.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.ordered import BUCKET_SECONDS, row_index
from millrace.functions.scalars import iso_text, naive, seconds_between, time_bucket
from millrace.sources.tables import load

# How a derivation gets a table: as a batch (``load``) or as a stream.
Reader = Callable[[SparkSession, str, str], DataFrame]

AS_OF = datetime(2024, 1, 31)
PARTITIONS = 12


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _choose(c: Column, pairs: dict[str, str], otherwise: str) -> Column:
    out = None
    for value, result in pairs.items():
        out = F.when(c == value, result) if out is None else out.when(c == value, result)
    return out.otherwise(otherwise)


def _after(ts: str, unit: str, n: Column) -> Column:
    zero = F.lit(0)
    if unit == "minute":
        return F.col(ts) + F.make_dt_interval(zero, zero, n.cast("int"), F.lit(0.0))
    return F.col(ts) + F.make_dt_interval(zero, zero, zero, n.cast("decimal(18,6)"))


def ingestion(spark: SparkSession, folder: str) -> DataFrame:
    source = _choose(
        F.col("event_type"),
        {"click": "kafka", "view": "api", "purchase": "file", "signup": "stream"},
        "document_store",
    )
    return load(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        source.alias("source_type"),
        F.concat(F.lit("sensor-"), text("user_id")).alias("source_id"),
        F.lit("data.ingestion").alias("topic"),
        (F.col("user_id") % PARTITIONS).cast("int").alias("part_id"),
        F.col("props").alias("data"),
        F.length("props").cast("long").alias("size_bytes"),
        F.md5("props").alias("checksum"),
        F.col("ts").alias("created_at"),
    )


def envelope(spark: SparkSession, folder: str) -> DataFrame:
    """Ingestion records as log messages, offsets counted per partition."""
    messages = ingestion(spark, folder).select(
        "id",
        F.substring("source_id", 8, 20).alias("key"),
        F.col("data").alias("value"),
        "topic",
        F.col("part_id").alias("partition"),
        F.col("created_at").alias("timestamp"),
    )
    order = [F.col("timestamp"), F.col("id")]
    return row_index(messages, ["topic", "partition"], order, time_bucket("timestamp", BUCKET_SECONDS), "offset")


def jobs(spark: SparkSession, folder: str, read: Reader = load) -> DataFrame:
    k = F.col("k")
    state = F.col("o_orderstatus")
    status = (
        F.when((state == "F") & (k % 4 == 0), "failed")
        .when(state == "F", "completed")
        .when((state == "O") & (k % 5 == 0), "retrying")
        .when(state == "O", "pending")
        .otherwise("processing")
    )
    base = (
        read(spark, folder, "orders")
        .withColumnRenamed("o_orderkey", "k")
        .select(
            k,
            k.alias("id"),
            F.concat(F.lit("job-"), text("k")).alias("job_id"),
            F.col("o_orderpriority").alias("job_name"),
            (k * 2).alias("input_data_id"),
            status.alias("status"),
            (k % 5).cast("int").alias("retry_count"),
            F.lit(3).alias("max_retries"),
            F.col("o_orderdate").alias("created_at"),
        )
    )
    started = F.when(F.col("status") != "pending", _after("created_at", "minute", k % 60))
    finished = F.col("status").isin("completed", "failed")
    progress = (
        F.when(F.col("status") == "completed", 100.0)
        .when(F.col("status") == "pending", 0.0)
        .otherwise((k % 100).cast("double"))
    )
    return (
        base.withColumn("started_at", started)
        .withColumn("completed_at", F.when(finished, _after("started_at", "second", k % 700)))
        .withColumns(
            {
                "progress_percentage": progress,
                "duration_seconds": seconds_between("started_at", "completed_at"),
                "error_message": F.when(
                    F.col("status") == "failed", F.concat(F.lit("exit code "), text(k % 7))
                ),
                "updated_at": F.coalesce("completed_at", "started_at"),
            }
        )
    )


def job_events(spark: SparkSession, folder: str, read: Reader = load) -> DataFrame:
    """(job_id, ts, event, seq, error_message), one row per change of a job."""
    source = jobs(spark, folder, read)
    changes = F.array(
        F.struct(F.col("created_at").alias("ts"), F.lit("created").alias("event"), F.lit(0).alias("seq"),
                 F.lit(None).cast("string").alias("error_message")),
        F.struct(F.col("started_at").alias("ts"), F.lit("started").alias("event"), F.lit(1).alias("seq"),
                 F.lit(None).cast("string").alias("error_message")),
        F.struct(F.col("completed_at").alias("ts"), F.col("status").alias("event"), F.lit(2).alias("seq"),
                 F.col("error_message")),
    )
    return source.select("job_id", F.explode(changes).alias("_c")).select("job_id", "_c.*").filter("ts is not null")


def outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as outputs; the text itself stays in the file unless asked for."""
    documents = load(spark, folder, "documents")
    labels = load(spark, folder, "labels").withColumnRenamed("doc_id", "_doc_id")
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    score = (
        F.when(F.col("_doc_id").isNull(), None)
        .when(good & ~toxic, 1.0)
        .when(good, 0.7)
        .when(~toxic, 0.8)
        .otherwise(0.0)
    )
    too_short, too_long = F.col("n_chars") < 20, F.col("n_chars") > 20000
    errors = F.array_compact(F.array(F.when(too_short, "too_short"), F.when(too_long, "too_long")))
    start = naive("2024-01-01 00:00:00")
    zero = F.lit(0)
    return documents.join(labels, F.col("doc_id") == F.col("_doc_id"), "left").select(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("output_type"),
        F.col("source").alias("destination"),
        F.col("n_chars").alias("size_bytes"),
        F.concat(F.lit("job-"), text(F.col("doc_id") * 17)).alias("job_id"),
        score.alias("quality_score"),
        errors.alias("validation_errors"),
        (F.lit(1.0) + F.col("doc_id") % 5).alias("compression_ratio"),
        (start + F.make_dt_interval(zero, zero, F.col("doc_id").cast("int"), F.lit(0.0))).alias("created_at"),
    )


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    kind = _choose(
        F.col("event_type"), {"click": "counter", "view": "gauge", "purchase": "histogram"}, "summary"
    )
    return load(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("events_"), F.col("event_type"), F.lit("_value")).alias("name"),
        kind.alias("type"),
        "value",
        text("user_id").alias("label_user"),
        F.col("ts").alias("created_at"),
    )


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    value, n = F.col("value"), F.col("event_id")
    severity = F.when(value >= 100, "critical").when(value >= 50, "error").when(value >= 10, "warning")
    service = (
        F.when(F.col("user_id") % 5 == 0, "api")
        .when(F.col("user_id") % 5 == 1, "database")
        .when(F.col("user_id") % 5 == 2, "kafka")
        .when(F.col("user_id") % 5 == 3, "spark")
        .otherwise("airflow")
    )
    return (
        load(spark, folder, "events")
        .filter("event_type = 'error'")
        .select(
            n.alias("id"),
            F.lit("events_error_value").alias("metric_name"),
            F.lit(100.0).alias("threshold_value"),
            value.alias("current_value"),
            F.col("ts").alias("created_at"),
            severity.otherwise("info").alias("severity"),
            service.alias("service"),
            F.when(n % 3 != 0, _after("ts", "minute", n % 240)).alias("resolved_at"),
            F.when(n % 2 == 0, _after("ts", "second", n % 900)).alias("acknowledged_at"),
            F.when(n % 2 == 0, F.concat(F.lit("user-"), text("user_id"))).alias("acknowledged_by"),
            F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        )
    )


def request_log(spark: SparkSession, folder: str, read: Reader = load) -> DataFrame:
    kind = F.col("event_type")
    return read(spark, folder, "events").select(
        F.col("event_id").alias("request_id"),
        "ts",
        text("user_id").alias("client_id"),
        F.when(kind.isin("view", "error"), "GET").otherwise("POST").alias("method"),
        F.concat(F.lit("/api/v1/data/"), kind).alias("endpoint"),
        F.when(kind == "error", 500).when(kind == "signup", 201).otherwise(200).alias("status_code"),
        F.col("value").alias("process_time_ms"),
        F.length("props").cast("long").alias("content_length"),
    )


def health_checks(spark: SparkSession, folder: str) -> DataFrame:
    u = F.col("user_id") % 3
    return load(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.when(u == 0, "api").when(u == 1, "database").otherwise("kafka").alias("service"),
        F.when(F.col("event_type") == "error", "unhealthy")
        .when(F.col("value") > 60, "degraded")
        .otherwise("healthy")
        .alias("status"),
        F.col("value").alias("response_time_ms"),
        "ts",
    )


def system_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Host samples; some percentages are absent, NaN or out of range."""
    n = F.col("event_id")
    nan = F.lit(float("nan"))
    return load(spark, folder, "events").select(
        n.alias("id"),
        F.concat(F.lit("host-"), text(F.col("user_id") % 4)).alias("host"),
        F.least(F.col("value"), F.lit(100.0)).alias("cpu_usage_percent"),
        F.when(n % 50 == 0, nan).when(n % 47 == 0, None).otherwise(F.col("value")).alias("memory_usage_percent"),
        (n % 100).cast("double").alias("disk_usage_percent"),
        F.create_map(F.lit("rx"), n * 10, F.lit("tx"), F.col("user_id") * 5).alias("network_io_bytes"),
        F.create_map(F.lit("read"), n * 3, F.lit("write"), F.col("user_id")).alias("disk_io_bytes"),
        F.array(F.col("value"), F.col("value") / 2, F.col("value") / 4).alias("load_average"),
        F.col("ts").alias("created_at"),
    )


def _quoted(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))


def _bare(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), value)


def ingest_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Incoming ingestion documents as JSON text, some of them faulty."""
    n, u = F.col("event_id"), F.col("user_id")
    source = _choose(
        F.col("event_type"),
        {"click": "kafka", "view": "api", "purchase": "file", "signup": "stream"},
        "document_store",
    )
    parts = [
        _quoted("id", F.when(n % 41 == 0, "xyz").otherwise(F.substring(F.md5(text(n)), 1, 24))),
        _quoted("source_type", F.when(u % 23 == 0, "Kafka").otherwise(source)),
        F.when(u % 17 == 0, None)
        .when(u % 19 == 0, F.lit('"source_id":null'))
        .otherwise(_quoted("source_id", F.concat(F.lit("sensor-"), text(u)))),
        F.lit('"topic":"data.ingestion"'),
        F.when(n % 29 == 0, F.lit('"partition":"n/a"')).otherwise(_bare("partition", text(u % PARTITIONS))),
        _bare("offset", text(n)),
        _bare("data", F.when(n % 13 == 0, "{}").otherwise(F.col("props"))),
        _bare("size_bytes", F.when(n % 31 == 0, "-1").otherwise(text(F.length("props")))),
        F.when(n % 37 == 0, F.lit('"extra":1')),
        F.when(n % 11 == 0, F.lit('"metadata":null')),
        _quoted("created_at", F.when(n % 43 == 0, "not a time").otherwise(iso_text("ts"))),
    ]
    doc = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return load(spark, folder, "events").select(n.alias("doc_key"), doc.alias("doc"))


def job_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Incoming job documents as JSON text with absent and null fields."""
    k = F.col("o_orderkey")
    parts = [
        _quoted("job_id", F.concat(F.lit("job-"), text(k))),
        _quoted("job_name", F.col("o_orderpriority")),
        _quoted("input_data_id", text(k * 2)),
        F.when(k % 3 == 0, _quoted("status", F.lit("processing"))).when(k % 3 == 1, F.lit('"status":null')),
        F.when(k % 4 == 0, _bare("progress_percentage", text(k % 100))),
        F.when(k % 5 == 0, F.lit('"max_retries":null')).when(k % 5 == 1, F.lit('"max_retries":7')),
    ]
    doc = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return load(spark, folder, "orders").select(k.alias("doc_key"), doc.alias("doc"))


_SOURCE_TYPE_SQL = """case event_type when 'click' then 'kafka' when 'view' then 'api'
  when 'purchase' then 'file' when 'signup' then 'stream' else 'document_store' end"""

SQL = {
    "ingestion": f"""ingestion as (
select event_id as id, {_SOURCE_TYPE_SQL} as source_type,
  'sensor-' || cast(user_id as varchar) as source_id, 'data.ingestion' as topic,
  cast(user_id % 12 as int) as part_id, props as data, cast(length(props) as bigint) as size_bytes,
  md5(props) as checksum, ts as created_at
from events)""",
    "envelope": """envelope as (
select event_id as id, cast(user_id as varchar) as msg_key, props as value, 'data.ingestion' as topic,
  cast(user_id % 12 as int) as part_id,
  cast(row_number() over (partition by user_id % 12 order by ts, event_id) - 1 as bigint) as log_offset,
  ts
from events)""",
    "jobs": """jobs0 as (
select o_orderkey as k, o_orderkey as id, 'job-' || cast(o_orderkey as varchar) as job_id,
  o_orderpriority as job_name, 2 * o_orderkey as input_data_id,
  case when o_orderstatus = 'F' and o_orderkey % 4 = 0 then 'failed' when o_orderstatus = 'F' then 'completed'
    when o_orderstatus = 'O' and o_orderkey % 5 = 0 then 'retrying' when o_orderstatus = 'O' then 'pending'
    else 'processing' end as status,
  cast(o_orderkey % 5 as int) as retry_count, 3 as max_retries, o_orderdate as created_at
from orders),
jobs1 as (
select *, case when status <> 'pending' then created_at + to_minutes(k % 60) end as started_at from jobs0),
jobs2 as (
select *, case when status in ('completed', 'failed') then started_at + to_seconds(k % 700) end as completed_at
from jobs1),
jobs as (
select *,
  case status when 'completed' then 100e0 when 'pending' then 0e0 else cast(k % 100 as double) end
    as progress_percentage,
  (epoch_us(completed_at) - epoch_us(started_at)) / 1e6 as duration_seconds,
  case when status = 'failed' then 'exit code ' || cast(k % 7 as varchar) end as error_message,
  coalesce(completed_at, started_at) as updated_at
from jobs2)""",
    "job_events": """job_events as (
select job_id, created_at as ts, 'created' as event, 0 as seq, cast(null as varchar) as error_message from jobs
union all
select job_id, started_at, 'started', 1, null from jobs where started_at is not null
union all
select job_id, completed_at, status, 2, error_message from jobs where completed_at is not null)""",
    "outputs": """outputs as (
select d.doc_id as id, lang as output_type, source as destination, n_chars as size_bytes,
  'job-' || cast(17 * d.doc_id as varchar) as job_id,
  case when l.doc_id is null then null when quality = 1 and toxic = 0 then 1.0e0 when quality = 1 then 0.7e0
    when toxic = 0 then 0.8e0 else 0.0e0 end as quality_score,
  n_chars < 20 as too_short, n_chars > 20000 as too_long,
  1.0e0 + d.doc_id % 5 as compression_ratio,
  timestamp '2024-01-01 00:00:00' + to_minutes(d.doc_id) as created_at
from documents d left join labels l on d.doc_id = l.doc_id)""",
    "metrics": """metrics as (
select event_id as id, 'events_' || event_type || '_value' as name,
  case event_type when 'click' then 'counter' when 'view' then 'gauge' when 'purchase' then 'histogram'
    else 'summary' end as type,
  value, cast(user_id as varchar) as label_user, ts as created_at
from events)""",
    "alerts": """alerts as (
select event_id as id, 'events_error_value' as metric_name, 100e0 as threshold_value, value as current_value,
  ts as created_at,
  case when value >= 100 then 'critical' when value >= 50 then 'error' when value >= 10 then 'warning'
    else 'info' end as severity,
  case user_id % 5 when 0 then 'api' when 1 then 'database' when 2 then 'kafka' when 3 then 'spark'
    else 'airflow' end as service,
  case when event_id % 3 <> 0 then ts + to_minutes(event_id % 240) end as resolved_at,
  case when event_id % 2 = 0 then ts + to_seconds(event_id % 900) end as acknowledged_at,
  case when event_id % 2 = 0 then 'user-' || cast(user_id as varchar) end as acknowledged_by,
  cast(null as timestamp) as updated_at
from events where event_type = 'error')""",
    "request_log": """request_log as (
select event_id as request_id, ts, cast(user_id as varchar) as client_id,
  case when event_type in ('view', 'error') then 'GET' else 'POST' end as method,
  '/api/v1/data/' || event_type as endpoint,
  case event_type when 'error' then 500 when 'signup' then 201 else 200 end as status_code,
  value as process_time_ms, cast(length(props) as bigint) as content_length
from events)""",
    "health_checks": """health_checks as (
select event_id as id,
  case user_id % 3 when 0 then 'api' when 1 then 'database' else 'kafka' end as service,
  case when event_type = 'error' then 'unhealthy' when value > 60 then 'degraded' else 'healthy' end as status,
  value as response_time_ms, ts
from events)""",
    "system_samples": """system_samples as (
select event_id as id, 'host-' || cast(user_id % 4 as varchar) as host, user_id,
  least(value, 100e0) as cpu_usage_percent,
  case when event_id % 50 = 0 then 'nan'::double when event_id % 47 = 0 then null else value end
    as memory_usage_percent,
  cast(event_id % 100 as double) as disk_usage_percent, value, ts as created_at
from events)""",
    "ingest_documents": f"""ingest_documents as (
select event_id as doc_key, '{{' || concat_ws(',',
  '"id":"' || case when event_id % 41 = 0 then 'xyz' else substr(md5(cast(event_id as varchar)), 1, 24) end || '"',
  '"source_type":"' || case when user_id % 23 = 0 then 'Kafka' else {_SOURCE_TYPE_SQL} end || '"',
  case when user_id % 17 = 0 then null when user_id % 19 = 0 then '"source_id":null'
    else '"source_id":"sensor-' || cast(user_id as varchar) || '"' end,
  '"topic":"data.ingestion"',
  case when event_id % 29 = 0 then '"partition":"n/a"'
    else '"partition":' || cast(user_id % 12 as varchar) end,
  '"offset":' || cast(event_id as varchar),
  '"data":' || case when event_id % 13 = 0 then '{{}}' else props end,
  '"size_bytes":' || case when event_id % 31 = 0 then '-1' else cast(length(props) as varchar) end,
  case when event_id % 37 = 0 then '"extra":1' end,
  case when event_id % 11 = 0 then '"metadata":null' end,
  '"created_at":"' || case when event_id % 43 = 0 then 'not a time'
    else strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') end || '"'
  ) || '}}' as doc
from events)""",
    "job_documents": """job_documents as (
select o_orderkey as doc_key, '{' || concat_ws(',',
  '"job_id":"job-' || cast(o_orderkey as varchar) || '"',
  '"job_name":"' || o_orderpriority || '"',
  '"input_data_id":"' || cast(2 * o_orderkey as varchar) || '"',
  case o_orderkey % 3 when 0 then '"status":"processing"' when 1 then '"status":null' end,
  case when o_orderkey % 4 = 0 then '"progress_percentage":' || cast(o_orderkey % 100 as varchar) end,
  case o_orderkey % 5 when 0 then '"max_retries":null' when 1 then '"max_retries":7' end
  ) || '}' as doc
from orders)""",
}

_NEEDS = {"job_events": ("jobs",)}


def ctes(*names: str, recursive: bool = False) -> str:
    """``with`` clause of the named record tables and those they build on."""
    wanted: list[str] = []
    for name in names:
        for n in (*_NEEDS.get(name, ()), name):
            if n not in wanted:
                wanted.append(n)
    return ("with recursive " if recursive else "with ") + ",\n".join(SQL[n] for n in wanted)
