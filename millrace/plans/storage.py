"""Queries: table writes, snapshots, retention, files, source union."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalars import naive
from millrace.plans import records
from millrace.plans.records import AS_OF, ctes
from millrace.plans.registry import query
from millrace.sources import files, tables, unify
from millrace.sources.log import JSON_BODY
from millrace.sources.workspace import shared_folder

_ID_SQL = """substr(sha256(concat_ws(chr(31), cast(id as varchar), source_type)), 1, 24) as record_id"""
_ROW = ["record_id", "id", "source_type", "size_bytes", "created_at"]


def _with_ids(spark, folder):
    rows = records.ingestion(spark, folder)
    return tables.with_record_id(rows, ["id", "source_type"], "record_id").select(*_ROW)


@query(
    "append_many",
    ctes("ingestion") + f"select {_ID_SQL}, id, source_type, size_bytes, created_at from ingestion",
)
def append_many(spark, folder):
    path = shared_folder(spark, "append")
    tables.append(_with_ids(spark, folder), path)
    return spark.read.parquet(path)


@query(
    "append_one",
    ctes("ingestion")
    + f""",
one as (
select max(id) + 1 as id, 'api' as source_type, cast(sum(size_bytes) as bigint) as size_bytes,
  max(created_at) as created_at from ingestion)
select {_ID_SQL}, id, source_type, size_bytes, created_at from ingestion
union all
select {_ID_SQL}, id, source_type, size_bytes, created_at from one""",
)
def append_one(spark, folder):
    """A table of all records, then one more document that sums them up."""
    path = shared_folder(spark, "append")
    tables.append(_with_ids(spark, folder), path)
    one = spark.read.parquet(path).agg(
        (F.max("id") + 1).alias("id"),
        F.lit("api").alias("source_type"),
        F.sum("size_bytes").alias("size_bytes"),
        F.max("created_at").alias("created_at"),
    )
    tables.append(tables.with_record_id(one, ["id", "source_type"], "record_id").select(*_ROW), path)
    return spark.read.parquet(path)


@query(
    "file_ingest",
    ctes("ingestion")
    + """select id, 'file' as source_type, data, created_at, false as corrupt, true as has_source
from ingestion where source_type = 'file' and id % 100 <> 3
union all
select null, 'file', null, null, true, true from ingestion where source_type = 'file' and id % 100 = 3""",
)
def file_ingest(spark, folder):
    """File records written as JSON lines, some cut off, and read back."""
    rows = records.ingestion(spark, folder).filter("source_type = 'file'").select("id", "data", "created_at")
    line = F.to_json(F.struct("id", "data", "created_at"), JSON_BODY)
    cut = F.when(F.col("id") % 100 == 3, F.substring(line, 1, 7)).otherwise(line)
    path = shared_folder(spark, "files")
    rows.select(cut.alias("value")).write.text(path)
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("data", T.StringType()),
            T.StructField("created_at", T.TimestampNTZType()),
        ]
    )
    read = files.read_files(spark, path, "json", schema)
    return read.select(
        "id", F.lit("file").alias("source_type"), "data", "created_at",
        F.col(files.CORRUPT).isNotNull().alias("corrupt"),
        F.col("source_id").isNotNull().alias("has_source"),
    )


@query(
    "union_sources",
    ctes("envelope", "request_log", "jobs", "outputs", "metrics")
    + """select 'kafka' as source_type, msg_key as source_id, topic, part_id, log_offset, value as data,
  cast(null as bigint) as size_bytes, ts as created_at from envelope
union all
select 'api', client_id, null, null, null, endpoint, content_length, ts from request_log
union all
select 'file', destination, null, null, null, null, size_bytes, created_at from outputs
union all
select 'document_store', job_id, null, null, null, status, null, created_at from jobs
union all
select 'stream', name, null, null, null, cast(null as varchar), null, created_at from metrics""",
)
def union_sources(spark, folder):
    sources = {
        "kafka": records.envelope(spark, folder).select(
            F.col("key").alias("source_id"), "topic", F.col("partition").alias("part_id"),
            F.col("offset").alias("log_offset"), F.col("value").alias("data"),
            F.col("timestamp").alias("created_at"),
        ),
        "api": records.request_log(spark, folder).select(
            F.col("client_id").alias("source_id"), F.col("endpoint").alias("data"),
            F.col("content_length").alias("size_bytes"), F.col("ts").alias("created_at"),
        ),
        "file": records.outputs(spark, folder).select(
            F.col("destination").alias("source_id"), "size_bytes", "created_at"
        ),
        "document_store": records.jobs(spark, folder).select(
            F.col("job_id").alias("source_id"), F.col("status").alias("data"), "created_at"
        ),
        "stream": records.metrics(spark, folder).select(F.col("name").alias("source_id"), "created_at"),
    }
    return unify.union_sources(sources)


@query(
    "snapshot_roundtrip",
    ctes("jobs", "alerts")
    + """select 'jobs' as collection, id, status as state, created_at from jobs
union all
select 'alerts', id, severity, created_at from alerts""",
)
def snapshot_roundtrip(spark, folder):
    """Dump two collections, then restore each over an older table."""
    jobs = records.jobs(spark, folder).select("id", F.col("status").alias("state"), "created_at")
    alerts = records.alerts(spark, folder).select("id", F.col("severity").alias("state"), "created_at")
    root = shared_folder(spark, "snapshot")
    dumped = tables.snapshot({"jobs": jobs, "alerts": alerts}, root, AS_OF)
    target = shared_folder(spark, "restored")
    tables.append(jobs.limit(10), f"{target}/jobs")
    restored = [
        tables.restore(spark, dumped, name, f"{target}/{name}").withColumn("collection", F.lit(name))
        for name in ("jobs", "alerts")
    ]
    return restored[0].unionByName(restored[1])


_COPY_SQL = """copy as (
select id, case when id % 500 = 3 then 'lost' else status end as status, retry_count from jobs where id % 400 <> 7
union all
select id, status, retry_count from jobs where id % 600 = 5)"""


def _damaged_copy(spark, folder):
    jobs = records.jobs(spark, folder).select("id", "status", "retry_count")
    copy = jobs.filter("id % 400 <> 7").withColumn(
        "status", F.when(F.col("id") % 500 == 3, "lost").otherwise(F.col("status"))
    )
    return jobs, copy.unionByName(jobs.filter("id % 600 = 5"))


@query(
    "reconcile",
    ctes("jobs")
    + f""",
{_COPY_SQL},
a as (select id, status, retry_count, count(*) as n from jobs group by all),
b as (select id, status, retry_count, count(*) as n from copy group by all),
d as (select coalesce(a.id, b.id) as id, coalesce(a.status, b.status) as status,
  coalesce(a.retry_count, b.retry_count) as retry_count, coalesce(a.n, 0) - coalesce(b.n, 0) as diff
from a full join b on a.id = b.id and a.status = b.status and a.retry_count = b.retry_count)
select id, status, retry_count, case when diff > 0 then 'source_only' else 'copy_only' end as side,
  cast(abs(diff) as bigint) as n_rows
from d where diff <> 0""",
)
def reconcile(spark, folder):
    return tables.reconcile(*_damaged_copy(spark, folder))


@query(
    "reconcile_counts",
    ctes("jobs")
    + f""",
{_COPY_SQL}
select (select count(*) from jobs) as source_rows, (select count(*) from copy) as copy_rows,
  (select count(*) from (select id, status, retry_count from jobs except all
     select id, status, retry_count from copy)) as source_only,
  (select count(*) from (select id, status, retry_count from copy except all
     select id, status, retry_count from jobs)) as copy_only""",
)
def reconcile_counts(spark, folder):
    return tables.reconcile_counts(*_damaged_copy(spark, folder))


@query(
    "incremental_extract",
    ctes("jobs")
    + """select id, status, created_at, updated_at from jobs
where coalesce(updated_at, created_at) > timestamp '1997-06-01 00:00:00'
  and coalesce(updated_at, created_at) <= timestamp '1997-09-01 00:00:00'""",
)
def incremental_extract(spark, folder):
    rows = records.jobs(spark, folder).select("id", "status", "created_at", "updated_at")
    return tables.changed_since(rows, datetime(1997, 6, 1), datetime(1997, 9, 1))


@query(
    "extract_chain",
    ctes("jobs")
    + """select id, status, updated_at, 'full' as kind from jobs where created_at <= timestamp '1997-06-01 00:00:00'
union all
select id, status, updated_at, 'increment' from jobs
where coalesce(updated_at, created_at) > timestamp '1997-06-01 00:00:00'
  and coalesce(updated_at, created_at) <= timestamp '1997-09-01 00:00:00'""",
)
def extract_chain(spark, folder):
    """A full extract, then an increment that starts at the mark it left."""
    rows = records.jobs(spark, folder).select("id", "status", "created_at", "updated_at")
    root = shared_folder(spark, "extract")
    full = tables.extract(spark, {"jobs": rows}, root, datetime(1997, 6, 1))
    increment = tables.extract(spark, {"jobs": rows}, root, datetime(1997, 9, 1))
    parts = [
        spark.read.parquet(f"{path}/jobs").withColumn("kind", F.lit(kind))
        for path, kind in ((full, "full"), (increment, "increment"))
    ]
    return parts[0].unionByName(parts[1]).drop("created_at")


@query(
    "layout_zorder_scan",
    ctes("jobs")
    + """select id, status, created_at from jobs
where status = 'completed' and created_at >= timestamp '1996-01-01 00:00:00' and created_at < timestamp '1996-04-01 00:00:00'""",
)
def layout_zorder_scan(spark, folder):
    """A table clustered by status and time, read by both."""
    path = shared_folder(spark, "zorder")
    rows = records.jobs(spark, folder).select("id", "job_id", "status", F.col("created_at").cast("timestamp").alias("created_at"))
    tables.write_zordered(rows, path, ["status", "created_at"], {"job_id": 100_000})
    begin, end = (F.lit(day).cast("timestamp") for day in ("1996-01-01", "1996-04-01"))
    found = spark.read.parquet(path).filter(
        (F.col("status") == "completed") & (F.col("created_at") >= begin) & (F.col("created_at") < end)
    )
    return found.select("id", "status", F.col("created_at").cast("timestamp_ntz").alias("created_at"))


@query(
    "extract_restored",
    ctes("jobs")
    + """select id, case when id % 5 = 1 then 'changed' else status end as status, created_at from jobs
where created_at <= timestamp '1997-06-01 00:00:00' and id % 7 <> 3""",
)
def extract_restored(spark, folder):
    """Rows deleted and changed between two extracts are so in the table that the chain gives back."""
    rows = records.jobs(spark, folder).select("id", "status", "created_at", F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    rows = rows.filter("created_at <= timestamp_ntz'1997-06-01 00:00:00'")
    changed = F.col("id") % 5 == 1
    later = rows.filter("id % 7 <> 3").withColumns(
        {
            "status": F.when(changed, "changed").otherwise(F.col("status")),
            "updated_at": F.when(changed, F.lit("1997-07-01").cast("timestamp_ntz")),
        }
    )
    root = shared_folder(spark, "extract")
    tables.extract(spark, {"jobs": rows}, root, datetime(1997, 6, 15), {"jobs": "id"})
    tables.extract(spark, {"jobs": later}, root, datetime(1997, 9, 1), {"jobs": "id"})
    return tables.restore_chain(spark, root, "jobs", "id").drop("updated_at")


@query(
    "retention",
    ctes("ingestion")
    + """select id, topic, part_id, created_at from ingestion
where created_at >= timestamp '2024-01-31 00:00:00' - interval 7 day or created_at is null""",
)
def retention(spark, folder):
    rows = records.ingestion(spark, folder).select("id", "topic", "part_id", "created_at")
    return tables.retained(rows, "created_at", AS_OF)


@query(
    "retention_purge",
    ctes("ingestion")
    + """select id, part_id, cast(created_at as date) as dt from ingestion
where cast(created_at as date) >= date '2024-01-24'""",
)
def retention_purge(spark, folder):
    """On disk: whole date partitions older than a week are dropped."""
    path = shared_folder(spark, "purge")
    rows = tables.with_date(records.ingestion(spark, folder)).select("id", "part_id", "dt")
    tables.write_layout(rows, path, ["dt"], ["part_id", "id"])
    tables.purge_partitions(spark, path, "dt", AS_OF)
    return spark.read.parquet(path)


@query(
    "batch_assign",
    ctes("ingestion")
    + """select id, part_id,
  cast(floor((row_number() over (partition by part_id order by created_at, id) - 1) / 100) as bigint) as batch_id
from ingestion""",
)
def batch_assign(spark, folder):
    rows = records.ingestion(spark, folder).select("id", "part_id", "created_at")
    order = [F.col("created_at"), F.col("id")]
    out = tables.assign_batches(rows, ["part_id"], order, 100)
    return out.select("id", "part_id", "batch_id")


@query(
    "layout_pruned_scan",
    ctes("ingestion")
    + """select id, source_type, created_at, cast(created_at as date) as dt from ingestion
where cast(created_at as date) = date '2024-01-10' and source_type = 'api'""",
)
def layout_pruned_scan(spark, folder):
    """Written by date and sorted by source; one partition is read back."""
    path = shared_folder(spark, "layout")
    rows = tables.with_date(records.ingestion(spark, folder)).select("id", "source_type", "created_at", "dt")
    tables.write_layout(rows, path, ["dt"], ["source_type", "created_at"])
    return spark.read.parquet(path).filter("dt = date'2024-01-10' and source_type = 'api'")


@query(
    "compact",
    ctes("ingestion") + "select id, source_type, created_at, cast(created_at as date) as dt from ingestion",
)
def compact(spark, folder):
    """Many small appends become few sorted files with the same rows."""
    path, target = shared_folder(spark, "small"), shared_folder(spark, "compact")
    rows = tables.with_date(records.ingestion(spark, folder)).select("id", "source_type", "created_at", "dt")
    for kind in ("kafka", "api", "file", "stream", "document_store"):
        tables.append(rows.filter(F.col("source_type") == kind), path, ["dt"])
    return tables.compact(spark, path, target, "dt", ["source_type", "created_at"])


def _dated_alerts(spark, folder) -> str:
    path = shared_folder(spark, "alerts")
    rows = tables.with_date(records.alerts(spark, folder))
    columns = rows.select("id", "severity", "created_at", "resolved_at", "updated_at", "dt")
    tables.write_layout(columns, path, ["dt"], ["severity", "created_at"])
    return path


@query(
    "table_update",
    ctes("alerts")
    + """select id, severity, created_at,
  case when hit then timestamp '2024-01-31 00:00:00' else resolved_at end as resolved_at,
  case when hit then timestamp '2024-01-31 00:00:00' else updated_at end as updated_at,
  cast(created_at as date) as dt
from (select *, severity = 'critical' and resolved_at is null
  and created_at >= timestamp '2024-01-10 00:00:00' and created_at < timestamp '2024-01-15 00:00:00' as hit
  from alerts)""",
)
def table_update(spark, folder):
    """On disk: five of thirty date partitions are rewritten."""
    path = _dated_alerts(spark, folder)
    hit = (
        (F.col("severity") == "critical") & F.col("resolved_at").isNull()
        & (F.col("created_at") >= naive(datetime(2024, 1, 10)))
        & (F.col("created_at") < naive(datetime(2024, 1, 15)))
    )
    tables.update_table(spark, path, "dt", hit, {"resolved_at": naive(AS_OF), "updated_at": naive(AS_OF)})
    return spark.read.parquet(path)


@query(
    "table_delete",
    ctes("alerts")
    + """select id, severity, created_at, resolved_at, updated_at, cast(created_at as date) as dt
from alerts where not (created_at < timestamp '2024-01-05 12:00:00' or severity = 'info')""",
)
def table_delete(spark, folder):
    """On disk: partitions that lose every row disappear."""
    path = _dated_alerts(spark, folder)
    old = (F.col("created_at") < naive(datetime(2024, 1, 5, 12))) | (F.col("severity") == "info")
    tables.delete_from_table(spark, path, "dt", old)
    return spark.read.parquet(path)


_ODD = """case severity when 'warning' then 'x:y' when 'error' then 'a/b' when 'critical' then 'c d+e%' end"""


def _odd_alerts(spark, folder) -> str:
    """Partitioned by a column with nulls and names that are escaped on disk."""
    path = shared_folder(spark, "odd")
    rows = records.alerts(spark, folder).select("id", "service", F.expr(_ODD).alias("part"), "resolved_at")
    rows.write.partitionBy("part").parquet(path)
    return path


@query(
    "table_update_null",
    ctes("alerts")
    + f"""select id, case when resolved_at is null then 'open' else service end as service, {_ODD} as part,
  coalesce(resolved_at, timestamp '2024-01-31 00:00:00') as resolved_at from alerts""",
)
def table_update_null(spark, folder):
    """On disk: matching rows of null and escaped partitions change too."""
    path = _odd_alerts(spark, folder)
    sets = {"resolved_at": naive(AS_OF), "service": F.lit("open")}
    tables.update_table(spark, path, "part", F.col("resolved_at").isNull(), sets)
    return spark.read.parquet(path)


@query(
    "table_delete_odd",
    ctes("alerts")
    + f"""select id, service, {_ODD} as part, resolved_at from alerts
where not (coalesce(severity in ('warning', 'error'), false) or resolved_at is null)""",
)
def table_delete_odd(spark, folder):
    """On disk: two escaped partitions go as a whole, the others in part."""
    path = _odd_alerts(spark, folder)
    gone = F.col("part").isin("x:y", "a/b") | F.col("resolved_at").isNull()
    tables.delete_from_table(spark, path, "part", gone)
    return spark.read.parquet(path)


@query(
    "text_ids",
    ctes("ingestion") + "select cast(id as varchar(20)) as id, source_id, cast(part_id as varchar(20)) as part_id from ingestion",
)
def text_ids(spark, folder):
    rows = records.ingestion(spark, folder).select("id", "source_id", "part_id")
    return tables.text_ids(rows, "id", "part_id")
