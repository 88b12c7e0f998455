"""Queries: scans, filters, pages, counts, updates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from millrace.functions.rules import document_rules, parse_documents, typed_documents, validate
from millrace.functions.scalars import naive
from millrace.operators import alerts as alert_ops
from millrace.operators import reads
from millrace.operators.mutations import delete_where, touched, update_counts, update_where
from millrace.plans import records
from millrace.plans.records import AS_OF, ctes
from millrace.plans.registry import query
from millrace.schemas import JOB
from millrace.sources.tables import load

ROW = "id, source_type, source_id, part_id, size_bytes, created_at"
COLUMNS = [c.strip() for c in ROW.split(",")]


@query(
    "scan_filter",
    ctes("ingestion")
    + f"""select {ROW} from ingestion where source_type = 'api' and size_bytes >= 9
order by created_at desc, id desc limit 500 offset 100""",
)
def scan_filter(spark, folder):
    pred = (F.col("source_type") == "api") & (F.col("size_bytes") >= 9)
    rows = records.ingestion(spark, folder).select(*COLUMNS)
    return reads.scan(rows, pred, sort=[("created_at", -1)], skip=100, limit=500)


@query("filter_eq", ctes("ingestion") + f"select {ROW} from ingestion where source_type = 'kafka'")
def filter_eq(spark, folder):
    pred = reads.equal_to(source_type="kafka", source_id="")
    return reads.where(records.ingestion(spark, folder), pred).select(*COLUMNS)


@query(
    "filter_two_keys",
    ctes("outputs")
    + "select id, job_id, output_type, destination, created_at from outputs "
    "where output_type = 'en' and destination = 'src1'",
)
def filter_two_keys(spark, folder):
    pred = reads.equal_to(output_type="en", destination="src1")
    rows = reads.where(records.outputs(spark, folder), pred)
    return rows.select("id", "job_id", "output_type", "destination", "created_at")


@query(
    "metrics_window",
    ctes("metrics")
    + "select * from metrics where created_at >= timestamp '2024-01-31 00:00:00' - interval 168 hour",
)
def metrics_window(spark, folder):
    return reads.trailing(records.metrics(spark, folder), AS_OF, hours=168)


ALERT_DOC_SQL = """alert_docs as (
select id, case when id % 3 = 0 then '{"id":' || cast(id as varchar) || '}'
  when id % 3 = 1 then '{"id":' || cast(id as varchar) || ',"resolved_at":null}'
  else '{"id":' || cast(id as varchar) || ',"resolved_at":"x"}' end as doc
from alerts)"""


@query(
    "field_absent",
    ctes("alerts")
    + f",\n{ALERT_DOC_SQL}\nselect id, doc from alert_docs where not list_contains(json_keys(doc), 'resolved_at')",
)
def field_absent(spark, folder):
    n = F.col("id")
    head = F.concat(F.lit('{"id":'), n.cast("string"))
    doc = (
        F.when(n % 3 == 0, F.concat(head, F.lit("}")))
        .when(n % 3 == 1, F.concat(head, F.lit(',"resolved_at":null}')))
        .otherwise(F.concat(head, F.lit(',"resolved_at":"x"}')))
    )
    return alert_ops.field_absent(records.alerts(spark, folder).select("id", doc.alias("doc")), "doc", "resolved_at")


@query(
    "alerts_active",
    ctes("alerts")
    + "select id, severity, service, current_value, created_at from alerts where resolved_at is null",
)
def alerts_active(spark, folder):
    active = alert_ops.active_alerts(records.alerts(spark, folder))
    return active.select("id", "severity", "service", "current_value", "created_at")


JOB_ROW = "id, job_id, job_name, input_data_id, status, retry_count, created_at, started_at, completed_at"
JOB_COLUMNS = [c.strip() for c in JOB_ROW.split(",")]


@query("job_lookup", ctes("jobs") + f"select {JOB_ROW} from jobs where job_id = 'job-1234'")
def job_lookup(spark, folder):
    return reads.lookup(records.jobs(spark, folder), "job_id", "job-1234").select(*JOB_COLUMNS)


@query(
    "defaults_filled",
    ctes("job_documents")
    + """select doc_key, doc ->> '$.job_id' as job_id,
  case when list_contains(json_keys(doc), 'status') then doc ->> '$.status' else 'pending' end as status,
  case when list_contains(json_keys(doc), 'progress_percentage')
    then cast(doc ->> '$.progress_percentage' as double) else 0e0 end as progress_percentage,
  cast(0 as int) as retry_count,
  case when list_contains(json_keys(doc), 'max_retries') then cast(doc ->> '$.max_retries' as int)
    else 3 end as max_retries,
  cast((case when list_contains(json_keys(doc), 'status') and doc ->> '$.status' is null then 1 else 0 end)
   + (case when list_contains(json_keys(doc), 'max_retries') and doc ->> '$.max_retries' is null
      then 1 else 0 end) as int) as explicit_nulls
from job_documents""",
)
def defaults_filled(spark, folder):
    docs = typed_documents(parse_documents(records.job_documents(spark, folder), "doc"), JOB)
    nulls = [r for r in document_rules(JOB) if r.name == "required"]
    return validate(docs, nulls).select(
        "doc_key", "job_id", "status", "progress_percentage", "retry_count", "max_retries",
        F.size("validation_errors").alias("explicit_nulls"),
    )


@query(
    "oversize_split",
    ctes("outputs")
    + """select id, size_bytes, true as accepted, cast(null as bigint) as max_size_bytes,
  cast(null as bigint) as received_size_bytes
from outputs where size_bytes is null or size_bytes <= 4000
union all
select id, size_bytes, false, 4000, size_bytes from outputs where size_bytes > 4000""",
)
def oversize_split(spark, folder):
    rows = records.outputs(spark, folder).select("id", "size_bytes")
    accepted, rejected = reads.split_oversize(rows, "size_bytes", 4000)
    return accepted.withColumn("accepted", F.lit(True)).unionByName(
        rejected.withColumn("accepted", F.lit(False)), allowMissingColumns=True
    )


@query("count_filtered", ctes("ingestion") + "select count(*) as n from ingestion where source_type = 'kafka'")
def count_filtered(spark, folder):
    return reads.count_where(records.ingestion(spark, folder), reads.equal_to(source_type="kafka"))


# --- sort and page --------------------------------------------------------


@query(
    "sort_multi",
    ctes("jobs") + "select status, retry_count, created_at, id from jobs "
    "order by status, created_at desc, id desc",
)
def sort_multi(spark, folder):
    rows = records.jobs(spark, folder).select("status", "retry_count", "created_at", "id")
    return reads.scan(rows, sort=[("status", 1), ("created_at", -1)])


def _page_sql(table: str, columns: str, where: str, number: int, size: int) -> str:
    return (
        ctes(table)
        + f"select {columns} from {table} where {where} "
        + f"order by created_at desc, id desc limit {size} offset {(number - 1) * size}"
    )


@query("page_ingestion", _page_sql("ingestion", ROW, "source_type = 'kafka'", 2, 20))
def page_ingestion(spark, folder):
    rows = records.ingestion(spark, folder).select(*COLUMNS)
    return reads.page(rows, 2, 20, reads.equal_to(source_type="kafka"))


@query("page_jobs", _page_sql("jobs", JOB_ROW, "status = 'failed'", 1, 50))
def page_jobs(spark, folder):
    return reads.page(records.jobs(spark, folder).select(*JOB_COLUMNS), 1, 50, reads.equal_to(status="failed"))


@query("page_outputs", _page_sql("outputs", "id, job_id, output_type, quality_score, created_at", "true", 3, 20))
def page_outputs(spark, folder):
    rows = records.outputs(spark, folder).select("id", "job_id", "output_type", "quality_score", "created_at")
    return reads.page(rows, 3, 20)


@query(
    "page_alerts",
    _page_sql("alerts", "id, severity, service, created_at, resolved_at",
              "severity = 'critical' and resolved_at is null", 1, 20),
)
def page_alerts(spark, folder):
    rows = records.alerts(spark, folder).select("id", "severity", "service", "created_at", "resolved_at")
    return reads.page(rows, 1, 20, reads.equal_to(severity="critical") & alert_ops.is_active())


@query("page_deep", _page_sql("jobs", JOB_ROW, "true", 120, 100))
def page_deep(spark, folder):
    """Beyond the top-k limit: found by counting."""
    return reads.page(records.jobs(spark, folder).select(*JOB_COLUMNS), 120, 100)


_NO_TIME = "case when id % 5 = 0 then null else created_at end"


@query(
    "page_deep_null_ts",
    ctes("jobs")
    + f"""select id, job_id, {_NO_TIME} as created_at from jobs
order by created_at desc nulls last, id desc limit 100 offset 12400""",
)
def page_deep_null_ts(spark, folder):
    """Rows without a time come last, at every depth."""
    rows = records.jobs(spark, folder).select("id", "job_id", F.expr(_NO_TIME).alias("created_at"))
    return reads.page(rows, 125, 100)


_ONE_TIME = "case when id % 10 = 0 then created_at else timestamp_ntz'2024-01-01 00:00:00' end"


@query(
    "page_deep_text_id",
    ctes("jobs")
    + f"""select job_id as id, status, {_ONE_TIME.replace('_ntz', ' ')} as created_at from jobs
order by created_at desc, job_id desc limit 100 offset 11900""",
)
def page_deep_text_id(spark, folder):
    """Most rows share one instant; their ids are text."""
    rows = records.jobs(spark, folder).select(
        F.col("job_id").alias("id"), "status", F.expr(_ONE_TIME).alias("created_at")
    )
    return reads.page(rows, 120, 100)


@query(
    "page_keyset",
    ctes("ingestion")
    + f"""select {ROW} from ingestion
where created_at < timestamp '2024-01-15 00:00:00'
  or (created_at = timestamp '2024-01-15 00:00:00' and id < 5000)
order by created_at desc, id desc limit 20""",
)
def page_keyset(spark, folder):
    rows = records.ingestion(spark, folder).select(*COLUMNS)
    return reads.page_after(rows, (datetime(2024, 1, 15), 5000), 20)


_HALF_TIMED = "case when id % 4 = 0 then null else created_at end"


@query(
    "page_keyset_null_ts",
    ctes("ingestion")
    + f"""select id, {_HALF_TIMED} as created_at from ingestion
order by created_at desc nulls last, id desc nulls last limit 300 offset (select count(*) - 150 from ingestion where id % 4 <> 0)""",
)
def page_keyset_null_ts(spark, folder):
    """Three pages over the border between rows with and without a time, each from the last row of the one before."""
    rows = records.ingestion(spark, folder).select("id", F.expr(_HALF_TIMED).alias("created_at"))
    timed = rows.filter("created_at is not null")
    newest = timed.orderBy("created_at", "id").limit(151).orderBy(F.desc("created_at"), F.desc("id")).limit(1)
    last, out = tuple(newest.select("created_at", "id").first()), None
    for _ in range(3):
        page = reads.page_after(rows, last, 100)
        end = page.orderBy(F.desc_nulls_last("created_at"), F.desc_nulls_last("id")).tail(1)[0]
        last, out = (end.created_at, end.id), page if out is None else out.unionByName(page)
    return out


@query(
    "page_info",
    ctes("ingestion")
    + """select cast(2 as bigint) as page, cast(20 as bigint) as size, count(*) as total,
  cast(ceil(count(*) / 20.0) as bigint) as pages
from ingestion where source_type = 'kafka'""",
)
def page_info(spark, folder):
    return reads.page_info(records.ingestion(spark, folder), 2, 20, reads.equal_to(source_type="kafka"))


@query(
    "metrics_recent",
    ctes("metrics")
    + """select * from metrics where created_at >= timestamp '2024-01-31 00:00:00' - interval 24 hour
order by created_at desc, id desc limit 1000""",
)
def metrics_recent(spark, folder):
    return reads.recent_metrics(records.metrics(spark, folder), AS_OF, hours=24)


# --- update and delete ----------------------------------------------------

_LATE = "status = 'processing' and created_at < timestamp '1997-01-01 00:00:00'"


def _late():
    return (F.col("status") == "processing") & (F.col("created_at") < naive(datetime(1997, 1, 1)))


def _sets():
    return {"status": F.lit("failed"), "retry_count": F.lit(2), **touched(AS_OF)}


@query(
    "update_where",
    ctes("jobs")
    + f"""select id, case when {_LATE} then 'failed' else status end as status,
  case when {_LATE} then 2 else retry_count end as retry_count,
  case when {_LATE} then timestamp '2024-01-31 00:00:00' else updated_at end as updated_at
from jobs""",
)
def update_where_query(spark, folder):
    rows = records.jobs(spark, folder).select("id", "status", "retry_count", "created_at", "updated_at")
    return update_where(rows, _late(), _sets()).drop("created_at")


@query(
    "update_counts",
    ctes("jobs")
    + """select count(*) filter (where status in ('failed', 'retrying')) as matched,
  count(*) filter (where status in ('failed', 'retrying') and (status <> 'failed' or retry_count <> 4)) as modified
from jobs""",
)
def update_counts_query(spark, folder):
    pred = F.col("status").isin("failed", "retrying")
    return update_counts(records.jobs(spark, folder), pred, {"status": F.lit("failed"), "retry_count": F.lit(4)})


@query(
    "delete_where",
    ctes("alerts")
    + """select id, severity, resolved_at from alerts
where not coalesce(resolved_at < timestamp '2024-01-20 00:00:00', false)""",
)
def delete_where_query(spark, folder):
    rows = records.alerts(spark, folder).select("id", "severity", "resolved_at")
    return delete_where(rows, F.col("resolved_at") < naive(datetime(2024, 1, 20)))


_COMMANDS_SQL = """commands as (
select event_id as command_id, event_id as alert_id,
  case when user_id % 2 = 0 then 'acknowledge' else 'resolve' end as action,
  'operator-' || cast(user_id % 9 as varchar) as "user", ts + interval 1 day as ts
from events where event_id % 4 = 1
union all
select 1000000000 + event_id, event_id - 1, 'acknowledge', 'operator-x', ts + interval 2 day
from events where event_id % 8 = 2),
changes as (
select alert_id,
  max(ts) filter (where action = 'acknowledge') as ack_at,
  arg_max("user", (ts, command_id)) filter (where action = 'acknowledge') as ack_by,
  max(ts) filter (where action = 'resolve') as fix_at,
  max(ts) as changed_at
from commands group by alert_id)"""


def _commands(spark, folder):
    """Commands on every fourth event; only error events are alerts."""
    events = load(spark, folder, "events")
    n, one_day = F.col("event_id"), F.expr("interval 1 day")
    first = events.filter(n % 4 == 1).select(
        n.alias("command_id"),
        n.alias("alert_id"),
        F.when(F.col("user_id") % 2 == 0, "acknowledge").otherwise("resolve").alias("action"),
        F.concat(F.lit("operator-"), (F.col("user_id") % 9).cast("string")).alias("user"),
        (F.col("ts") + one_day).alias("ts"),
    )
    second = events.filter(n % 8 == 2).select(
        (n + 1_000_000_000).alias("command_id"),
        (n - 1).alias("alert_id"),
        F.lit("acknowledge").alias("action"),
        F.lit("operator-x").alias("user"),
        (F.col("ts") + one_day + one_day).alias("ts"),
    )
    return first.unionByName(second)


@query(
    "alerts_ack",
    ctes("alerts")
    + f""",
{_COMMANDS_SQL}
select id, coalesce(ack_at, acknowledged_at) as acknowledged_at,
  case when ack_at is not null then ack_by else acknowledged_by end as acknowledged_by,
  coalesce(fix_at, resolved_at) as resolved_at, coalesce(changed_at, updated_at) as updated_at
from alerts left join changes on id = alert_id""",
)
def alerts_ack(spark, folder):
    done = alert_ops.apply_alert_commands(records.alerts(spark, folder), _commands(spark, folder))
    return done.select("id", "acknowledged_at", "acknowledged_by", "resolved_at", "updated_at")


@query(
    "alerts_resolve",
    ctes("alerts")
    + """select id, case when current_value >= 50 and resolved_at is null
    then timestamp '2024-01-31 00:00:00' else resolved_at end as resolved_at,
  case when current_value >= 50 and resolved_at is null
    then timestamp '2024-01-31 00:00:00' else updated_at end as updated_at
from alerts""",
)
def alerts_resolve(spark, folder):
    alerts = records.alerts(spark, folder)
    ids = alert_ops.active_alerts(alerts).filter("current_value >= 50").select(F.col("id").alias("alert_id"))
    return alert_ops.resolve(alerts, ids, AS_OF).select("id", "resolved_at", "updated_at")


@query(
    "commands_not_found",
    ctes("alerts")
    + f""",
{_COMMANDS_SQL}
select command_id, alert_id, action from commands where alert_id not in (select id from alerts)""",
)
def commands_not_found(spark, folder):
    missing = alert_ops.commands_not_found(_commands(spark, folder), records.alerts(spark, folder))
    return missing.select("command_id", "alert_id", "action")
