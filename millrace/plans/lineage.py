"""Queries: joins between inputs, jobs and outputs; job life cycle."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import jobs as job_ops
from millrace.operators import lineage
from millrace.plans import records
from millrace.plans.records import AS_OF, ctes
from millrace.plans.registry import query


@query(
    "lineage_input",
    ctes("jobs", "ingestion")
    + """select j.job_id, j.status, i.id as input_id, i.source_type, i.source_id
from jobs j join ingestion i on j.input_data_id = i.id""",
)
def lineage_input(spark, folder):
    joined = lineage.jobs_with_input(records.jobs(spark, folder), records.ingestion(spark, folder))
    return joined.select("job_id", "status", "input_id", "source_type", "source_id")


@query(
    "lineage_output",
    ctes("jobs", "outputs")
    + """select o.id, o.job_id, o.output_type, j.job_name, j.status, j.completed_at
from outputs o left join jobs j on o.job_id = j.job_id""",
)
def lineage_output(spark, folder):
    joined = lineage.outputs_with_job(records.outputs(spark, folder), records.jobs(spark, folder), "left")
    return joined.select("id", "job_id", "output_type", "job_name", "status", "completed_at")


@query(
    "unprocessed",
    ctes("jobs", "ingestion")
    + """select id, source_type, created_at from ingestion i
where not exists (select 1 from jobs j where j.input_data_id = i.id)""",
)
def unprocessed(spark, folder):
    rows = lineage.unprocessed(records.ingestion(spark, folder), records.jobs(spark, folder))
    return rows.select("id", "source_type", "created_at")


@query(
    "orphan_jobs",
    ctes("jobs", "ingestion")
    + """select job_id, input_data_id, status from jobs j
where not exists (select 1 from ingestion i where j.input_data_id = i.id)""",
)
def orphan_jobs(spark, folder):
    rows = lineage.orphan_jobs(records.jobs(spark, folder), records.ingestion(spark, folder))
    return rows.select("job_id", "input_data_id", "status")


@query(
    "orphan_outputs",
    ctes("jobs", "outputs")
    + """select id, job_id, output_type from outputs o
where not exists (select 1 from jobs j where j.job_id = o.job_id)""",
)
def orphan_outputs(spark, folder):
    rows = lineage.orphan_outputs(records.outputs(spark, folder), records.jobs(spark, folder))
    return rows.select("id", "job_id", "output_type")


@query(
    "jobs_with_output",
    ctes("jobs", "outputs")
    + """select job_id, status from jobs j where exists (select 1 from outputs o where o.job_id = j.job_id)""",
)
def jobs_with_output(spark, folder):
    rows = lineage.jobs_with_output(records.jobs(spark, folder), records.outputs(spark, folder))
    return rows.select("job_id", "status")


@query(
    "lineage_full",
    ctes("jobs", "ingestion", "outputs")
    + """select i.id as input_id, i.source_type, i.created_at as ingested_at, j.job_id, j.status,
  o.id as output_id,
  round((epoch_us(j.created_at) - epoch_us(i.created_at)) / 1e6, 3) as queue_seconds,
  round((epoch_us(j.completed_at) - epoch_us(j.started_at)) / 1e6, 3) as run_seconds,
  round((epoch_us(o.created_at) - epoch_us(j.completed_at)) / 1e6, 3) as publish_seconds
from ingestion i left join jobs j on j.input_data_id = i.id left join outputs o on o.job_id = j.job_id""",
)
def lineage_full(spark, folder):
    rows = lineage.lineage(
        records.ingestion(spark, folder), records.jobs(spark, folder), records.outputs(spark, folder)
    )
    return rows.withColumns({c: F.round(c, 3) for c in ("queue_seconds", "run_seconds", "publish_seconds")})


@query(
    "job_fold",
    ctes("jobs")
    + """select job_id, case when status = 'retrying' then 'processing' else status end as status,
  case when status = 'completed' then 100e0 else 0e0 end as progress_percentage, error_message,
  created_at, started_at, completed_at, round(duration_seconds, 3) as duration_seconds, updated_at
from jobs""",
)
def job_fold(spark, folder):
    folded = job_ops.fold_jobs(records.job_events(spark, folder))
    return folded.withColumn("duration_seconds", F.round("duration_seconds", 3))


@query(
    "current_state",
    ctes("jobs", "job_events")
    + """select job_name, arg_max(job_id, (coalesce(updated_at, created_at), id)) as job_id,
  arg_max(status, (coalesce(updated_at, created_at), id)) as status,
  max(coalesce(updated_at, created_at)) as changed_at
from (select *, cast(k % 1000 as varchar) || job_name as versioned from jobs)
group by versioned, job_name""",
)
def current_state(spark, folder):
    """Jobs as versions of a thousand entities per priority, folded to the newest."""
    versions = records.jobs(spark, folder).select(
        F.concat((F.col("k") % 1000).cast("string"), F.col("job_name")).alias("entity"),
        "id", "job_id", "job_name", "status", "created_at", "updated_at",
    )
    newest = job_ops.current_state(versions, ["entity"])
    return newest.select(
        "job_name", "job_id", "status", F.coalesce("updated_at", "created_at").alias("changed_at")
    )


@query(
    "jobs_retryable",
    ctes("jobs")
    + "select job_id, retry_count, max_retries from jobs where status = 'failed' and retry_count < max_retries",
)
def jobs_retryable(spark, folder):
    return job_ops.retryable(records.jobs(spark, folder)).select("job_id", "retry_count", "max_retries")


@query(
    "retry_schedule",
    ctes("jobs")
    + """select job_id, cast(retry_count + 1 as bigint) as attempt,
  completed_at + interval 5 second as next_attempt_at
from jobs where status = 'failed' and retry_count < max_retries""",
)
def retry_schedule(spark, folder):
    return job_ops.retry_schedule(records.jobs(spark, folder)).select("job_id", "attempt", "next_attempt_at")


@query(
    "jobs_timed_out",
    ctes("jobs")
    + """select job_id, status, elapsed_seconds from (
  select job_id, status,
    round((epoch_us(coalesce(completed_at, timestamp '2024-01-31 00:00:00')) - epoch_us(started_at)) / 1e6, 3)
      as elapsed_seconds
  from jobs) where elapsed_seconds > 300""",
)
def jobs_timed_out(spark, folder):
    late = job_ops.timed_out(records.jobs(spark, folder), AS_OF)
    return late.select("job_id", "status", F.round("elapsed_seconds", 3).alias("elapsed_seconds"))


@query(
    "job_summary",
    ctes("jobs")
    + """select status, count(*) as jobs, round(avg(progress_percentage), 6) as mean_progress,
  round(avg(duration_seconds), 6) as mean_duration_seconds, cast(sum(retry_count) as bigint) as retries_used
from jobs group by status""",
)
def job_summary(spark, folder):
    out = job_ops.job_summary(records.jobs(spark, folder))
    return out.withColumns({c: F.round(c, 6) for c in ("mean_progress", "mean_duration_seconds")})
