"""Queries: validation rules, quarantine, output quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.rules import (
    ERRORS,
    Rule,
    document_rules,
    field_rules,
    in_range,
    matches,
    parse_documents,
    rules_for,
    typed_documents,
    validate,
    validate_documents,
)
from millrace.functions import scalars as sc
from millrace.operators import outputs as output_ops
from millrace.plans import records
from millrace.plans.records import ctes
from millrace.plans.registry import query
from millrace.schemas import INGESTION, METRIC_NAME_PATTERN, SYSTEM_METRICS
from millrace.sources.tables import load


def _failures(spark, folder, rules: list[Rule]):
    """(doc_key, error) for every rule an incoming document fails."""
    docs = typed_documents(
        parse_documents(records.ingest_documents(spark, folder), "doc"), INGESTION
    )
    return validate(docs, rules).select("doc_key", F.explode(ERRORS).alias("error"))


def _named(*names: str) -> list[Rule]:
    return [r for r in document_rules(INGESTION) + rules_for(INGESTION) if r.name in names]


V_REQUIRED = """select doc_key, 'source_id:required' as error from ingest_documents
where (doc ->> '$.source_id') is null"""
V_ENUM = """select doc_key, 'source_type:enum' as error from ingest_documents
where (doc ->> '$.source_type') not in ('kafka', 'document_store', 'api', 'file', 'stream')"""
V_PAYLOAD = """select doc_key, 'data:payload' as error from ingest_documents
where len(json_keys(doc, '$.data')) = 0"""
V_UNKNOWN = """select doc_key, 'document:unknown_fields' as error from ingest_documents
where list_contains(json_keys(doc), 'extra')"""
V_ID = """select doc_key, 'id:format' as error from ingest_documents
where not regexp_matches(doc ->> '$.id', '^[0-9a-fA-F]{24}$')"""
V_TYPE = """select doc_key, 'partition:type' as error from ingest_documents
where (doc ->> '$.partition') is not null and try_cast(doc ->> '$.partition' as int) is null
union all
select doc_key, 'created_at:type' from ingest_documents
where (doc ->> '$.created_at') is not null and try_cast(doc ->> '$.created_at' as timestamp) is null"""
V_SIZE = """select doc_key, 'size_bytes:range' as error from ingest_documents
where try_cast(doc ->> '$.size_bytes' as bigint) < 0"""


def _docs(sql: str) -> str:
    return ctes("ingest_documents") + sql


@query("v_required", _docs(V_REQUIRED))
def v_required(spark, folder):
    return _failures(spark, folder, _named("required"))


@query("v_enum", _docs(V_ENUM))
def v_enum(spark, folder):
    return _failures(spark, folder, _named("enum"))


@query("v_payload", _docs(V_PAYLOAD))
def v_payload(spark, folder):
    return _failures(spark, folder, _named("payload"))


@query("v_unknown_fields", _docs(V_UNKNOWN))
def v_unknown_fields(spark, folder):
    return _failures(spark, folder, _named("unknown_fields"))


@query("v_id", _docs(V_ID))
def v_id(spark, folder):
    return _failures(spark, folder, _named("format"))


@query("v_type", _docs(V_TYPE))
def v_type(spark, folder):
    return _failures(spark, folder, _named("type"))


@query(
    "v_range",
    ctes("system_samples", "outputs", "jobs")
    + """select 'sample' as kind, id, 'memory_usage_percent:range' as error from system_samples
where memory_usage_percent is not null
  and (isnan(memory_usage_percent) or memory_usage_percent < 0 or memory_usage_percent > 100)
union all
select 'output', id, 'compression_ratio:range' from outputs
where compression_ratio is not null and (compression_ratio < 0 or compression_ratio > 3)
union all
select 'job', id, 'duration_seconds:range' from jobs where duration_seconds > 600""",
)
def v_range(spark, folder):
    """The declared bounds of system samples, and stricter ones for two other records."""
    samples = validate(
        records.system_samples(spark, folder),
        [
            r
            for f in SYSTEM_METRICS.fields
            for r in field_rules(f, F.col(f.name))
            if r.name == "range" and f.name.endswith("_percent")
        ],
    )
    outputs = validate(
        records.outputs(spark, folder).drop(ERRORS),
        [in_range("compression_ratio", F.col("compression_ratio"), 0, 3, True)],
    )
    jobs = validate(
        records.jobs(spark, folder),
        [in_range("duration_seconds", F.col("duration_seconds"), 0, 600, True)],
    )

    def listed(df, kind):
        return df.select(F.lit(kind).alias("kind"), "id", F.explode(ERRORS).alias("error"))

    return listed(samples, "sample").unionByName(listed(outputs, "output")).unionByName(listed(jobs, "job"))


@query(
    "v_metric_name",
    ctes("metrics")
    + r"""select id, metric, regexp_matches(metric, '^[\p{L}\p{N}_:]*[\p{L}\p{N}][\p{L}\p{N}_:]*$') as valid
from (select id, case id % 6 when 0 then '__' when 1 then replace(name, '_', '-') when 2 then 'é:1'
  when 3 then '' else name end as metric from metrics)""",
)
def v_metric_name(spark, folder):
    n, name = F.col("id") % 6, F.col("name")
    metric = (
        F.when(n == 0, "__")
        .when(n == 1, F.replace(name, F.lit("_"), F.lit("-")))
        .when(n == 2, "é:1")
        .when(n == 3, "")
        .otherwise(name)
    )
    rows = records.metrics(spark, folder).select("id", metric.alias("metric"))
    return rows.withColumn("valid", matches("name", F.col("metric"), METRIC_NAME_PATTERN).passes)


@query(
    "quarantine",
    _docs(
        f"""select d.doc_key, coalesce(e.errors, '') as errors, e.errors is null as accepted,
  d.doc ->> '$.source_type' as source_type, try_cast(d.doc ->> '$.offset' as bigint) as log_offset
from ingest_documents d left join (
  select doc_key, string_agg(error, ',' order by error) as errors from (
    {V_REQUIRED} union all {V_ENUM} union all {V_PAYLOAD} union all {V_UNKNOWN} union all {V_ID}
    union all {V_TYPE} union all {V_SIZE}) group by doc_key) e on d.doc_key = e.doc_key"""
    ),
)
def quarantine(spark, folder):
    checked = validate_documents(records.ingest_documents(spark, folder), "doc", INGESTION)
    return checked.select(
        "doc_key",
        F.array_join(F.array_sort(ERRORS), ",").alias("errors"),
        (F.size(ERRORS) == 0).alias("accepted"),
        "source_type",
        F.col("offset").alias("log_offset"),
    )


@query(
    "integrity",
    ctes("ingestion")
    + """select id, case when id % 100 = 7 then true else false end as bad_checksum,
  case when id % 90 = 5 then true else false end as bad_size
from ingestion""",
)
def integrity(spark, folder):
    """Checksums and sizes with some of them spoilt beforehand."""
    n = F.col("id")
    rows = records.ingestion(spark, folder).withColumns(
        {
            "checksum": F.when(n % 100 == 7, F.md5(F.lit("other"))).otherwise(F.col("checksum")),
            "size_bytes": F.when(n % 90 == 5, F.col("size_bytes") + 1).otherwise(F.col("size_bytes")),
        }
    )
    checked = validate(rows, output_ops.integrity_rules("data", "md5"))
    return checked.select(
        "id",
        F.array_contains(ERRORS, "checksum:mismatch").alias("bad_checksum"),
        F.array_contains(ERRORS, "size_bytes:mismatch").alias("bad_size"),
    )


_VALID = "not too_short and not too_long and (quality_score is null or quality_score >= 0.8)"


@query(
    "outputs_valid",
    ctes("outputs") + f"select id, job_id, output_type, quality_score from outputs where {_VALID}",
)
def outputs_valid(spark, folder):
    valid = output_ops.valid_outputs(records.outputs(spark, folder))
    return valid.select("id", "job_id", "output_type", "quality_score")


@query(
    "quality_summary",
    ctes("outputs")
    + f"""select output_type, count(*) as outputs, count(*) filter (where {_VALID}) as valid,
  round(count(*) filter (where {_VALID}) / count(*), 6) as valid_share,
  round(avg(quality_score), 6) as mean_score, round(avg(compression_ratio), 6) as mean_compression_ratio
from outputs group by output_type""",
)
def quality_summary(spark, folder):
    out = output_ops.quality_summary(records.outputs(spark, folder))
    return out.withColumns(
        {c: F.round(c, 6) for c in ("valid_share", "mean_score", "mean_compression_ratio")}
    )


_ERRORS_SQL = """errors as (
select output_type, 'too_short' as error from outputs where too_short
union all select output_type, 'too_long' from outputs where too_long)"""


@query(
    "error_counts",
    ctes("outputs")
    + f",\n{_ERRORS_SQL}\nselect output_type, error, count(*) as n from errors group by output_type, error",
)
def error_counts(spark, folder):
    return output_ops.error_counts(records.outputs(spark, folder))


@query(
    "top_errors",
    ctes("outputs")
    + f",\n{_ERRORS_SQL}\nselect error, count(*) as n from errors group by error order by n desc, error limit 10",
)
def top_errors(spark, folder):
    return output_ops.top_errors(records.outputs(spark, folder))


@query(
    "ingest_volume",
    ctes("ingestion")
    + """select source_type, topic, cast(grouping(source_type, topic) as bigint) as level,
  count(*) as records, cast(sum(size_bytes) as bigint) as bytes, min(created_at) as first_at,
  max(created_at) as last_at
from ingestion group by rollup (source_type, topic)""",
)
def ingest_volume(spark, folder):
    return output_ops.ingest_volume(records.ingestion(spark, folder))


@query(
    "ingest_volume_partition",
    ctes("ingestion")
    + """select source_type, topic, part_id, count(*) as records, cast(sum(size_bytes) as bigint) as bytes,
  min(created_at) as first_at, max(created_at) as last_at
from ingestion group by source_type, topic, part_id""",
)
def ingest_volume_partition(spark, folder):
    return output_ops.ingest_volume_by_partition(records.ingestion(spark, folder), "part_id")


@query(
    "scalars",
    """select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as iso, epoch_us(ts) // 1000000 as epoch_seconds,
  (epoch_us(ts) - epoch_us(timestamp '2024-01-01 00:00:00')) / 1e6 as since_start,
  round(value * 1000, 2) as ms,
  coalesce(nullif(case when user_id % 3 = 0 then '' else event_type end, ''), 'none') as kind,
  cast(ceil(event_id / 20.0) as bigint) as pages, greatest(0, 50 - user_id) as remaining,
  'client-' || cast(user_id as varchar) as consumer, octet_length(encode(props)) as n_bytes,
  list_contains(json_keys(props), 'k') as has_k, len(json_keys(props)) > 0 as filled
from events""",
)
def scalars(spark, folder):
    """The scalar functions, over every event."""
    events = load(spark, folder, "events")
    kind = F.when(F.col("user_id") % 3 == 0, "").otherwise(F.col("event_type"))
    return events.select(
        "event_id",
        sc.iso_text("ts").alias("iso"),
        sc.epoch_seconds("ts").alias("epoch_seconds"),
        sc.seconds_between(sc.naive("2024-01-01 00:00:00"), "ts").alias("since_start"),
        sc.round_ms("value").alias("ms"),
        sc.or_default(kind, "none").alias("kind"),
        sc.page_count(F.col("event_id"), 20).alias("pages"),
        F.greatest(F.lit(0), 50 - F.col("user_id")).alias("remaining"),
        sc.client_consumer_id(F.lit("client"), F.col("user_id").cast("string")).alias("consumer"),
        F.octet_length("props").cast("long").alias("n_bytes"),
        sc.has_key("props", "k").alias("has_k"),
        sc.is_filled_object("props").alias("filled"),
    )
