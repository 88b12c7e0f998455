"""Known counts of the derived records, per scale (see FIXTURES.md)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.operators import alerts, health, jobs, lineage, outputs, reads
from millrace.operators.requests import cumulative_histogram
from millrace.plans import records
from millrace.plans.records import AS_OF
from millrace.sources import log

SCALES = ("0.001", "0.01", "0.1")
GOLDEN = {
    "kafka": (210, 2006, 19863),
    "pages": (11, 101, 994),
    "first": ([996, 989, 980, 973, 967], [9997, 9975, 9967, 9964, 9960], [99997, 99984, 99980, 99978, 99975]),
    "status": (
        {"pending": 418, "processing": 493, "completed": 378, "failed": 115, "retrying": 96},
        {"pending": 3966, "processing": 5088, "completed": 3709, "failed": 1224, "retrying": 1013},
        {"pending": 40163, "processing": 50189, "completed": 37335, "failed": 12375, "retrying": 9938},
    ),
    "retryable": (74, 719, 7376),
    "over_300": (272, 2738, 28270),
    "unprocessed": (500, 5000, 50000),
    "orphan_jobs": (1000, 10000, 100000),
    "orphan_outputs": (111, 117, 1176),
    "valid": (186, 938, 9475),
    "errors": ({"too_short": 3}, {"too_short": 7, "too_long": 5}, {"too_short": 34, "too_long": 47}),
    "active": (
        {"info": 10, "warning": 25, "error": 16, "critical": 10},
        {"info": 128, "warning": 294, "error": 164, "critical": 105},
        {"info": 1174, "warning": 2975, "error": 1518, "critical": 909},
    ),
    "day": (40, 329, 3364),
    # One created event per job, a started one unless pending, one per finish. The
    # list of known counts gives 309737 for the largest scale, which contradicts its
    # own status counts: 150000 + (150000 - 40163) + (37335 + 12375) = 309547.
    "job_events": (3075, 30967, 309547),
    "health": (
        {"api": "healthy", "database": "healthy", "kafka": "healthy"},
        {"api": "healthy", "database": "healthy", "kafka": "healthy"},
        {"api": "degraded", "database": "unhealthy", "kafka": "degraded"},
    ),
}


def counts(df, key):
    return {r[key]: r["count"] for r in df.groupBy(key).count().collect()}


@pytest.mark.parametrize("scale", range(3), ids=SCALES)
def test_known_counts(spark, scale):
    folder = f"/root/testdata/sf{SCALES[scale]}"
    want = {k: v[scale] for k, v in GOLDEN.items()}
    ingestion, job = records.ingestion(spark, folder), records.jobs(spark, folder)
    output, alert = records.outputs(spark, folder), records.alerts(spark, folder)
    from_kafka = reads.equal_to(source_type="kafka")
    info = reads.page_info(ingestion, 1, 20, from_kafka).collect()[0]
    finished = job.filter(F.col("status").isin("completed", "failed"))
    got = {
        "kafka": info.total,
        "pages": info.pages,
        "first": [r.id for r in reads.page(ingestion, 1, 5, from_kafka).collect()],
        "status": counts(job, "status"),
        "retryable": jobs.retryable(job).count(),
        "over_300": jobs.timed_out(finished, AS_OF).count(),
        "unprocessed": lineage.unprocessed(ingestion, job).count(),
        "orphan_jobs": lineage.orphan_jobs(job, ingestion).count(),
        "orphan_outputs": lineage.orphan_outputs(output, job).count(),
        "valid": outputs.valid_outputs(output).count(),
        "errors": {r.error: r.n for r in outputs.top_errors(output).collect()},
        "active": counts(alerts.active_alerts(alert), "severity"),
        "day": reads.trailing(records.metrics(spark, folder), AS_OF, 24).count(),
        "job_events": records.job_events(spark, folder).count(),
        "health": {r.service: r.status for r in health.latest_checks(records.health_checks(spark, folder)).collect()},
    }
    assert got == want
    assert log.offset_gaps(records.envelope(spark, folder)).count() == 0


def test_known_histogram(spark):
    metrics = records.metrics(spark, "/root/testdata/sf0.01")
    bounds = (5.0, 10.0, 25.0, 50.0, 75.0, 100.0, 250.0, 500.0)
    rows = cumulative_histogram(metrics, [], F.col("value"), bounds).orderBy("le").collect()
    assert [r.n for r in rows] == [971, 1816, 3910, 6335, 7773, 8684, 9939, 10000, 10000]
