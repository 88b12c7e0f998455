"""Job life cycle on inline events, against direct application of each event."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from millrace.operators import jobs

START = datetime(2024, 1, 1)
SCHEMA = "job_id string, ts timestamp_ntz, event string, seq int, error_message string"


def at(minutes):
    return START + timedelta(minutes=minutes)


def fold(spark, rows):
    return {r.job_id: r for r in jobs.fold_jobs(spark.createDataFrame(rows, SCHEMA)).collect()}


def expected(rows):
    out = {}
    for job_id, ts, event, _seq, error in sorted(rows, key=lambda r: (r[1], r[3])):
        j = out.setdefault(
            job_id, dict(status="pending", progress=0.0, error=None, created=None, started=None, completed=None, duration=None)
        )
        if event == "created":
            j["created"] = ts if j["created"] is None else j["created"]
        elif event == "started":
            j.update(status="processing", started=ts)
        else:
            j.update(status=event, completed=ts)
            if event == "completed":
                j["progress"] = 100.0
            else:
                j["error"] = error
            if j["started"]:
                j["duration"] = (ts - j["started"]).total_seconds()
    return out


def test_never_started_then_failed(spark):
    j = fold(spark, [("a", at(0), "created", 0, None), ("a", at(5), "failed", 2, "boom")])["a"]
    assert (j.status, j.error_message, j.duration_seconds, j.progress_percentage) == ("failed", "boom", None, 0.0)
    assert j.completed_at == at(5) and j.started_at is None


def test_started_then_failed_keeps_progress(spark):
    rows = [("a", at(0), "created", 0, None), ("a", at(1), "started", 1, None), ("a", at(3), "failed", 2, "x")]
    j = fold(spark, rows)["a"]
    assert (j.status, j.progress_percentage, j.duration_seconds) == ("failed", 0.0, 120.0)


def test_completed_twice(spark):
    rows = [("a", at(1), "started", 1, None), ("a", at(2), "completed", 2, None), ("a", at(9), "completed", 2, None)]
    j = fold(spark, rows)["a"]
    assert (j.status, j.duration_seconds, j.completed_at) == ("completed", 480.0, at(9))


def test_started_again_after_finish(spark):
    rows = [
        ("a", at(1), "started", 1, None), ("a", at(2), "failed", 2, "first"), ("a", at(5), "started", 1, None),
    ]
    j = fold(spark, rows)["a"]
    assert (j.status, j.started_at, j.completed_at, j.duration_seconds) == ("processing", at(5), at(2), 60.0)
    assert j.error_message == "first" and j.updated_at == at(5)


def test_random_histories(spark):
    rng = random.Random(5)
    rows, used = [], set()
    for i in range(1500):
        job = "hot" if rng.random() < 0.4 else f"j{rng.randrange(60)}"
        event = rng.choice(["created", "started", "completed", "failed"])
        ts = at(rng.randrange(3000))
        seq = {"created": 0, "started": 1}.get(event, 2)
        if (job, ts, seq) in used:
            continue
        used.add((job, ts, seq))
        rows.append((job, ts, event, seq, f"e{i}" if event == "failed" else None))
    got = fold(spark, rows)
    want = expected(rows)
    assert set(got) == set(want)
    for k, w in want.items():
        g = got[k]
        assert (g.status, g.progress_percentage, g.error_message, g.created_at, g.started_at, g.completed_at, g.duration_seconds) == (
            w["status"], w["progress"], w["error"], w["created"], w["started"], w["completed"], w["duration"])


def test_retry_and_timeout(spark):
    rows = [
        ("a", "failed", 2, 3, at(0), at(1)), ("b", "failed", 3, 3, at(0), at(1)),
        ("c", "processing", 0, 3, at(0), None), ("d", "pending", 0, 3, None, None),
        ("e", "completed", 0, 3, at(0), at(5)),
    ]
    df = spark.createDataFrame(
        rows, "job_id string, status string, retry_count int, max_retries int, started_at timestamp_ntz, completed_at timestamp_ntz"
    )
    schedule = jobs.retry_schedule(df, 10).collect()
    assert [(r.job_id, r.next_attempt_at, r.attempt) for r in schedule] == [("a", at(1) + timedelta(seconds=10), 3)]
    assert {r.job_id for r in jobs.timed_out(df, at(60)).collect()} == {"c"}
    assert {r.job_id for r in jobs.timed_out(df, at(60), 299).collect()} == {"c", "e"}


def test_current_state_prefers_newest(spark):
    rows = [(1, "k", "old", at(0), None), (2, "k", "new", at(0), at(9)), (3, "k", "mid", at(5), None)]
    df = spark.createDataFrame(rows, "id long, key string, v string, created_at timestamp_ntz, updated_at timestamp_ntz")
    assert [r.v for r in jobs.current_state(df, ["key"]).collect()] == ["new"]
