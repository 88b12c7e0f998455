"""Streams over several files: order, replays, late rows, restarts."""

from __future__ import annotations

import os
import time
from datetime import datetime, timedelta
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions.rules import Rule
from millrace.operators import metrics as metric_ops
from millrace.operators.metrics import Trigger
from millrace.operators.ratelimit import rate_limit
from millrace.operators.requests import rolling_clients
from millrace.plans import records
from millrace.plans.log import PAYLOAD
from millrace.schemas import ENVELOPE
from millrace.sources import tables
from millrace.sources.workspace import shared_folder
from millrace.streaming import ingest, rollups, source, state

FOLDER = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)


class Feed:
    """A folder that receives one file at a time, in a defined order."""

    def __init__(self, spark, schema):
        self.spark, self.schema, self.path, self.n = spark, schema, shared_folder(spark, "feed"), 0
        self.seen = set()
        os.makedirs(self.path)

    def put(self, df):
        df.coalesce(1).write.mode("append").parquet(self.path)
        self.n += 1
        # The file source takes files by modification time.
        for name in set(os.listdir(self.path)) - self.seen:
            os.utime(os.path.join(self.path, name), (1_700_000_000 + self.n,) * 2)
        self.seen = set(os.listdir(self.path))

    def stream(self, max_files=1):
        return source.file_stream(self.spark, self.path, self.schema, max_files)


def split(df, ts, n):
    """The rows in time order, cut into n slices."""
    rows = sorted(df.collect(), key=lambda r: r[ts])
    size = -(-len(rows) // n)
    return [df.sparkSession.createDataFrame(rows[i : i + size], df.schema) for i in range(0, len(rows), size)]


def messages(spark, specs):
    rows = [("k", v, "t", p, o, START + timedelta(minutes=m)) for p, o, m, v in specs]
    return spark.createDataFrame(rows, ENVELOPE)


def rules():
    return [Rule("k", "range", F.col("message.k") <= 90)]


def test_ingest_with_restart(spark):
    feed = Feed(spark, ENVELOPE)
    base = shared_folder(spark, "s")

    def run():
        writer = ingest.ingest_writer(feed.stream(), PAYLOAD, rules(), f"{base}/t", f"{base}/d", f"{base}/c")
        source.drain(writer)

    feed.put(messages(spark, [(0, 0, 0, '{"k":1}'), (0, 1, 0, "broken")]))
    feed.put(messages(spark, [(0, 2, 1, '{"k":99}'), (0, 3, 1, '{"k":2}')]))
    run()
    feed.put(messages(spark, [(0, 4, 2, '{"k":3}')]))
    run()
    run()
    good = spark.read.parquet(f"{base}/t").collect()
    bad = {r.offset: r.validation_errors for r in spark.read.parquet(f"{base}/d").collect()}
    assert sorted((r.offset, r.k) for r in good) == [(0, 1), (3, 2), (4, 3)]
    assert bad == {1: ["value:json", "k:range"], 2: ["k:range"]}


def test_replayed_batch_overwrites_itself(spark):
    base = shared_folder(spark, "s")
    for _ in range(2):
        spark.range(3).write.mode("overwrite").parquet(source.batch_folder(base, 0))
    spark.range(2).write.mode("overwrite").parquet(source.batch_folder(base, 1))
    out = source.read_batches(spark, base, spark.range(0).schema)
    assert out.groupBy("batch_id").count().orderBy("batch_id").collect() == [(0, 3), (1, 2)]


def test_dedup_over_batches(spark):
    feed = Feed(spark, ENVELOPE)
    feed.put(messages(spark, [(0, 0, 0, "a"), (0, 1, 1, "b"), (1, 0, 1, "c")]))
    feed.put(messages(spark, [(0, 1, 1, "b"), (0, 2, 2, "d")]))
    base = shared_folder(spark, "s")
    source.drain(ingest.file_writer(ingest.without_replays(feed.stream(), "10 minutes"), f"{base}/o", f"{base}/c"))
    got = sorted((r.partition, r.offset) for r in spark.read.parquet(f"{base}/o").collect())
    assert got == [(0, 0), (0, 1), (0, 2), (1, 0)]


LOG_SCHEMA = "request_id long, ts timestamp_ntz, status_code int, process_time_ms double"


def requests(spark, minutes, first=0):
    rows = [(first + i, START + timedelta(minutes=m), 200, 1.0) for i, m in enumerate(minutes)]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def test_late_rows_are_dropped_and_counted(spark):
    feed = Feed(spark, requests(spark, []).schema)
    feed.put(requests(spark, [0, 1, 60]))
    feed.put(requests(spark, [90]))
    feed.put(requests(spark, [2, 91]))  # minute 2 lies far behind the watermark
    base = shared_folder(spark, "s")
    late = source.LateRows()
    spark.streams.addListener(late)
    query = source.drain(
        ingest.file_writer(rollups.rolling_stream(feed.stream(), "1 minute", "10 minutes"), f"{base}/o", f"{base}/c")
    )
    starts = sorted(r.window_start for r in spark.read.parquet(f"{base}/o").collect())
    assert [(s - START).total_seconds() / 60 for s in starts] == [0, 1, 60]
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    for _ in range(100):
        if late.of(query):
            break
        time.sleep(0.1)
    spark.streams.removeListener(late)
    assert late.of(query) == 1


def test_tumbling_equals_batch_over_many_files(spark):
    log = records.request_log(spark, FOLDER)
    feed = Feed(spark, log.schema)
    for part in split(log, "ts", 5):
        feed.put(part)
    base = shared_folder(spark, "s")
    stream = rollups.rolling_stream(feed.stream(), "6 hours", "1 hour")
    source.drain(ingest.file_writer(stream, f"{base}/o", f"{base}/c"))
    got = {r.window_start: (r.requests, r.errors) for r in spark.read.parquet(f"{base}/o").collect()}
    end = log.agg(F.max("ts")).collect()[0][0] - timedelta(hours=1)
    from millrace.operators.requests import rolling_counts

    batch = rolling_counts(log.withColumn("ts", F.col("ts").cast("timestamp")), "6 hours").collect()
    assert got == {r.window_start: (r.requests, r.errors) for r in batch if r.window_end <= end}


@pytest.mark.parametrize("files", [1, 4])
def test_rate_limit_equals_batch(spark, files):
    log = records.request_log(spark, FOLDER).select("request_id", "client_id", "ts")
    feed = Feed(spark, log.schema)
    for part in split(log, "ts", files):
        feed.put(part)
    base = shared_folder(spark, "s")
    decided = state.rate_limit_stream(feed.stream(), "1 hour", limit=3, window_seconds=86400)
    source.drain(ingest.file_writer(decided, f"{base}/o", f"{base}/c"))
    got = {r.request_id: (r.allowed, r.remaining, r.reset) for r in spark.read.parquet(f"{base}/o").collect()}
    want = {r.request_id: (r.allowed, r.remaining, r.reset) for r in rate_limit(log, 3, 86400).collect()}
    assert got == want and not all(v[0] for v in want.values())


def job_rows(spark, rows):
    data = [(j, START + timedelta(minutes=m), e, s, x) for j, m, e, s, x in rows]
    return spark.createDataFrame(data, "job_id string, ts timestamp_ntz, event string, seq int, error_message string")


def test_job_lifecycle_across_batches(spark):
    feed = Feed(spark, job_rows(spark, []).schema)
    feed.put(job_rows(spark, [("a", 0, "created", 0, None), ("a", 1, "started", 1, None), ("b", 1, "started", 1, None),
                              ("c", 2, "failed", 2, "early")]))
    feed.put(job_rows(spark, [("a", 3, "completed", 2, None), ("d", 60, "created", 0, None)]))
    feed.put(job_rows(spark, [("d", 61, "started", 1, None), ("a", 2, "failed", 2, "stale")]))
    feed.put(job_rows(spark, [("d", 75, "failed", 2, "slow"), ("e", 90, "created", 0, None)]))
    base = shared_folder(spark, "s")
    life = state.job_lifecycle(feed.stream(), "1 minute", limit_seconds=300)
    source.drain(ingest.batch_writer(life, f"{base}/o", f"{base}/c", "update"))
    versions = source.read_batches(spark, f"{base}/o", life.schema)
    last = {
        r.job_id: r.v
        for r in versions.groupBy("job_id").agg(F.max_by(F.struct(*life.columns), "batch_id").alias("v")).collect()
    }
    assert (last["a"].status, last["a"].duration_seconds, last["a"].timed_out) == ("completed", 120.0, False)
    assert (last["b"].status, last["b"].timed_out) == ("processing", True)
    assert (last["c"].status, last["c"].duration_seconds, last["c"].error_message) == ("failed", None, "early")
    assert (last["d"].status, last["d"].duration_seconds, last["d"].timed_out) == ("failed", 840.0, True)
    assert (last["e"].status, last["e"].events) == ("pending", 1)


def test_alerts_equal_batch_runs(spark):
    log = records.request_log(spark, FOLDER)
    points = metric_ops.request_points(log)
    triggers = [Trigger("average_response_time_ms", ">", 40.0, 2), Trigger("error_rate_percent", ">=", 50.0, 2)]
    step = 3 * 3600
    feed = Feed(spark, points.schema)
    for part in split(points, "ts", 4):
        feed.put(part)
    base = shared_folder(spark, "s")
    steps = state.step_means(feed.stream(), "1 hour", step)
    source.drain(ingest.file_writer(steps, f"{base}/steps", f"{base}/c1"))
    closed = source.file_stream(spark, f"{base}/steps", steps.schema, None)
    source.drain(ingest.file_writer(state.alert_stream(closed, triggers, step), f"{base}/o", f"{base}/c2"))
    got = {}
    for r in spark.read.parquet(f"{base}/o").collect():
        got.setdefault((r.metric, r.since_us), set()).add((r.action, r.at_us))

    def us(ts):
        return round((ts - datetime(1970, 1, 1)).total_seconds() * 1e6)

    last = spark.read.parquet(f"{base}/steps").agg(F.max("step")).collect()[0][0]
    runs = metric_ops.sustained_breach(points, triggers, step).collect()
    assert runs
    for r in runs:
        if us(r.ended_at) <= last * step * 1_000_000:
            need = next(t.steps for t in triggers if t.metric == r.metric)
            assert got[(r.metric, us(r.started_at))] == {
                ("open", us(r.started_at) + need * step * 1_000_000), ("resolve", us(r.ended_at)),
            }


def test_upsert_over_batches(spark):
    schema = "id long, k string, v string, created_at timestamp_ntz, updated_at timestamp_ntz"

    def rows(*items):
        return spark.createDataFrame([(i, k, v, START + timedelta(minutes=i), None) for i, k, v in items], schema)

    feed = Feed(spark, rows().schema)
    feed.put(rows((1, "a", "one"), (2, "b", "two")))
    feed.put(rows((3, "a", "three"), (4, "a", "four")))
    base = shared_folder(spark, "s")
    source.drain(ingest.upsert_writer(feed.stream(), ["k"], f"{base}/o", f"{base}/c"))
    assert {r.k: r.v for r in spark.read.parquet(f"{base}/o").collect()} == {"a": "four", "b": "two"}
    # A fresh checkpoint takes everything again and changes nothing.
    source.drain(ingest.upsert_writer(feed.stream(), ["k"], f"{base}/o", f"{base}/c2"))
    assert {r.k: r.v for r in spark.read.parquet(f"{base}/o").collect()} == {"a": "four", "b": "two"}


VERSION = "id long, k string, v string, created_at timestamp_ntz, updated_at timestamp_ntz"


def versions(spark, *items):
    return spark.createDataFrame([(i, k, v, START + timedelta(minutes=i), None) for i, k, v in items], VERSION)


def files_of(path):
    return {os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_upsert_leaves_untouched_groups_alone(spark):
    path = f"{shared_folder(spark, 's')}/t"
    tables.merge_groups(versions(spark, *[(i, f"k{i}", "old") for i in range(40)]), ["k"], path, 8, "a")
    before = files_of(path)
    assert len(before) == 8
    tables.merge_groups(versions(spark, (50, "k3", "new"), (1, "k4", "older"), (51, None, "null")), ["k"], path, 8, "b")
    rows = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert rows == {**{f"k{i}": "old" for i in range(40)}, "k3": "new", None: "null"}
    assert spark.read.parquet(path).count() == 41
    assert 5 <= len(before & files_of(path)) < 8
    with pytest.raises(ValueError):
        tables.merge_groups(versions(spark, (60, "k3", "x")), ["k"], path, 16, "c")


def test_upsert_goes_on_after_a_failure(spark, monkeypatch):
    path = f"{shared_folder(spark, 's')}/t"
    tables.merge_groups(versions(spark, *[(i, f"k{i}", "old") for i in range(20)]), ["k"], path, 4, "a")
    fresh = versions(spark, *[(100 + i, f"k{i}", "new") for i in range(20)])
    remove, calls = tables._delete, []

    def fail(session, folder):
        calls.append(folder)
        remove(session, folder)
        if len(calls) == 2:  # the old content is gone, the new one not yet there
            raise OSError("lost")

    monkeypatch.setattr(tables, "_delete", fail)
    with pytest.raises(OSError):
        tables.merge_groups(fresh, ["k"], path, 4, "b")
    monkeypatch.setattr(tables, "_delete", remove)
    tables.merge_groups(fresh, ["k"], path, 4, "b")
    assert {r.k: r.v for r in spark.read.parquet(path).collect()} == {f"k{i}": "new" for i in range(20)}


def test_ingest_with_a_fresh_checkpoint_keeps_what_is_stored(spark):
    base = shared_folder(spark, "s")

    def run(feed, checkpoint):
        source.drain(ingest.ingest_writer(feed.stream(), PAYLOAD, rules(), f"{base}/t", f"{base}/d", checkpoint))

    for offset in (1, 2):
        feed = Feed(spark, ENVELOPE)
        feed.put(messages(spark, [(0, offset, 0, '{"k":1}'), (0, offset + 10, 0, "broken")]))
        run(feed, f"{base}/c{offset}")
    assert sorted(r.offset for r in spark.read.parquet(f"{base}/t").collect()) == [1, 2]
    assert sorted(r.offset for r in spark.read.parquet(f"{base}/d").collect()) == [11, 12]


def test_ingest_sets_aside_what_the_handler_fails_on(spark):
    feed, base = Feed(spark, ENVELOPE), shared_folder(spark, "s")
    feed.put(messages(spark, [(0, 0, 0, '{"k":1}'), (0, 1, 0, '{"k":7}'), (0, 2, 0, "broken")]))

    def handler(message):
        if message["k"] == 7:
            raise KeyError("seven")

    source.drain(
        ingest.ingest_writer(feed.stream(), PAYLOAD, rules(), f"{base}/t", f"{base}/d", f"{base}/c", handler)
    )
    assert [r.offset for r in spark.read.parquet(f"{base}/t").collect()] == [0]
    bad = {r.offset: r.validation_errors for r in spark.read.parquet(f"{base}/d").collect()}
    assert bad[1] == ["handler: KeyError: 'seven'"] and bad[2] == ["value:json", "k:range"]


def test_job_states_end_and_outlive_a_restart(spark):
    feed, base = Feed(spark, job_rows(spark, []).schema), shared_folder(spark, "s")

    def run():
        life = state.job_lifecycle(feed.stream(), "1 minute", limit_seconds=300, keep_seconds=3600, keep_pending_seconds=7200)
        query = source.drain(ingest.batch_writer(life, f"{base}/o", f"{base}/c", "update"))
        states = [op.numRowsTotal for p in query.recentProgress for op in p.stateOperators]
        versions = source.read_batches(spark, f"{base}/o", life.schema)
        newest = versions.groupBy("job_id").agg(F.max_by(F.struct(*life.columns), "batch_id").alias("v"))
        return {r.job_id: r.v for r in newest.collect()}, states[-1]

    feed.put(job_rows(spark, [("a", 0, "created", 0, None), ("b", 0, "created", 0, None), ("a", 1, "started", 1, None)]))
    run()
    feed.put(job_rows(spark, [("a", 4, "completed", 2, None), ("c", 10, "started", 1, None)]))
    last, states = run()
    assert (last["a"].status, last["a"].duration_seconds, last["a"].events) == ("completed", 180.0, 3)
    assert last["b"].status == "pending" and not last["c"].timed_out
    feed.put(job_rows(spark, [("d", 200, "created", 0, None)]))
    last, states = run()
    assert last["c"].timed_out  # by its timer, without an event
    feed.put(job_rows(spark, [("d", 201, "started", 1, None)]))
    last, states = run()
    assert (last["d"].status, last["d"].events) == ("processing", 2)
    # a, b and c are forgotten: an event of a begins a history of its own.
    feed.put(job_rows(spark, [("a", 202, "started", 0, None)]))
    last, states = run()
    assert (last["a"].status, last["a"].events) == ("processing", 1)


class Bucket:
    """One key's state and timers, as the state store keeps them; counts the accesses."""

    def __init__(self):
        self.head, self.pieces, self.timers, self.accesses = None, {}, set(), 0

    def getValueState(self, name, schema):  # noqa: N802
        return self

    getMapState = lambda self, name, key, schema: Pieces(self)  # noqa: E731, N815

    def get(self):
        self.accesses += 1
        return self.head

    def update(self, value):
        self.accesses, self.head = self.accesses + 1, value

    def clear(self):
        self.accesses, self.head = self.accesses + 1, None

    def registerTimer(self, ms):  # noqa: N802
        self.accesses += 1
        self.timers.add(ms)

    def deleteTimer(self, ms):  # noqa: N802
        self.accesses += 1
        self.timers.remove(ms)


class Pieces:
    def __init__(self, bucket):
        self.bucket, self.held = bucket, bucket.pieces

    def getValue(self, piece):  # noqa: N802
        self.bucket.accesses += 1
        return self.held[piece]

    def updateValue(self, piece, value):  # noqa: N802
        self.bucket.accesses, self.held[piece] = self.bucket.accesses + 1, value

    def removeKey(self, piece):  # noqa: N802
        self.bucket.accesses += 1
        del self.held[piece]


def test_jobs_of_a_bucket_are_those_one_by_one():
    """Many jobs share a key: every batch and timer leaves each as if it were alone, in few accesses to the store."""
    limit, keep, wait, most = 300 * 10**6, 3600 * 10**6, 7200 * 10**6, state.PIECE_JOBS
    bucket, life, alone, sizes = Bucket(), state.JobLife(limit, keep, wait), {}, []
    life.init(bucket)
    draw, columns = np.random.default_rng(1), ["job_id", "spot", "us", "seq", "event", "error_message"]
    for batch in range(12):
        now, n = batch * 900 * 10**6, (6 * most, most, 3, 0)[batch % 4]
        rows = []
        for job in draw.integers(0, 8 * most, n).tolist():
            event = ("created", "started", "completed", "failed")[draw.integers(4)]
            error = "e" if event == "failed" else None
            rows.append((f"j{job}" if job else None, job * 7919, int(now + draw.integers(0, 900) * 10**6), 0, event, error))
        want = {}
        for r in sorted(rows, key=lambda r: (r[2], r[4])):
            want[r[0]] = alone[r[0]] = state._apply_event(alone.get(r[0], state._NEW_JOB), *r[2:], limit)
        before, got = bucket.accesses, {}
        clock = SimpleNamespace(getCurrentWatermarkInMs=lambda now=now: now // 1000)
        if rows:
            frames = [pd.DataFrame(part, columns=columns) for part in (rows[: n // 2], rows[n // 2 :])]
            for out in life.handleInputRows((0,), iter(frames), clock):
                got |= {j: tuple(facts) for j, *facts in out.itertuples(index=False)}
        assert got == {j: job[:8] for j, job in want.items()}
        want, got = {}, {}
        for j, job in list(alone.items()):
            if life._wakes_at(job) < now:
                if job[0] == "processing" and not job[6]:
                    want[j] = alone[j] = (*job[:6], True, *job[7:])
                else:
                    del alone[j]
        for ms in [t for t in sorted(bucket.timers) if t <= now // 1000]:
            for out in life.handleExpiredTimer((0,), clock, SimpleNamespace(getExpiryTimeInMs=lambda ms=ms: ms)):
                got |= {j: tuple(facts) for j, *facts in out.itertuples(index=False)}
            bucket.timers.discard(ms)
        assert got == {j: job[:8] for j, job in want.items()}
        held = {j: tuple(f) for names, _, *facts in bucket.pieces.values() for j, *f in zip(names, *facts)}
        assert held == alone and len(bucket.timers) == bool(alone)
        sizes.append(len(bucket.pieces))
        if n == 3:  # few pieces are touched by the rows; the timer may wake all
            assert bucket.accesses - before <= 2 * (3 + sizes[-2]) + 8
        assert bucket.accesses - before <= 4 * max(sizes) + 8 < most
    assert max(sizes) >= 4


def test_jobs_share_keys_of_the_store(spark):
    """Three thousand jobs cost a few calls and entries, not one each; they time out all the same."""
    rows = [(f"j{i}", i % 7, "started", 1, None) for i in range(3000)]
    feed, base = Feed(spark, job_rows(spark, []).schema), shared_folder(spark, "s")
    feed.put(job_rows(spark, [*rows, ("late", 30, "created", 0, None)]))
    life = state.job_lifecycle(feed.stream(), "1 minute", limit_seconds=300)
    query = source.drain(ingest.batch_writer(life, f"{base}/o", f"{base}/c", "update"))
    assert max(op.numRowsUpdated for p in query.recentProgress for op in p.stateOperators) <= 2 * state.BUCKETS
    versions = source.read_batches(spark, f"{base}/o", life.schema)
    last = versions.groupBy("job_id").agg(F.max_by("timed_out", "batch_id").alias("t")).collect()
    assert len(last) == 3001 and sum(r.t for r in last) == 3000


class Held(dict):
    """The store's map, as a dictionary."""

    updateValue, getValue, removeKey = dict.__setitem__, dict.__getitem__, dict.__delitem__


@pytest.mark.parametrize("frames", [2, 15, 16, 40, 300])
def test_runs_are_merged_with_few_rows_held(frames):
    draw = np.random.default_rng(frames)
    store, rows = Held(), []
    runs = state.Sorted(store)
    for i in range(frames):
        us, ids = draw.integers(0, 50, 2500), draw.permutation(2500) + 2500 * i
        rows += zip(us.tolist(), ids.tolist())
        runs.add(us, ids)
    out = [pair for us, ids in runs.rows() for pair in zip(us.tolist(), ids.tolist())]
    assert out == sorted(rows) and not store
    assert runs.most_held <= 3 * state.FAN * state.PIECE_ROWS


def test_a_hot_client_is_decided_piecewise(spark):
    """One client has more rows in a batch than a frame holds; the answers are those of the batch operator."""
    n = 1500
    log = spark.range(n).select(
        F.col("id").alias("request_id"), F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.lit("hot")).alias("client_id"),
        F.timestamp_seconds(1_700_000_000 + (F.col("id") * 7919) % n).cast("timestamp_ntz").alias("ts"),
    )
    feed, base = Feed(spark, log.schema), shared_folder(spark, "s")
    feed.put(log)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, 100)
    try:
        decided = state.rate_limit_stream(feed.stream(), "1 hour", limit=5, window_seconds=60)
        source.drain(ingest.file_writer(decided, f"{base}/o", f"{base}/c"))
    finally:
        spark.conf.set(setting, before)
    got = {r.request_id: (r.allowed, r.remaining, r.reset) for r in spark.read.parquet(f"{base}/o").collect()}
    want = {r.request_id: (r.allowed, r.remaining, r.reset) for r in rate_limit(log, 5, 60).collect()}
    assert got == want and len(want) == n


def test_stream_join_respects_the_bound(spark):
    jobs = spark.createDataFrame([("a", START), ("b", START)], "job_id string, started_at timestamp_ntz")
    outputs = spark.createDataFrame(
        [("a", START + timedelta(minutes=5)), ("b", START + timedelta(minutes=50)), ("c", START)],
        "job_id string, output_at timestamp_ntz",
    )
    left, right = Feed(spark, jobs.schema), Feed(spark, outputs.schema)
    left.put(jobs)
    right.put(outputs)
    base = shared_folder(spark, "s")
    joined = rollups.outputs_of_jobs(left.stream(), right.stream(), "1 hour", 600)
    source.drain(ingest.file_writer(joined, f"{base}/o", f"{base}/c"))
    assert [(r.job_id, r.seconds) for r in spark.read.parquet(f"{base}/o").collect()] == [("a", 300.0)]


def test_user_handler(spark):
    feed = Feed(spark, ENVELOPE)
    feed.put(messages(spark, [(0, 0, 0, "a"), (0, 1, 0, "b")]))
    seen = []
    source.drain(
        ingest.handle_writer(feed.stream(), lambda df, n: seen.append((n, df.count())), shared_folder(spark, "c"))
    )
    assert seen == [(0, 2)]


def test_pacing(spark):
    feed = Feed(spark, ENVELOPE)
    writer = source.paced(feed.stream().writeStream.format("noop").option("checkpointLocation", shared_folder(spark, "c")))
    query = writer.start()
    try:
        assert query.isActive
    finally:
        query.stop()


def test_sketched_clients_of_a_stream(spark):
    log = records.request_log(spark, FOLDER).select("ts", "client_id")
    feed = Feed(spark, log.schema)
    for part in split(log, "ts", 4):
        feed.put(part)
    base = shared_folder(spark, "s")
    stream = rollups.rolling_clients_stream(feed.stream(), "1 day", "1 hour", "6 hours")
    source.drain(ingest.file_writer(stream, f"{base}/o", f"{base}/c"))
    got = {r.window_start: r.clients for r in spark.read.parquet(f"{base}/o").collect()}
    exact = {r.window_start: r.clients for r in rolling_clients(log.withColumn("ts", F.col("ts").cast("timestamp")), "1 day", "6 hours").collect()}
    assert len(got) > 10 and all(abs(n - exact[w]) <= max(2, 0.05 * exact[w]) for w, n in got.items())
