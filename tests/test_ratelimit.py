"""The rate limit against a direct simulation."""

from __future__ import annotations

import random
from collections import defaultdict, deque
from datetime import datetime, timedelta

import pytest

from millrace.operators.ratelimit import rate_limit

START = datetime(2024, 1, 1)
SCHEMA = "request_id long, client_id string, ts timestamp_ntz"


def simulate(rows, limit, seconds):
    kept, out = defaultdict(deque), {}
    for rid, client, ts in sorted(rows, key=lambda r: (r[2], r[0])):
        q = kept[client or "unknown"]
        while q and q[0] < ts - timedelta(seconds=seconds):
            q.popleft()
        if len(q) >= limit:
            out[rid] = (False, 0)
        else:
            q.append(ts)
            out[rid] = (True, limit - len(q))
    return out


def run(spark, rows, limit, seconds):
    df = spark.createDataFrame(rows, SCHEMA)
    got = rate_limit(df, limit, seconds).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.reset == int((r.ts - datetime(1970, 1, 1)).total_seconds()) + seconds
    return {r.request_id: (r.allowed, r.remaining) for r in got}


@pytest.mark.parametrize("limit,seconds,span,seed", [(3, 60, 4000, 1), (10, 60, 2000, 2), (100, 60, 900, 3), (1, 5, 500, 4)])
def test_against_simulation(spark, limit, seconds, span, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(2500):
        client = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", "c", None])
        at = rng.choice([rng.randrange(span), rng.randrange(span // 10), 17])
        rows.append((i, client, START + timedelta(seconds=at, microseconds=rng.choice([0, 500_000]))))
    assert run(spark, rows, limit, seconds) == simulate(rows, limit, seconds)


def test_exactly_one_window_apart_still_counts(spark):
    rows = [(1, "a", START), (2, "a", START + timedelta(seconds=60)), (3, "a", START + timedelta(seconds=60, microseconds=1))]
    assert run(spark, rows, 1, 60) == {1: (True, 0), 2: (False, 0), 3: (True, 0)}


def test_burst_then_pause(spark):
    rows = [(i, "a", START + timedelta(seconds=i)) for i in range(10)]
    rows += [(100, "a", START + timedelta(seconds=70))]
    got = run(spark, rows, 4, 60)
    assert [got[i][0] for i in range(10)] == [True] * 4 + [False] * 6
    assert got[100] == (True, 3)


def test_bad_arguments(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        rate_limit(df, 0)


@pytest.mark.parametrize("folder,limit,denied", [("/root/testdata/sf0.01", 3, 2433), ("/root/testdata/sf0.01", 100, 0)])
def test_known_counts(spark, folder, limit, denied):
    from millrace.plans import records

    seconds = 86400 if limit == 3 else 60
    out = rate_limit(records.request_log(spark, folder), limit, seconds)
    assert out.filter("not allowed").count() == denied
