"""Bucketed ordered operations against plain Python, with one dominant key."""

from __future__ import annotations

import math
import random
from bisect import bisect_right
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.functions import ordered
from millrace.functions.scalars import micros, time_bucket

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.4 else rng.choice("abcdef")
        # Coarse times give ties; a third of the hot rows share one instant.
        seconds = 5000 if key == "hot" and rng.random() < 0.33 else rng.randrange(0, 20000)
        out.append((i, key, START + timedelta(seconds=seconds), float(rng.randrange(0, 50))))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "id long, k string, ts timestamp_ntz, value double").repartition(5)


def by_key(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        groups.setdefault(r[1], []).append(r)
    return groups


@pytest.mark.parametrize("width", [60, 700, 10**6, None])
def test_row_index(df, rows, width):
    bucket = time_bucket("ts", width) if width else None
    out = ordered.row_index(df, ["k"], [F.col("ts"), F.col("id")], bucket)
    got = {r.id: r.row_index for r in out.collect()}
    assert got == {r[0]: i for g in by_key(rows).values() for i, r in enumerate(g)}


def test_row_index_without_key(df, rows):
    out = ordered.row_index(df, [], [F.col("ts"), F.col("id")], time_bucket("ts", 500))
    got = {r.id: r.row_index for r in out.collect()}
    assert got == {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (r[2], r[0])))}


def test_row_index_null_key(spark):
    data = [(i, None, START + timedelta(seconds=i)) for i in range(10)]
    df = spark.createDataFrame(data, "id long, k string, ts timestamp_ntz")
    out = ordered.row_index(df, ["k"], [F.col("ts")], time_bucket("ts", 3))
    assert {r.id: r.row_index for r in out.collect()} == {i: i for i in range(10)}


@pytest.mark.parametrize("skip", [0, 1234, 2990, 5000])
@pytest.mark.parametrize("enough", [1, 50, 10_000])
def test_seek_key(df, rows, skip, enough, monkeypatch):
    """Null times last, text ids, many rows on one instant: at every depth the rows of a full sort."""
    monkeypatch.setattr(ordered, "SEEK_SAMPLE", 200)
    monkeypatch.setattr(ordered, "SEEK_BOUNDS", 7)
    ts = F.when(F.col("id") % 3 == 0, F.lit(START)).when(F.col("id") % 3 == 1, F.col("ts")).cast("timestamp_ntz")
    odd = df.select(ts.alias("ts"), F.concat(F.lit("x"), "id").alias("tie"))
    found, rest = ordered.seek_key(odd, "ts", "tie", skip, 10, enough)
    got = [tuple(r) for r in found.orderBy(F.desc_nulls_last("ts"), F.desc("tie")).offset(rest).limit(10).collect()]
    want = sorted((tuple(r) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or START, r[1]), reverse=True)
    assert got == want[skip : skip + 10] and rest <= max(skip, 0) and (rest <= enough or skip >= len(want))


def test_seek_bounds_reach_the_scan(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ordered, "SEEK_SAMPLE", 200)
    rows = [(START + timedelta(seconds=i), i) for i in range(2000)]
    spark.createDataFrame(rows, "ts timestamp_ntz, id long").write.parquet(str(tmp_path / "t"))
    found, _ = ordered.seek_key(spark.read.parquet(str(tmp_path / "t")), "ts", "id", 900, 10, 20)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(ts" in plan and "GreaterThanOrEqual(ts" in plan


@pytest.mark.parametrize("n,chunk", [(1, 10), (4, 5), (10, 10), (25, 7)])
def test_trailing_rows(df, rows, n, chunk):
    out = ordered.trailing_rows(
        df, ["k"], [F.col("ts"), F.col("id")], time_bucket("ts", 600), n, {"s": F.sum("value")}, chunk
    )
    got = {r.id: r.s for r in out.collect()}
    want = {}
    for g in by_key(rows).values():
        for i, r in enumerate(g):
            want[r[0]] = sum(x[3] for x in g[max(0, i - n + 1) : i + 1])
    assert got == want


@pytest.mark.parametrize("seconds", [1, 60, 900, 5000, 100_000])
def test_trailing_mean(df, rows, seconds):
    out = ordered.trailing_mean(df, ["k"], "ts", "value", seconds)
    got = {r.id: (r.points, r.moving_average) for r in out.collect()}
    assert len(got) == len(rows)
    for g in by_key(rows).values():
        for r in g:
            frame = [x[3] for x in g if r[2] - timedelta(seconds=seconds) <= x[2] <= r[2]]
            assert got[r[0]] == (len(frame), pytest.approx(sum(frame) / len(frame)))


def test_trailing_mean_skips_null_values(spark):
    data = [("a", START, None), ("a", START + timedelta(seconds=1), 4.0), ("b", START, None)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, v double")
    got = {(r.k, r.ts): (r.moving_average, r.points) for r in ordered.trailing_mean(df, ["k"], "ts", "v", 60).collect()}
    assert got == {("a", START): (None, 1), ("a", START + timedelta(seconds=1)): (4.0, 2), ("b", START): (None, 1)}


def test_range_parts_split_a_hot_instant(spark):
    """One key and one instant hold every row; the parts are still even."""
    df = spark.range(8000).select("id", F.lit("k").alias("k"), F.lit(START).cast("timestamp_ntz").alias("ts"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = ordered.range_parts(df.repartition(4), ["k"], [F.col("ts"), F.col("id")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = cut.groupBy("_part").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
    rows = sorted(parts.collect(), key=lambda r: r._part)
    assert sum(r.n for r in rows) == 8000 and len(rows) == 8
    assert max(r.n for r in rows) < 2000
    assert all(a.high < b.low for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("width", [60, 900, 10**6])
def test_latest_before(df, rows, width):
    probes = df.filter("id % 3 = 0").select("id", "k", "ts")
    points = df.filter("id % 3 <> 0").select(F.col("id").alias("pid"), "k", "ts", "value")
    out = ordered.latest_before(probes, points, "k", "ts", F.col("value"), [F.col("pid")], "latest", width)
    got = {r.id: r.latest for r in out.collect()}
    want = {}
    for g in by_key(rows).values():
        pts = [r for r in g if r[0] % 3]
        times = [r[2] for r in pts]
        for r in g:
            if r[0] % 3 == 0:
                i = bisect_right(times, r[2])
                want[r[0]] = pts[i - 1][3] if i else None
    assert got == want


def test_latest_before_keeps_null_values(spark):
    probes = spark.createDataFrame([(1, "a", START + timedelta(hours=9))], "id long, k string, ts timestamp_ntz")
    points = spark.createDataFrame(
        [(1, "a", START, 5.0), (2, "a", START + timedelta(hours=1), None)],
        "pid long, k string, ts timestamp_ntz, value double",
    )
    out = ordered.latest_before(probes, points, "k", "ts", F.col("value"), [F.col("pid")], "latest", 60)
    assert out.collect()[0].latest is None


def test_runs(spark):
    df = spark.createDataFrame([("a", s) for s in (1, 2, 3, 7, 8, 20)] + [("b", 4)], "k string, s long")
    got = {(r.k, r.s): r.run for r in ordered.runs(df, ["k"], "s").collect()}
    assert got == {("a", 1): 1, ("a", 2): 1, ("a", 3): 1, ("a", 7): 2, ("a", 8): 2, ("a", 20): 3, ("b", 4): 1}


@pytest.mark.parametrize("accuracy", [20, 100, 10_000])
def test_exact_quantiles(spark, accuracy):
    rng = random.Random(3)
    data = [("hot", 7.0 if rng.random() < 0.33 else rng.random() * 100) for _ in range(4000)]
    data += [("b", float(i)) for i in range(7)] + [("b", None)]
    df = spark.createDataFrame(data, "k string, v double")
    probs = (0.0, 0.1, 0.5, 0.9, 0.99, 1.0)
    out = ordered.exact_quantiles(df, ["k"], "v", probs, accuracy)
    got = {(r.k, r.p): r.quantile for r in out.collect()}
    for k in ("hot", "b"):
        values = sorted(v for key, v in data if key == k and v is not None)
        for p in probs:
            assert got[(k, p)] == values[max(0, math.ceil(p * len(values)) - 1)]
