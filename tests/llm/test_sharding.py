"""Range shards against a plain sort."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from cases import empty, odd, prose

from millrace.llm import sharding


def plain(rows, shards):
    keyed = sorted(
        (hashlib.md5((t or "").encode()).hexdigest(), d is not None, d or 0, len((t or "").encode()) + 1, t or "") for d, t in rows
    )
    total, at, out, slots = sum(k[3] for k in keyed), 0, [], {}
    for _, some, d, size, text in keyed:
        shard = min(shards - 1, (2 * at + size) * shards // (2 * total))
        slots[shard] = slots.get(shard, -1) + 1
        out.append((d if some else None, size, zlib.crc32(text.encode()), shard, slots[shard]))
        at += size
    return out


def same(df, shards=8):
    got = [tuple(r) for r in sharding.shard_by_bytes(df, shards).collect()]
    key = lambda r: (r[0] is not None, r)
    blank = lambda rows: sorted(((-1 if r[0] is None else r[0], *r[1:]) for r in rows))
    assert blank(got) == blank(plain([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], shards)), key


def test_odd_documents(spark):
    same(odd(spark))


def test_more_shards_than_rows(spark):
    same(odd(spark).limit(3), 50)


def test_empty_table(spark):
    assert sharding.shard_by_bytes(empty(spark), 8).collect() == []


def test_hot_text_is_divided(spark, monkeypatch):
    """A third of the rows are copies; small ranges force subdivision."""
    monkeypatch.setattr(sharding, "SAMPLES_PER_RANGE", 4)
    rows = [(i, "copy " * 20 if i % 3 == 0 else prose(i, 20 + i % 40)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(df)
    sums = [r[1] for r in sharding.shard_by_bytes(df, 8).groupBy("shard").agg({"size": "sum"}).collect()]
    assert len(sums) == 8 and max(sums) - min(sums) <= 2 * 400


def test_text_ids(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SAMPLES_PER_RANGE", 4)
    rows = [(f'id "{i % 700}"', "copy " * 20 if i % 3 == 0 else prose(i, 20 + i % 40)) for i in range(1000)] + [(None, "copy " * 20), ("", None)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r.doc_id: r for r in sharding.shard_by_bytes(df, 8).collect()}
    assert set(got) == {r[0] for r in rows}
    sums = [r[1] for r in sharding.shard_by_bytes(df, 8).groupBy("shard").agg({"size": "sum"}).collect()]
    assert len(sums) == 8 and max(sums) - min(sums) <= 2 * 400
    slots = sharding.shard_by_bytes(df, 8).groupBy("shard").agg({"slot": "max", "*": "count"}).collect()
    assert all(r["max(slot)"] + 1 == r["count(1)"] for r in slots)


def test_no_python_in_the_plan(spark):
    plan = sharding.shard_by_bytes(odd(spark), 8)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8])
def test_binary_search(spark, n):
    bounds = [{"digest": f"{i:02d}", "id": 5} for i in range(n)]
    from pyspark.sql import functions as F

    keys = [("", None), ("00", 5), ("00", 6), ("03", None), ("06", 9), ("zz", 1)]
    df = spark.createDataFrame(keys, "digest string, id long")
    got = [r[0] for r in df.select(sharding._place(F.struct("digest", "id"), bounds)).collect()]
    low = lambda d, i: (d, i is not None, i or 0)
    assert got == [sum(low(b["digest"], b["id"]) < low(*k) for b in bounds) for k in keys]
