"""Table writes, files, reads and small reports."""

from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.conf import CLUSTER
from millrace.functions.rules import id_rules, quarantine
from millrace.operators import alerts, algorithms, health, mutations, reads
from millrace.operators import metrics as metric_ops
from millrace.operators import requests as request_ops
from millrace.operators.metrics import BROADCAST_RULES, Trigger
from millrace.sources import files, tables, unify
from millrace.sources.workspace import shared_folder

AS_OF = datetime(2024, 1, 31)


@pytest.fixture
def numbers(spark):
    return spark.range(100).select("id", (F.col("id") % 3).alias("g"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("created_at"))


def test_record_id_is_stable_and_distinct(spark, numbers):
    a = {r.id: r.rid for r in tables.with_record_id(numbers, ["id", "g"], "rid").collect()}
    b = {r.id: r.rid for r in tables.with_record_id(numbers.repartition(7), ["id", "g"], "rid").collect()}
    assert a == b and len(set(a.values())) == 100
    assert all(len(v) == 24 for v in a.values())


def test_record_id_separates_null_and_columns(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "x"), ("", "x")], "p string, q string")
    assert tables.with_record_id(df, ["p", "q"]).select("id").distinct().count() == 4


def test_files(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    (tmp_path / "x.csv").write_text("1,one\nnot a number,two\n3,three\n")
    good, bad = files.split_corrupt(files.read_files(spark, str(tmp_path / "x.csv"), "csv", schema).cache())
    assert sorted(r.a for r in good.collect()) == [1, 3]
    assert [r[files.CORRUPT] for r in bad.collect()] == ["not a number,two"]
    assert good.first().source_id.endswith("x.csv")
    (tmp_path / "x.json").write_text('{"a":1,"b":"x"}\n{"a":\n')
    good, bad = files.split_corrupt(files.read_files(spark, str(tmp_path / "x.json"), "json", schema).cache())
    assert (good.count(), bad.count()) == (1, 1)
    spark.createDataFrame([(5, "p")], schema).write.parquet(str(tmp_path / "p"))
    assert files.read_files(spark, str(tmp_path / "p"), "parquet", schema).first().a == 5
    with pytest.raises(ValueError):
        files.read_files(spark, str(tmp_path), "xml", schema)


def test_union_rejects_unknown_kind(spark, numbers):
    with pytest.raises(ValueError):
        unify.union_sources({"fax": numbers})


def test_compaction_writes_fewer_files(spark, numbers):
    path, target = shared_folder(spark, "t"), shared_folder(spark, "t")
    for _ in range(3):
        tables.append(numbers.repartition(4), path, ["g"])
    out = tables.compact(spark, path, target, "g", ["id"])
    assert out.count() == 300

    def parts(root):
        return sum(f.endswith(".parquet") for _, _, fs in os.walk(root) for f in fs)

    assert parts(path) >= 30 and parts(target) == 3
    assert tables.reconcile(spark.read.parquet(path), out).count() == 0


def test_layout_prunes_partitions(spark, numbers):
    path = shared_folder(spark, "t")
    tables.write_layout(numbers, path, ["g"], ["created_at"])
    plan = spark.read.parquet(path).filter("g = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(g" in plan


def test_bucketed_join_needs_no_shuffle(spark, numbers):
    spark.sql("create database if not exists layout_db location '" + shared_folder(spark, "db") + "'")
    for name in ("left_side", "right_side"):
        tables.write_bucketed(numbers, f"layout_db.{name}", shared_folder(spark, name), "id", ["id"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("layout_db.left_side").join(spark.table("layout_db.right_side"), "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop database layout_db cascade")


def test_update_rewrites_touched_partitions_only(spark, numbers):
    path = shared_folder(spark, "t")
    tables.write_layout(numbers, path, ["g"], ["id"])
    before = {f for _, _, fs in os.walk(f"{path}/g=0") for f in fs}
    tables.update_table(spark, path, "g", F.col("id") == 4, {"created_at": F.lit(None).cast("timestamp_ntz")})
    after = {f for _, _, fs in os.walk(f"{path}/g=0") for f in fs}
    assert before == after
    out = spark.read.parquet(path)
    assert out.count() == 100 and [r.id for r in out.filter("created_at is null").collect()] == [4]


def test_delete_everything(spark, numbers):
    path = shared_folder(spark, "t")
    tables.write_layout(numbers, path, ["g"], ["id"])
    tables.delete_from_table(spark, path, "g", F.col("g") == 2)
    assert {r.g for r in spark.read.parquet(path).select("g").distinct().collect()} == {0, 1}
    assert not os.path.exists(f"{path}/g=2")


def test_delete_where_null_predicate_keeps(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, v int")
    assert [r.id for r in mutations.delete_where(df, F.col("v") == 5).collect()] == [1]
    assert mutations.delete_where(df, F.lit(True)).count() == 0


def test_update_counts_null_safe(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 6)], "id int, v int")
    row = mutations.update_counts(df, F.col("id") < 3, {"v": F.lit(5)}).collect()[0]
    assert (row.matched, row.modified) == (2, 1)


def test_falsy_arguments_are_no_filter(spark, numbers):
    assert reads.equal_to(a=None, b="") is None
    assert reads.where(numbers, reads.equal_to(a=None)).count() == 100


def test_limit_zero_is_unlimited(numbers):
    assert reads.scan(numbers, limit=0).count() == 100
    assert reads.scan(numbers, sort=[("id", -1)], skip=95).count() == 5


@pytest.mark.parametrize("total,pages", [(0, 0), (20, 1), (21, 2), (100, 5)])
def test_page_info(numbers, total, pages):
    row = reads.page_info(numbers.filter(F.col("id") < total), 1, 20).collect()[0]
    assert (row.page, row.size, row.total, row.pages) == (1, 20, total, pages)


@pytest.mark.parametrize("number,size", [(0, 20), (1, 0), (1, 101)])
def test_page_bounds(numbers, number, size):
    with pytest.raises(ValueError):
        reads.page(numbers, number, size)


@pytest.mark.parametrize("hours", [0, 169])
def test_hour_bounds(numbers, hours):
    with pytest.raises(ValueError):
        reads.trailing(numbers, AS_OF, hours)


def test_trailing_is_inclusive_and_open_ended(spark):
    rows = [(1, datetime(2024, 1, 30, 23)), (2, datetime(2024, 1, 30, 22, 59, 59)), (3, datetime(2025, 1, 1))]
    df = spark.createDataFrame(rows, "id int, created_at timestamp_ntz")
    assert sorted(r.id for r in reads.trailing(df, AS_OF, 1).collect()) == [1, 3]


def test_keyset_pages_cover_everything(numbers):
    seen, last = [], None
    while True:
        rows = reads.page_after(numbers, last, 30).collect()
        if not rows:
            break
        seen += [r.id for r in rows]
        last = (rows[-1].created_at, rows[-1].id)
    assert seen == list(range(99, -1, -1))


def test_deep_page_equals_top_k(numbers, monkeypatch):
    near = [r.id for r in reads.page(numbers, 4, 10).collect()]
    monkeypatch.setattr(reads, "TOP_ROWS", 5)
    assert [r.id for r in reads.page(numbers, 4, 10).collect()] == near == list(range(69, 59, -1))
    assert reads.page(numbers, 11, 10).count() == 0
    assert reads.page(numbers.filter("id < 0"), 2, 10).count() == 0
    instant = numbers.withColumn("created_at", F.lit(AS_OF).cast("timestamp_ntz"))
    assert [r.id for r in reads.page(instant, 4, 10).collect()] == near
    mixed = numbers.withColumn("created_at", F.when(F.col("id") < 50, F.lit(AS_OF).cast("timestamp_ntz")).otherwise(F.col("created_at")))
    want = [r.id for r in sorted(mixed.collect(), key=lambda r: (r.created_at, r.id), reverse=True)]
    got = [r.id for n in range(1, 11) for r in reads.page(mixed, n, 10).collect()]
    assert got == want


def test_field_absent(spark):
    df = spark.createDataFrame([(1, '{"x": null}'), (2, "{}"), (3, '{"x": 1}')], "id int, doc string")
    assert [r.id for r in alerts.field_absent(df, "doc", "x").collect()] == [2]


def test_acknowledge(spark):
    df = spark.createDataFrame(
        [(1, None, None, None), (2, None, None, None)],
        "id long, acknowledged_at timestamp_ntz, acknowledged_by string, resolved_at timestamp_ntz",
    )
    ids = spark.createDataFrame([(1,)], "alert_id long")
    out = {r.id: r for r in alerts.acknowledge(df, ids, "ann", AS_OF).collect()}
    assert (out[1].acknowledged_by, out[1].acknowledged_at, out[1].updated_at) == ("ann", AS_OF, AS_OF)
    assert out[2].acknowledged_by is None and out[2].updated_at is None and out[1].resolved_at is None


@pytest.mark.parametrize(
    "database,kafka,overall,ready",
    [("healthy", "healthy", "healthy", True), ("unhealthy", "unhealthy", "unhealthy", False),
     ("healthy", "unhealthy", "degraded", False), ("degraded", "healthy", "healthy", True)],
)
def test_health(spark, database, kafka, overall, ready):
    rows = [(1, "database", "unhealthy", 0), (2, "database", database, 1), (3, "kafka", "unhealthy", 0), (4, "kafka", kafka, 1)]
    df = spark.createDataFrame(rows, "id int, service string, status string, ts int")
    assert health.health_overall(df).collect()[0].overall_status == overall
    assert health.health_ready(df).collect()[0].ready is ready
    assert health.health_ready(df.filter("service = 'kafka'")).collect()[0].ready is False


def test_app_metrics_of_an_empty_window(spark):
    log = spark.createDataFrame([], "ts timestamp_ntz, client_id string, process_time_ms double, status_code int")
    messages = spark.createDataFrame([], "ts timestamp_ntz, ok boolean")
    row = request_ops.app_metrics(log, messages, AS_OF).collect()[0]
    assert tuple(row) == (0, 0.0, 0.0, 0.0, 0, 0, 0)


def test_sustained_breach(spark):
    def point(minute, value, metric="cpu_usage_percent"):
        return (metric, datetime(2024, 1, 1, 0, minute, 30), value)

    rows = [point(m, 90.0) for m in (0, 1, 2, 3, 4, 5)] + [point(6, 10.0)] + [point(m, 90.0) for m in (7, 8, 10, 11)]
    rows += [point(3, 5000.0, "queue_size")]
    df = spark.createDataFrame(rows, "metric string, ts timestamp_ntz, value double")
    got = [(r.metric, r.started_at, r.ended_at, r.length) for r in metric_ops.sustained_breach(df, metric_ops.DEFAULT_TRIGGERS).collect()]
    assert sorted(got) == [
        ("cpu_usage_percent", datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 6), 6),
        ("queue_size", datetime(2024, 1, 1, 0, 3), datetime(2024, 1, 1, 0, 4), 1),
    ]


def test_trigger_table(spark):
    def plan(n):
        rules = metric_ops.trigger_table(spark, [Trigger(f"m{i}", ">", 1.0) for i in range(n)])
        return rules._jdf.queryExecution().analyzed().toString()

    assert "broadcast" in plan(3) and "broadcast" not in plan(BROADCAST_RULES + 1)  # any number of rules is taken
    rules = metric_ops.trigger_table(spark, spark.createDataFrame([("m", ">", 1.0, 1), ("m", "~", 1.0, 1)], "metric string, op string, threshold double, steps long"))
    assert [r.op for r in rules.collect()] == [">"]
    with pytest.raises(ValueError):
        metric_ops.trigger_table(spark, [Trigger("m", "~", 1.0)])


def test_system_rollup(spark):
    rows = [
        ("a", 10.0, 1.0, 2.0, {"rx": 5, "tx": 1}, {}, [1.0, 2.0, 3.0]),
        ("b", 30.0, 3.0, 4.0, {"rx": 7}, {"read": 2}, [3.0, 4.0, 5.0]),
    ]
    df = spark.createDataFrame(
        rows,
        "host string, cpu_usage_percent double, memory_usage_percent double, disk_usage_percent double, "
        "network_io_bytes map<string,long>, disk_io_bytes map<string,long>, load_average array<double>",
    )
    got = {(r.measure, r["item"]): r.value for r in metric_ops.system_rollup(df).collect()}
    assert got[("avg_cpu_usage_percent", None)] == 20.0 and got[("max_cpu_usage_percent", None)] == 30.0
    assert got[("sum_network_io_bytes", "rx")] == 12.0 and got[("sum_disk_io_bytes", "read")] == 2.0
    assert got[("avg_load_average", "2")] == 4.0


def test_algorithms(spark, numbers):
    with pytest.raises(ValueError):
        algorithms.run(numbers, {"algorithm": "nope"})
    rows = numbers.withColumn("source_id", F.lit("s")).withColumn("value", F.col("id").cast("double"))
    out = algorithms.run(rows, {"algorithm": "moving_average", "window_size": 2})
    assert {r.id: r.moving_average for r in out.collect()}[10] == 9.5
    out = algorithms.run(rows, {"algorithm": "moving_average", "window_seconds": 120})
    assert {r.id: r.moving_average for r in out.collect()}[10] == 9.0


def test_extract_can_be_repeated(spark, numbers):
    rows = numbers.withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    root = shared_folder(spark, "x")
    assert tables.last_mark(spark, root) is None
    middle, end = datetime(1970, 1, 1, 0, 49), datetime(1970, 1, 2)
    for _ in range(2):
        tables.snapshot({"n": rows}, root, end)  # a run that died before its mark
    full = tables.extract(spark, {"n": rows}, root, middle)
    assert spark.read.parquet(f"{full}/n").count() == 50 and tables.last_mark(spark, root) == middle
    rest = tables.extract(spark, {"n": rows}, root, end)
    assert spark.read.parquet(f"{rest}/n").count() == 50 and tables.last_mark(spark, root) == end


def test_append_bounds_files(spark, numbers):
    path = shared_folder(spark, "t")
    tables.append(numbers.coalesce(1), path, max_records=30)
    assert sum(f.endswith(".parquet") for f in os.listdir(path)) == 4
    assert dict(tables.text_ids(numbers).dtypes)["id"] == "string"


def test_id_rules(spark):
    df = spark.createDataFrame([("0" * 24,), ("nope",), (None,)], "alert_id string")
    good, bad = quarantine(df, id_rules("alert_id"))
    assert good.count() == 1 and bad.count() == 2


def test_extracts_bury_deleted_rows(spark):
    schema = "id long, v string, created_at timestamp_ntz, updated_at timestamp_ntz"
    day = lambda d: datetime(2024, 1, d)
    root = shared_folder(spark, "x")

    def run(rows, as_of):
        tables.extract(spark, {"t": spark.createDataFrame(rows, schema)}, root, as_of, {"t": "id"})
        return sorted((r.id, r.v) for r in tables.restore_chain(spark, root, "t", "id").collect())

    assert run([(1, "a", day(1), None), (2, "b", day(1), None)], day(2)) == [(1, "a"), (2, "b")]
    assert run([(2, "b2", day(1), day(3)), (3, "c", day(3), None)], day(4)) == [(2, "b2"), (3, "c")]
    assert run([(1, "back", day(5), None), (2, "b2", day(1), day(3))], day(6)) == [(1, "back"), (2, "b2")]
    assert run([], day(7)) == []


def test_reconcile_moves_only_rows_of_differing_buckets(spark):
    rows = spark.range(5000).select("id", (F.col("id") % 7).cast("string").alias("v"))
    copy = rows.filter("id <> 17").union(rows.filter("id = 400")).withColumn("v", F.when(F.col("id") == 9, None).otherwise(F.col("v")))
    got = {(r.id, r.v, r.side, r.n_rows) for r in tables.reconcile(rows, copy).collect()}
    assert got == {(17, "3", "source_only", 1), (9, "2", "source_only", 1), (9, None, "copy_only", 1), (400, "1", "copy_only", 1)}
    assert tables.reconcile_counts(rows, copy).first() == (5000, 5000, 2, 2)
    assert tables.reconcile(rows, rows).count() == 0
    found = tables.reconcile(rows, copy)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    # What the semi join lets through is all that the last shuffle gets.
    moved = rows.withColumn("_b", F.pmod(F.xxhash64("id", "v"), F.lit(tables.CHECK_BUCKETS)))
    gone = [r._b for r in moved.filter("id in (9, 17, 400)").collect()]
    assert moved.filter(F.col("_b").isin(gone)).count() < 20


@pytest.mark.parametrize("slide,window", [("1 minute", "5 minutes"), ("2 minutes", "2 minutes")])
def test_sketched_clients_are_near_the_exact_ones(spark, slide, window):
    log = spark.range(60_000).select(
        F.timestamp_seconds(1_700_000_000 + F.col("id") % 1200).cast("timestamp_ntz").alias("ts"),
        (F.pmod(F.xxhash64("id"), F.lit(9000))).cast("string").alias("client_id"),
    )
    exact = {r.window_start: r.clients for r in request_ops.rolling_clients(log, window, slide).collect()}
    near = {r.window_start: r.clients for r in request_ops.rolling_clients(log, window, slide, approximate=True).collect()}
    assert exact.keys() == near.keys() and max(exact.values()) > 3000
    assert all(abs(near[w] - n) <= max(2, 0.05 * n) for w, n in exact.items())


def rows_scanned(df):
    """Rows that the file scan gave out, after row groups were skipped."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    metrics = leaves.apply(0).metrics()
    return metrics.get("numOutputRows").get().value()


def test_zorder_skips_row_groups_on_every_column(spark):
    n = 40_000
    rows = spark.range(n).select(
        "id", F.concat(F.lit("job"), F.pmod(F.xxhash64("id"), F.lit(10**9)).cast("string")).alias("job_id"),
        F.element_at(F.split(F.lit("completed,failed,pending,processing"), ","), (F.pmod(F.xxhash64("id"), F.lit(4)) + 1).cast("int")).alias("status"),
        F.timestamp_seconds(1_700_000_000 + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_000))).alias("at"),
    )
    path = shared_folder(spark, "z")
    spark.conf.set("spark.sql.parquet.outputTimestampType", CLUSTER["spark.sql.parquet.outputTimestampType"])
    try:
        tables.write_zordered(rows, path, ["status", "at"], {"job_id": 1000}, max_records=1000)
    finally:
        spark.conf.unset("spark.sql.parquet.outputTimestampType")
    table = spark.read.parquet(path)
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, rows.collect()))
    begin, end = (F.lit(day).cast("timestamp") for day in ("2023-11-20", "2023-11-21"))
    some_time = (F.col("at") >= begin) & (F.col("at") < end)
    by_status, by_time = table.filter("status = 'failed'"), table.filter(some_time)
    both = table.filter(some_time & (F.col("status") == "failed"))
    assert by_status.count() > 9000 and rows_scanned(by_status) < n / 2
    assert by_time.count() > 3000 and rows_scanned(by_time) < n / 2
    assert both.count() > 800 and rows_scanned(both) < n / 8
    one = rows.filter("id = 777").first().job_id
    found = table.filter(F.col("job_id") == one)
    assert found.count() == 1 and rows_scanned(found) < n / 4  # by the Bloom filters: ids are spread over all files


def test_zorder_of_odd_tables(spark):
    rows = spark.createDataFrame([(1, None, 2.0), (2, "a", None), (3, "a", float("nan"))], "id long, k string, v double")
    for df in (rows, rows.limit(0)):
        path = shared_folder(spark, "z")
        tables.write_zordered(df, path, ["k", "v"])
        assert sorted(r.id for r in spark.read.schema(rows.schema).parquet(path).collect()) == sorted(r.id for r in df.collect())
