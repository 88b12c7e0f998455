"""Validation rules on inline rows."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from millrace.functions.rules import (
    in_range,
    matches,
    non_empty,
    one_of,
    quarantine,
    required,
    rules_for,
    validate,
    validate_documents,
)
from millrace.schemas import (
    ALERT,
    APPLICATION_METRICS,
    ID_PATTERN,
    INGESTION,
    JOB,
    METRIC,
    METRIC_NAME_PATTERN,
    OUTPUT,
    RECORDS,
    SOURCE_TYPES,
    SYSTEM_METRICS,
)

NAN, INF = float("nan"), float("inf")


def verdicts(spark, values, kind, rule):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = validate(df, [rule]).orderBy("i").collect()
    return [not r.validation_errors for r in rows]


def test_required(spark):
    assert verdicts(spark, ["x", "", None], "string", required("v", F.col("v"))) == [True, True, False]


def test_enum(spark):
    rule = one_of("v", F.col("v"), SOURCE_TYPES)
    values = [*SOURCE_TYPES, "Kafka", "", None]
    assert verdicts(spark, values, "string", rule) == [True] * len(SOURCE_TYPES) + [False, False, True]


def test_range(spark):
    rule = in_range("v", F.col("v"), 0.0, 100.0, True)
    values = [0.0, 100.0, -0.1, 100.1, None, NAN, INF, -INF]
    assert verdicts(spark, values, "double", rule) == [True, True, False, False, True, False, False, False]


def test_lower_bound_rejects_nan(spark):
    rule = in_range("v", F.col("v"), 0.0, None, True)
    assert verdicts(spark, [NAN, INF, 0.0], "double", rule) == [False, True, True]


def test_payload(spark):
    rule = non_empty("v", F.col("v"))
    assert verdicts(spark, ["{}", '{"a":null}', "[]", "nonsense"], "string", rule) == [False, True, False, False]


def test_metric_name(spark):
    rule = matches("v", F.col("v"), METRIC_NAME_PATTERN)
    values = ["http_requests_total", "a:b", "é:1", "__", "a-b", ""]
    assert verdicts(spark, values, "string", rule) == [True, True, True, False, False, False]


def test_id(spark):
    rule = matches("v", F.col("v"), ID_PATTERN)
    assert verdicts(spark, ["0" * 24, "aF" * 12, "0" * 23, "g" * 24], "string", rule) == [True, True, False, False]


def check(spark, record, *docs):
    rows = [(i, d if isinstance(d, str) or d is None else json.dumps(d)) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "i int, doc string")
    return validate_documents(df, "doc", record).orderBy("i").collect()


def test_ingestion_documents(spark):
    good = {"source_type": "api", "source_id": "s", "data": {"temperature": 23.5}}
    rows = check(
        spark, INGESTION, good,
        {**good, "data": {}},
        {k: v for k, v in good.items() if k != "data"},
        {**good, "data": None},
        {**good, "extra": 1},
        {**good, "size_bytes": -1},
        {**good, "partition": "many"},
        {**good, "metadata": None},
        {**good, "partition": "3", "offset": 7},
        "not json",
        None,
    )
    errors = [sorted(r.validation_errors) for r in rows]
    assert errors[0] == []
    assert errors[1] == ["data:payload"]
    assert errors[2] == ["data:required"]
    assert errors[3] == ["data:required"]
    assert errors[4] == ["document:unknown_fields"]
    assert errors[5] == ["size_bytes:range"]
    assert errors[6] == ["partition:type"]
    assert errors[7] == []
    assert errors[8] == [] and rows[8].partition == 3 and rows[8].offset == 7
    assert "document:json" in errors[9] and "document:json" in errors[10]
    assert json.loads(rows[0].data) == {"temperature": 23.5}
    assert rows[0].metadata == "{}" and rows[7].metadata is None


def test_job_defaults(spark):
    base = {"job_id": "j", "job_name": "n", "input_data_id": "i"}
    plain, null, bad = check(
        spark, JOB, base, {**base, "status": None, "processing_config": None}, {**base, "progress_percentage": 101}
    )
    assert (plain.status, plain.progress_percentage, plain.retry_count, plain.max_retries) == ("pending", 0.0, 0, 3)
    assert plain.processing_config == "{}" and plain.validation_errors == []
    assert sorted(null.validation_errors) == ["processing_config:required", "status:required"]
    assert bad.validation_errors == ["progress_percentage:range"]


def test_collections(spark):
    metric, = check(spark, METRIC, {"name": "a_b", "type": "gauge", "value": 1, "labels": {"h": "x"}})
    assert metric.labels == {"h": "x"} and metric.validation_errors == []
    plain, = check(spark, METRIC, {"name": "a_b", "type": "gauge", "value": 1})
    assert plain.labels == {}
    output, = check(
        spark, OUTPUT, {"job_id": "j", "output_type": "t", "destination": "d", "data": {"a": 1}, "validation_errors": ["e"]}
    )
    assert output.validation_errors == ["e"]
    system, = check(
        spark, SYSTEM_METRICS,
        {"cpu_usage_percent": 1, "memory_usage_percent": 2, "disk_usage_percent": 101,
         "network_io_bytes": {"rx": 5}, "load_average": [1.5, 2]},
    )
    assert system.network_io_bytes == {"rx": 5} and system.load_average == [1.5, 2.0]
    assert system.validation_errors == ["disk_usage_percent:range"]


def test_other_records(spark):
    alert, = check(spark, ALERT, {"name": "n", "severity": "fatal", "message": "m", "service": "api"})
    assert alert.validation_errors == ["severity:enum"]
    app, = check(spark, APPLICATION_METRICS, {"active_connections": -1})
    assert "active_connections:range" in app.validation_errors
    assert "error_rate_percent:required" in app.validation_errors


def test_quarantine_keeps_every_row(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "i int, v double")
    good, bad = quarantine(df, [in_range("v", F.col("v"), 0, None, True), required("v", F.col("v"))])
    assert [r.i for r in good.collect()] == [1]
    assert {r.i: r.validation_errors for r in bad.collect()} == {2: ["v:range"], 3: ["v:required"]}


@pytest.mark.parametrize("record", list(RECORDS.values()), ids=list(RECORDS))
def test_rules_cover_the_record(record):
    rules = {r.field for r in rules_for(record)}
    wanted = {f.name for f in record.fields if f.required or f.one_of or f.low is not None or f.pattern}
    assert rules == wanted
