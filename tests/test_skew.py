"""A key that holds a third of the rows is split by adaptive execution."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.operators import lineage

SETTINGS = {
    # The thresholds of a cluster, scaled down to test size.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
}


@pytest.fixture
def skewed(spark):
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    n = 60_000
    ingestion = spark.range(20_000).select(
        "id", F.lit("api").alias("source_type"), F.lit("s").alias("source_id"), stamp.alias("created_at")
    )
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 25_000)
    jobs = spark.range(n).repartition(8).select(
        F.concat(F.lit("job-"), F.col("id")).alias("job_id"), F.lit("n").alias("job_name"),
        key.alias("input_data_id"), F.lit("completed").alias("status"), stamp.alias("created_at"),
        stamp.alias("started_at"), stamp.alias("completed_at"),
    )
    hot = F.when(F.col("id") % 3 == 0, "job-5").otherwise(F.concat(F.lit("job-"), F.col("id") * 2))
    outputs = spark.range(n).repartition(8).select(
        "id", hot.alias("job_id"), F.lit("t").alias("output_type"), stamp.alias("created_at")
    )
    yield ingestion, jobs, outputs
    for k in SETTINGS:
        spark.conf.unset(k)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_input_is_split(skewed):
    ingestion, jobs, _ = skewed
    for how in ("inner", "left"):
        assert "skew=true" in final_plan(lineage.jobs_with_input(jobs, ingestion, how))


def test_hot_job_is_split(skewed):
    _, jobs, outputs = skewed
    assert "skew=true" in final_plan(lineage.outputs_with_job(outputs, jobs, "left"))
    assert "skew=true" in final_plan(lineage.orphan_outputs(outputs, jobs))


def test_hot_keys_in_the_whole_lineage(skewed):
    ingestion, jobs, outputs = skewed
    df = lineage.lineage(ingestion, jobs, outputs)
    assert "skew=true" in final_plan(df)
    # Every input, every job with an input, every output of such a job; nothing twice.
    plain = ingestion.withColumnRenamed("id", "i").join(jobs, F.col("i") == F.col("input_data_id"), "left")
    plain = plain.join(outputs.withColumnRenamed("id", "o").select("o", "job_id"), "job_id", "left")
    assert df.count() == plain.count()
    assert df.agg(F.sum(F.xxhash64("input_id", "job_id", "output_id") % 1000)).collect() == plain.agg(
        F.sum(F.xxhash64("i", "job_id", "o") % 1000)
    ).collect()
