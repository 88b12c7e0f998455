"""Tables that cut lineage: written to the folder all executors share, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.workspace import SETTING, shared_folder


#: Rows that Spark sends to a Python worker at once; whole texts are long.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lower the session's batch size to ``BATCH_ROWS``, so that batches of texts fit beside the heap of an executor."""
    now = int(spark.conf.get(_BATCH_SETTING))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)


def staged(df: DataFrame, label: str, *by: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, in folders ``by`` columns; a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint; its files go once nothing refers to it, if the session cleans checkpoints."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None and not spark.conf.get(SETTING, None):
        context.setCheckpointDir(shared_folder(spark, "checkpoints"))
    return df.checkpoint()


def named(df: DataFrame, *columns: str) -> DataFrame:
    """Only ``columns``: further columns, whatever their names, do not meet those an operator adds."""
    return df.select(*[df[c] for c in columns])
