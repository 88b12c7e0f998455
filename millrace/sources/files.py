"""Batch file uploads (JSON lines, CSV, Parquet) as ingestion records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_files(
    spark: SparkSession, path: str, file_format: str, schema: T.StructType, **options: str
) -> DataFrame:
    """Read files with a declared schema; adds ``source_id`` (the file's path).

    Lines that do not parse are kept in ``_corrupt_record`` instead of failing
    the job.  No schema inference, so the files are read once.
    """
    reader = spark.read.options(**options)
    if file_format in ("json", "csv"):
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    elif file_format != "parquet":
        raise ValueError(f"unsupported file format: {file_format}")
    df = reader.schema(schema).format(file_format).load(path)
    if file_format == "parquet":
        df = df.withColumn(CORRUPT, F.lit(None).cast("string"))
    return df.withColumn("source_id", F.col("_metadata.file_path"))


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, raw lines that did not)."""
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.filter(F.col(CORRUPT).isNotNull()).select("source_id", CORRUPT)
    return good, bad
