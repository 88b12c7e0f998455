"""All source kinds as one ingestion table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.schemas import SOURCE_TYPES


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Union per-source projections by column name; absent columns become null.

    The dictionary key is the source type.
    """
    unknown = set(sources) - set(SOURCE_TYPES)
    if unknown:
        raise ValueError(f"unknown source types: {sorted(unknown)}")
    tagged = [df.withColumn("source_type", F.lit(kind)) for kind, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
