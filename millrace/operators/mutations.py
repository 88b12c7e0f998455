"""Update and delete as projections and filters over a table's rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import naive


def _matched(pred: Column) -> Column:
    return F.coalesce(pred, F.lit(False))


def update_where(df: DataFrame, pred: Column, sets: dict[str, Column]) -> DataFrame:
    """Set columns on every matching row; other rows pass unchanged."""
    hit = _matched(pred)
    changed = {}
    for name, value in sets.items():
        old = F.col(name) if name in df.columns else F.lit(None)
        changed[name] = F.when(hit, value).otherwise(old)
    return df.withColumns(changed)


def update_counts(df: DataFrame, pred: Column, sets: dict[str, Column]) -> DataFrame:
    """One row: rows matched, and rows an update would really change."""
    hit = _matched(pred)
    differs = F.lit(False)
    for name, value in sets.items():
        differs = differs | ~F.col(name).eqNullSafe(value)
    return df.agg(F.count_if(hit).alias("matched"), F.count_if(hit & differs).alias("modified"))


def delete_where(df: DataFrame, pred: Column) -> DataFrame:
    """Rows that do not match; a null predicate does not match."""
    return df.filter(~_matched(pred))


def touched(as_of: datetime) -> dict[str, Column]:
    """The ``updated_at`` stamp that goes with every change."""
    return {"updated_at": naive(as_of)}
