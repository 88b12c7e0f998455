"""Column helpers shared by the operators.  All stay inside JVM codegen."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def naive(value: datetime | str) -> Column:
    """A ``timestamp_ntz`` literal from a naive datetime or its text."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch; needs the session zone to be UTC."""
    return F.unix_micros(col(ts).cast("timestamp"))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Fractional seconds from ``start`` to ``end``."""
    return (micros(end) - micros(start)) / F.lit(1_000_000)


def minus(ts: Column, *, hours: int = 0, minutes: int = 0, seconds: int = 0, days: int = 0) -> Column:
    return ts - F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes), F.lit(float(seconds)))


def plus(ts: Column, *, hours: int = 0, minutes: int = 0, seconds: int = 0, days: int = 0) -> Column:
    return ts + F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes), F.lit(float(seconds)))


def time_bucket(ts: Column | str, seconds: int) -> Column:
    """Number of the ``seconds``-wide bucket that holds ``ts``."""
    return F.floor(micros(ts) / F.lit(seconds * 1_000_000)).cast("long")


def iso_text(ts: Column | str) -> Column:
    """ISO-8601 text with six fraction digits."""
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def epoch_seconds(ts: Column | str) -> Column:
    """Whole epoch seconds, truncated."""
    return F.floor(micros(ts) / F.lit(1_000_000)).cast("long")


def round_ms(seconds: Column | str) -> Column:
    """Seconds as milliseconds with two decimals."""
    return F.round(col(seconds) * 1000, 2)


def or_default(value: Column | str, default: Any) -> Column:
    """``default`` where the text is null or empty."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(col(value), F.lit("")), fallback)


def has_key(doc: Column | str, name: str) -> Column:
    """True where the JSON object has the key, even with a null value."""
    return F.coalesce(F.array_contains(F.json_object_keys(col(doc)), name), F.lit(False))


def is_filled_object(doc: Column | str) -> Column:
    """True where the text is a JSON object with at least one key."""
    return F.coalesce(F.size(F.json_object_keys(col(doc))) > 0, F.lit(False))


def page_count(total: Column, size: int) -> Column:
    """Number of pages for ``total`` rows; 0 when there are none."""
    return F.ceil(total / F.lit(size)).cast("long")


def client_consumer_id(client: Column | str, consumer: Column | str) -> Column:
    return F.concat_ws("-", col(client), col(consumer))


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is computed exactly once per row.

    A filter on a plain computed column is pushed below the projection and
    takes a copy of the whole expression along, once per reference; a parse
    would then run many times for each row.  Nothing is copied through the
    output of a generator, and filters on other columns still pass it.
    """
    kept = [c for c in df.columns if c != name]
    return df.select(*kept, F.explode_outer(F.array(value)).alias(name))
