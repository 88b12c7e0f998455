"""Filtered, sorted and paged reads of a collection."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.ordered import seek_key
from millrace.functions.scalars import minus, naive, page_count
from millrace.schemas import DEFAULT_PAGE_SIZE, MAX_PAGE_SIZE, MAX_REQUEST_BYTES, MAX_WINDOW_HOURS, METRIC_READ_CAP

# Rows before a page that are ordered with it; more are skipped by counting.
TOP_ROWS = 10_000


def equal_to(**values: Any) -> Column | None:
    """Conjunction of equalities; a missing or empty argument is no filter."""
    pred = None
    for name, value in values.items():
        if not value:
            continue
        term = F.col(name) == F.lit(value)
        pred = term if pred is None else pred & term
    return pred


def where(df: DataFrame, pred: Column | None) -> DataFrame:
    return df if pred is None else df.filter(pred)


def sort_columns(sort: Sequence[tuple[str, int]], tie: str = "id") -> list[Column]:
    """(field, 1 | -1) pairs as order columns; ``tie`` makes the order total."""
    columns = [F.desc(name) if step < 0 else F.asc(name) for name, step in sort]
    if tie not in {name for name, _ in sort}:
        last = sort[-1][1] if sort else 1
        columns.append(F.desc(tie) if last < 0 else F.asc(tie))
    return columns


def scan(
    df: DataFrame,
    pred: Column | None = None,
    sort: Sequence[tuple[str, int]] | None = None,
    skip: int = 0,
    limit: int | None = None,
    tie: str = "id",
) -> DataFrame:
    """Filter, then sort, skip and limit.  ``limit`` 0 or None is unlimited."""
    out = where(df, pred)
    if sort:
        out = out.orderBy(*sort_columns(sort, tie))
    if skip > 0:
        out = out.offset(skip)
    if limit:
        out = out.limit(limit)
    return out


def lookup(df: DataFrame, key: str, value: Any) -> DataFrame:
    """The first row with ``key == value`` (oldest, then lowest id), or none."""
    return df.filter(F.col(key) == F.lit(value)).orderBy("created_at", "id").limit(1)


def count_where(df: DataFrame, pred: Column | None = None) -> DataFrame:
    return where(df, pred).agg(F.count(F.lit(1)).alias("n"))


def check_page(number: int, size: int) -> None:
    if number < 1:
        raise ValueError("page must be at least 1")
    if not 1 <= size <= MAX_PAGE_SIZE:
        raise ValueError(f"size must be between 1 and {MAX_PAGE_SIZE}")


def check_hours(hours: int) -> None:
    if not 1 <= hours <= MAX_WINDOW_HOURS:
        raise ValueError(f"hours must be between 1 and {MAX_WINDOW_HOURS}")


def page(
    df: DataFrame,
    number: int = 1,
    size: int = DEFAULT_PAGE_SIZE,
    pred: Column | None = None,
    ts: str = "created_at",
    tie: str = "id",
) -> DataFrame:
    """One page, newest first, rows without a time last; ``tie`` may be of any type that has an order.

    A page is a top-k of the rows up to its end.  So that the k stays small
    however deep the page lies, its place is first narrowed down by counting.
    """
    check_page(number, size)
    rows, rest = seek_key(where(df, pred), ts, tie, (number - 1) * size, size, TOP_ROWS)
    return rows.orderBy(F.desc_nulls_last(ts), F.desc_nulls_last(tie)).offset(rest).limit(size)


def page_after(
    df: DataFrame,
    last: tuple[datetime, Any] | None,
    size: int = DEFAULT_PAGE_SIZE,
    pred: Column | None = None,
    ts: str = "created_at",
    tie: str = "id",
) -> DataFrame:
    """Keyset page: the rows after the ``(ts, tie)`` of the last row seen, in the order of ``page``.

    Rows without a time come last; after one of them, its ``ts`` is None.  The
    bound on ``ts`` reaches the file scan, so a deep page costs no more than
    the first.
    """
    check_page(1, size)
    rows = where(df, pred)
    if last is not None:
        at = F.col(ts)
        behind = F.lit(False) if last[1] is None else (F.col(tie) < F.lit(last[1])) | F.col(tie).isNull()
        if last[0] is None:
            rows = rows.filter(at.isNull() & behind)
        else:
            seen = naive(last[0])
            rows = rows.filter((at <= seen) | at.isNull()).filter((at < seen) | at.isNull() | behind)
    return rows.orderBy(F.desc_nulls_last(ts), F.desc_nulls_last(tie)).limit(size)


def page_info(
    df: DataFrame, number: int = 1, size: int = DEFAULT_PAGE_SIZE, pred: Column | None = None
) -> DataFrame:
    """One row: page, size, total, pages."""
    check_page(number, size)
    return (
        where(df, pred)
        .agg(F.count(F.lit(1)).alias("total"))
        .select(
            F.lit(number).cast("long").alias("page"),
            F.lit(size).cast("long").alias("size"),
            "total",
            page_count(F.col("total"), size).alias("pages"),
        )
    )


def trailing(df: DataFrame, as_of: datetime, hours: int = 1, ts: str = "created_at") -> DataFrame:
    """Rows of the last ``hours``; inclusive, and without an upper bound."""
    check_hours(hours)
    return df.filter(F.col(ts) >= minus(naive(as_of), hours=hours))


def recent_metrics(
    df: DataFrame, as_of: datetime, hours: int = 1, name: str | None = None, cap: int = METRIC_READ_CAP
) -> DataFrame:
    """Newest metric points of a trailing window, at most ``cap``."""
    rows = where(trailing(df, as_of, hours), equal_to(name=name))
    return scan(rows, sort=[("created_at", -1)], limit=cap)


def split_oversize(
    df: DataFrame, length: str, max_bytes: int = MAX_REQUEST_BYTES
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with both sizes); an absent length is accepted."""
    fits = F.col(length).isNull() | (F.col(length) <= max_bytes)
    rejected = df.filter(~fits).withColumns(
        {"max_size_bytes": F.lit(max_bytes).cast("long"), "received_size_bytes": F.col(length).cast("long")}
    )
    return df.filter(fits), rejected
