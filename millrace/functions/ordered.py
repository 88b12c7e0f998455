"""Ordered operations that never put one key's whole history into one task.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task, so a
key with a third of the table decides the run time.  These helpers cut the
history of a key into buckets of its order, work inside ``(key, bucket)``, and
bring the little that crosses a bucket border (a count, a last value, a few
rows) along separately.  Only one summary row per ``(key, bucket)`` is ever
ordered by key alone.

Buckets come in two kinds:

* time buckets cost nothing extra and suit data whose times are spread out;
* ``range_parts`` cuts by row count along the full order, so that even a group
  of rows with one key and one instant is split.  The bounds are drawn once and
  are literals, because a cut must not move when a lost task is repeated.

Where only instants matter (as-of joins, time frames), rows of one key and
instant are combined before they are moved, so copies cannot fill a bucket.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.scalars import micros, naive, time_bucket
from millrace.sources.workspace import shared_folder

# 15 minutes: 35,000 summary rows per key and year, and a key that receives
# 10,000 rows a second still has only 9 million rows in one bucket.
BUCKET_SECONDS = 900

# Slices of a quantile's bracket (see ``exact_quantiles``).
SLICES = 4096

_BUCKET = "_bucket"


def _attach(rows: DataFrame, summary: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a per-bucket summary back to its rows."""
    renamed = summary.withColumnsRenamed({n: f"_s_{n}" for n in names})
    condition = F.lit(True)
    for name in names:
        condition = condition & rows[name].eqNullSafe(renamed[f"_s_{name}"])
    return rows.join(renamed, condition, how).drop(*[f"_s_{n}" for n in names])


# Rows of a part, about, and parts at most: their bounds are literals of the plan.
PART_ROWS = 500_000
MOST_PARTS = 4096
# Keys drawn for each bound.
DRAWN = 20


def _plain_order(df: DataFrame, order: Sequence[Column]) -> list[str] | None:
    """The names of ``order`` if it is ascending columns and nothing else."""
    names = [re.fullmatch(r"Column<'(\w+)'>", str(c)) for c in order]
    if not all(n and n[1] in df.columns for n in names):
        return None
    return [n[1] for n in names]


def _as_literal(df: DataFrame, column: str, value) -> Column:
    plain = naive(value) if isinstance(value, datetime) else F.lit(value)
    return plain.cast(df.schema[column].dataType)


def _below(df: DataFrame, columns: Sequence[str], bounds: Sequence[tuple]) -> Column:
    """How many of the ascending ``bounds`` are not above the row's ``columns``, nulls lowest: a binary search by steps of halves."""
    if not bounds:
        return F.lit(0)
    key = F.struct(*[F.col(c) for c in columns])
    table = F.array(*[F.struct(*[_as_literal(df, c, v).alias(c) for c, v in zip(columns, b)]) for b in bounds])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])

    def step(found: Column, width: Column) -> Column:
        further = found + width
        return F.when((further <= len(bounds)) & (F.get(table, further - 1) <= key), further).otherwise(found)

    return F.aggregate(steps, F.lit(0), step)


def range_parts(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "_part") -> DataFrame:
    """Add ``name``: a number that rises along ``(keys, order)`` and splits the
    table into parts of similar size, whatever the keys and times look like.

    ``order`` should be total.  The cut is made once, at keys of a bounded
    sample, and is part of the plan, so all readers and repeated tasks see the
    same; rows are neither moved nor stored for it.  Only where ``order`` is
    more than ascending columns are the rows staged as a table instead.
    """
    spark, columns = df.sparkSession, _plain_order(df, order)
    if columns is None:
        path = shared_folder(spark, "range")
        placed = df.repartitionByRange(*[F.col(k) for k in keys], *order)
        placed.withColumn(name, F.spark_partition_id()).write.parquet(path)
        return spark.read.parquet(path)
    columns = list(dict.fromkeys([*keys, *columns]))
    n = df.count()
    parts = min(MOST_PARTS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // PART_ROWS), n)
    return df.withColumn(name, _below(df, columns, key_bounds(df, columns, parts, n)))


def key_bounds(
    df: DataFrame, columns: Sequence[str], parts: int, n: int, by: Sequence[str] | None = None
) -> list[tuple]:
    """Ascending keys that cut the ``n`` rows into about equal ``parts``, from a bounded sample; fewer where keys repeat.

    ``by`` are the columns whose hash draws a row: the keys, unless few keys make up all rows.
    """
    if parts < 2:
        return []
    unit = F.pmod(F.xxhash64(*(by or columns)), F.lit(1 << 30)) / float(1 << 30)
    drawn = df.select(*columns).filter(unit < DRAWN * parts / n).distinct().orderBy(*columns)
    found = [tuple(r) for r in drawn.limit(4 * DRAWN * parts).collect()]
    bounds = [found[len(found) * i // parts] for i in range(1, parts)] if found else []
    return list(dict.fromkeys(bounds))


def interleaved_ranks(df: DataFrame, columns: Sequence[str], bits: int) -> Column:
    """A number whose bits are those of each column's rank in turn (Z-order): rows near in it are near in every column.

    A rank is the row's place among up to ``2 ** bits`` sampled values of the
    column, so any type with an order serves, and values need not be spread evenly.
    """
    n = df.count()
    total = F.lit(0).cast("long")
    whole = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    for i, c in enumerate(columns):
        bounds = key_bounds(df, [c], min(1 << bits, n), n, whole)
        # Few values are spread over all ranks, so that their highest bits tell them apart.
        rank = F.floor(_below(df, [c], bounds) * F.lit((1 << bits) / (len(bounds) + 1))).cast("long")
        for bit in range(bits):
            taken = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long"))
            total = total.bitwiseOR(F.shiftleft(taken, bit * len(columns) + i))
    return total


def row_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    bucket: Column | None = None,
    name: str = "row_index",
    descending: bool = False,
) -> DataFrame:
    """Add the exact 0-based position of each row inside its key.

    Rows are numbered inside ``(keys, bucket)``; the number of rows in earlier
    buckets comes from counts that are combined before the shuffle.  ``bucket``
    must not decrease along ``order`` (not increase, with ``descending``);
    without one the rows are cut by ``range_parts``.
    """
    if bucket is None:
        rows, descending = range_parts(df, keys, order, _BUCKET), False
    else:
        rows = df.withColumn(_BUCKET, bucket)
    parts = [*keys, _BUCKET]
    step = F.desc(_BUCKET) if descending else F.asc(_BUCKET)
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(*parts)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*parts, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    numbered = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*parts).orderBy(*order)))
    return (
        _attach(numbered, starts, parts)
        .withColumn(name, (F.col("_start") + F.col("_rn") - 1).cast("long"))
        .drop(_BUCKET, "_rn", "_start")
    )


# Keys sampled and bounds counted per step of ``seek_key``.
SEEK_SAMPLE = 4096
SEEK_BOUNDS = 64


class KeyRange:
    """Rows ordered by ``(first, second)``, nulls lowest, between a bound that is in and a lower one that is not."""

    def __init__(self, df: DataFrame, first: str, second: str, high: tuple | None = None, low: tuple | None = None):
        self.df, self.first, self.second, self.high, self.low = df, first, second, high, low
        self.key = F.struct(F.col(first), F.col(second))

    def literal(self, bound: tuple) -> Column:
        return F.struct(*[self.value(c, v).alias(c) for c, v in zip((self.first, self.second), bound)])

    def value(self, column: str, value) -> Column:
        return _as_literal(self.df, column, value)

    def rows(self) -> DataFrame:
        """The first column's bounds are plain comparisons with literals, so they reach the file scan."""
        out, first = self.df, F.col(self.first)
        if self.high is not None:
            top = self.value(self.first, self.high[0])
            out = out.filter(first.isNull() if self.high[0] is None else (first <= top) | first.isNull())
            out = out.filter(self.key <= self.literal(self.high))
        if self.low is not None:
            if self.low[0] is not None:
                out = out.filter(first >= self.value(self.first, self.low[0]))
            out = out.filter(self.key > self.literal(self.low))
        return out


# Shares of the rows at which a time is looked up at once, and the sketch's rank error as a share.
GRID = 1024
SKETCH = 10_000


def _seek_time(df: DataFrame, first: str, skip: int, take: int, enough: int) -> tuple[DataFrame, int]:
    """``seek_key`` by ``first`` alone, a time: what is left holds ``enough`` rows before the wanted ones or is one instant.

    A sketch of fixed size tells times near the place, one count tells what
    lies above, and the times bound the scans that follow.
    """
    at = F.col(first)
    rows, rest, low, high = df, skip, None, None
    shares = [i / GRID for i in range(GRID + 1)]
    pad = 1 + -(-2 * GRID // SKETCH)

    def between(low, high) -> DataFrame:
        out = df
        if high is not None:
            out = out.filter(at <= naive(high) if low is not None else (at <= naive(high)) | at.isNull())
        return out if low is None else out.filter(at >= naive(low))

    while rest > enough:
        known, grid = rows.agg(F.count(first), F.percentile_approx(first, shares, SKETCH)).first()
        if rest >= known:  # among the rows without a time
            return (df.filter(at.isNull()), rest - known) if low is None else (rows, rest)
        top = grid[min(GRID, int((known - rest) / known * GRID) + pad)]
        below = int((known - rest - take) / known * GRID) - pad
        bottom = grid[below] if below >= 0 else low
        near = rows.filter(at >= naive(bottom)) if bottom is not None else rows
        above, held = near.agg(F.count_if(at > naive(top)), F.count_if(at <= naive(top))).first()
        if above > rest:  # not within the sketch's error
            break
        if held < rest - above + take:
            bottom = low
        rest, stuck = rest - above, (bottom, top) == (low, high)
        low, high = bottom, top
        rows = between(low, high)
        if stuck or low == high:
            break
    return rows, rest


def seek_key(df: DataFrame, first: str, second: str, skip: int, take: int, enough: int) -> tuple[DataFrame, int]:
    """Rows among which the wanted ones, ``skip`` to ``skip + take`` in descending order, are a small top-k.

    Returns ``(rows, rest)``: the wanted rows follow after ``rest`` others, which are at most
    ``enough`` unless that many rows share one key.  Where ``first`` is a time, the place is first
    narrowed down by it.  Keys may be of any type that has an order.
    """
    if skip > enough and df.schema[first].dataType.typeName() in ("timestamp", "timestamp_ntz"):
        df, skip = _seek_time(df, first, skip, take, enough)
    return _seek_pair(df, first, second, skip, take, enough)


def _seek_pair(df: DataFrame, first: str, second: str, skip: int, take: int, enough: int) -> tuple[DataFrame, int]:
    """``seek_key`` by both: while more than ``enough`` rows lie before, a bounded sample of keys
    cuts the range into pieces, the pieces are counted, and the one that holds the place is cut again.
    """

    def order(key: tuple) -> tuple:
        return tuple((v is not None, v if v is not None else 0) for v in key)

    place, rest, stuck = KeyRange(df, first, second), skip, 0
    n = df.count() if skip > enough else 0
    bottom = None
    while rest > enough and n > enough and stuck < 3:
        rows = place.rows()
        unit = F.pmod(F.xxhash64(first, second, F.lit(stuck + rest)), F.lit(1 << 30)) / float(1 << 30)
        drawn = rows.filter(unit < SEEK_SAMPLE / n).select(first, second).distinct().limit(4 * SEEK_SAMPLE).collect()
        keys = sorted((tuple(r) for r in drawn), key=order)
        bounds = keys[:: max(1, len(keys) // SEEK_BOUNDS)]
        below = F.size(F.filter(F.array(*map(place.literal, bounds)), lambda b: b < place.key)) if bounds else F.lit(0)
        counts = dict(rows.groupBy(below.alias("piece")).count().collect())
        piece = len(bounds)
        while piece >= 0 and rest >= counts.get(piece, 0):
            rest -= counts.get(piece, 0)
            piece -= 1
        if piece < 0:
            return df.limit(0), 0
        stuck = stuck + 1 if counts[piece] == n else 0
        # Below the piece, as far as the wanted rows reach.
        held, lowest = counts[piece], piece
        while held < rest + take and lowest > 0:
            lowest -= 1
            held += counts.get(lowest, 0)
        bottom = bounds[lowest - 1] if held >= rest + take and lowest > 0 else place.low if held >= rest + take else None
        n = counts[piece]
        place = KeyRange(
            df, first, second,
            bounds[piece] if piece < len(bounds) else place.high,
            bounds[piece - 1] if piece > 0 else place.low,
        )
    return KeyRange(df, first, second, place.high, bottom).rows(), rest


def trailing_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    bucket: Column | None,
    rows: int,
    aggregates: dict[str, Column],
    chunk_rows: int = 1_000_000,
) -> DataFrame:
    """Aggregates over the current and the ``rows - 1`` preceding rows of a key.

    The key's rows are numbered, cut into chunks of equal size, and the last
    ``rows - 1`` rows of a chunk are copied into the next, so every frame is
    complete inside one chunk.
    """
    size = max(chunk_rows, rows)
    numbered = row_index(df, keys, order, bucket, "_index")
    chunk = F.floor(F.col("_index") / size).cast("long")
    reaches_next = F.col("_index") % size >= size - (rows - 1)
    copies = numbered.withColumn("_home", chunk).withColumn(
        "_chunk",
        F.explode(F.when(reaches_next, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))),
    )
    frame = Window.partitionBy(*keys, "_chunk").orderBy("_index").rowsBetween(-(rows - 1), 0)
    return (
        copies.withColumns({n: a.over(frame) for n, a in aggregates.items()})
        .filter(F.col("_chunk") == F.col("_home"))
        .drop("_index", "_home", "_chunk")
    )


def _frame_steps(total_us: int) -> int:
    """Into how many equal buckets a time frame is cut: each at most
    ``BUCKET_SECONDS`` wide, and at least eight."""
    fewest = max(8, -(-total_us // (BUCKET_SECONDS * 1_000_000)))
    return next(k for k in count(fewest) if total_us % k == 0)


def trailing_mean(df: DataFrame, keys: Sequence[str], ts: str, value: str, seconds: int) -> DataFrame:
    """Add ``moving_average`` and ``points`` over the key's rows in ``[ts - seconds, ts]``.

    A sliding frame adds up every row of every frame again and needs the key's
    history in one task.  Here rows of one instant are summed first, the frame
    is a whole number of buckets long, and a frame's sum has three parts: the
    instant's own bucket up to the instant, the whole buckets before it, and
    the end of the bucket in which the frame begins.  The first and the last
    come from running sums inside ``(keys, bucket)``, one in each direction, so
    nothing outside the frame (a NaN, a huge value) ever enters its sum.
    """
    total_us = seconds * 1_000_000
    steps = _frame_steps(total_us)
    width = total_us // steps
    sums = ["_sum", "_values", "_rows"]
    parts = [*keys, _BUCKET]
    instants = (
        df.groupBy(*keys, ts)
        .agg(F.sum(value).alias("_sum"), F.count(value).alias("_values"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_at", micros(ts))
        .withColumn(_BUCKET, F.floor(F.col("_at") / F.lit(width)).cast("long"))
    )
    # Each instant stands in its own bucket, and its frame's begin in an earlier
    # one; a begin sorts before an instant of the same time, which it includes.
    here = F.struct("_at", _BUCKET, F.lit(1).alias("_side"), *sums)
    begin = F.struct(
        (F.col("_at") - F.lit(total_us)).alias("_at"), (F.col(_BUCKET) - F.lit(steps)).alias(_BUCKET),
        F.lit(0).alias("_side"), *[F.lit(None).cast(instants.schema[c].dataType).alias(c) for c in sums],
    )
    both = instants.select(*keys, ts, F.explode(F.array(here, begin)).alias("_e")).select(*keys, ts, "_e.*")
    upto = Window.partitionBy(*parts).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    since = Window.partitionBy(*parts).orderBy(F.desc("_at"), F.desc("_side")).rowsBetween(Window.unboundedPreceding, 0)
    running = [
        F.when(F.col("_side") == 1, F.sum(c).over(upto)).otherwise(F.sum(c).over(since)).alias(c) for c in sums
    ]
    edges = both.select(*keys, ts, _BUCKET, "_side", *running)
    between = Window.partitionBy(*keys).orderBy(_BUCKET).rangeBetween(-(steps - 1), -1)
    wholes = (
        instants.groupBy(*parts)
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select(
            *parts,
            *[F.sum(c).over(between).alias(f"{c}_whole") for c in sums],
        )
    )

    def piece(c: str) -> Column:
        part, whole = (F.coalesce(F.col(n), F.lit(0)) for n in (c, f"{c}_whole"))
        return F.when(F.col("_side") == 1, part + whole).otherwise(part).alias(c)

    pieces = _attach(edges, wholes, parts, "left").select(*keys, ts, *[piece(c) for c in sums])
    means = (
        pieces.groupBy(*keys, ts)
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select(
            *keys, ts,
            (F.col("_sum") / F.nullif(F.col("_values"), F.lit(0))).alias("moving_average"),
            F.col("_rows").cast("long").alias("points"),
        )
    )
    return _attach(df, means, [*keys, ts])


def latest_before(
    probes: DataFrame,
    points: DataFrame,
    key: str,
    ts: str,
    point_value: Column,
    point_order: Sequence[Column],
    name: str,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """As-of join: add the newest point of the same key at or before ``ts``.

    ``probes`` and ``points`` both carry ``key`` and ``ts``; ``point_order``
    decides between points of one instant.  Each instant of a key becomes one
    row; a running ``last`` inside the bucket answers it, or the value carried
    from the last earlier bucket that has a point.
    """
    offered = points.filter(F.col(key).isNotNull()).select(
        key, ts, F.struct(*point_order).alias("_rank"), F.struct(point_value.alias("value")).alias("_point")
    )
    asked = probes.select(key, ts, F.lit(True).alias("_asked"))
    instants = (
        offered.unionByName(asked, allowMissingColumns=True)
        .groupBy(key, ts)
        .agg(F.max_by("_point", "_rank").alias("_point"), F.bool_or("_asked").alias("_asked"))
        .withColumn(_BUCKET, time_bucket(ts, bucket_seconds))
    )
    inside = Window.partitionBy(key, _BUCKET).orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    answered = instants.withColumn("_inside", F.last("_point", ignorenulls=True).over(inside)).filter("_asked")

    earlier = Window.partitionBy(key).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    borders = (
        instants.groupBy(key, _BUCKET)
        .agg(
            F.max_by("_point", F.when(F.col("_point").isNotNull(), F.col(ts))).alias("_last"),
            F.bool_or("_asked").alias("_asked"),
        )
        .select(key, _BUCKET, "_asked", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
        .filter("_asked")
        .drop("_asked")
    )
    answers = _attach(answered, borders, [key, _BUCKET], "left").select(
        key, ts, F.coalesce("_inside", "_carried")["value"].alias(name)
    )
    return _attach(probes, answers, [key, ts], "left")


def runs(
    df: DataFrame, keys: Sequence[str], step: str, name: str = "run"
) -> DataFrame:
    """Number the runs of consecutive integers in ``step`` inside each key.

    For summary rows only (one row per key and time step).
    """
    w = Window.partitionBy(*keys).orderBy(step)
    starts = F.when(F.col(step) - F.lag(step).over(w) == 1, 0).otherwise(1)
    return (
        df.withColumn("_starts", starts)
        .withColumn(name, F.sum("_starts").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .drop("_starts")
    )


def quantile_bracket(value: Column, probs: Sequence[float], accuracy: int = 10_000) -> list[Column]:
    """Aggregates from which ``exact_quantiles`` starts: the brackets of the quantiles, and the number of values."""
    slack = 2.0 / accuracy
    edges = []
    for p in probs:
        edges += [max(0.0, p - slack), min(1.0, p + slack)]
    return [F.percentile_approx(value, edges, accuracy).alias("_edges"), F.count(value).alias("_total")]


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    accuracy: int = 10_000,
    brackets: DataFrame | None = None,
) -> DataFrame:
    """Exact discrete quantiles: the smallest value whose share reaches ``p``.

    ``percentile`` keeps every distinct value of a group in one task.  Here a
    sketch of fixed size first brackets each quantile (its rank error is at
    most ``n / accuracy``); then only the distinct values inside the brackets
    are moved and ranked, with everything below them counted.  ``brackets``
    are the rows of ``quantile_bracket`` by ``keys``, if they are known.
    """
    if brackets is None:
        brackets = df.groupBy(*keys).agg(*quantile_bracket(F.col(value), probs, accuracy))
    slots = brackets.select(
        *keys, "_total",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(p).alias("p"),
                        F.col("_edges")[2 * i].alias("low"),
                        F.col("_edges")[2 * i + 1].alias("high"),
                    )
                    for i, p in enumerate(probs)
                ]
            )
        ).alias("_slot"),
    )
    slots = slots.select(*keys, "_total", "_slot.*")
    # Inside a bracket the values fall into SLICES slices; the slice that holds
    # the target is found by counts and only its values are ranked one by one.
    # Values below a bracket are one group, so they are counted before the shuffle.
    parts = [*keys, "p"]
    width = F.col("high") - F.col("low")
    slice_ = F.floor((F.col(value) - F.col("low")) / width * SLICES)
    known = (width > 0) & (width < float("inf"))
    near = (
        _attach(df.filter(F.col(value).isNotNull()).select(*keys, value), slots, list(keys))
        .filter(F.col(value) <= F.col("high"))
        .withColumn("_slice", F.when(F.col(value) < F.col("low"), -1).when(known, slice_).otherwise(0).cast("long"))
        .withColumn(value, F.when(F.col("_slice") >= 0, F.col(value)))
        .groupBy(*parts, "_total", "_slice", value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    target = F.greatest(F.ceil(F.col("p") * F.col("_total")), F.lit(1))
    upto = Window.partitionBy(*parts).orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    found = (
        near.groupBy(*parts, "_total", "_slice")
        .agg(F.sum("_n").alias("_m"))
        .withColumn("_before", F.sum("_m").over(upto) - F.col("_m"))
        .filter((F.col("_before") < target) & (F.col("_before") + F.col("_m") >= target))
        .select(*parts, "_slice", "_before")
    )
    running = Window.partitionBy(*parts).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (
        _attach(near, found, [*parts, "_slice"])
        .withColumn("_upto", F.col("_before") + F.sum("_n").over(running))
        .filter(F.col("_upto") >= target)
        .groupBy(*parts)
        .agg(F.min(value).alias("quantile"))
    )
