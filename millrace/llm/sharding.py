"""Range shards of near equal bytes by sampled splitters.

Rows are ordered by a digest of the text, then by id, so equal texts are neighbours and a hot
text is still divisible.  A size-weighted sample of keys gives quantile boundaries; rows are
dealt to ranges by binary search among them; a range that came out overfull is sampled again by
itself and subdivided.  Every range is then sorted in one task of bounded size, and the running
bytes decide the shard: a row belongs to the shard that holds the middle of its bytes, so shards
differ by about one row.

Rules: null text counts as empty; null ids come first; equal ``(text, id)`` pairs are told apart
by nothing and keep one range, each with its own slot.  A text of any length is one row of its bytes.

The ranges spread the sort over tasks; which shard a row belongs to follows from exact running
bytes, not from the sample.  The driver holds one boundary for each range, about one for
``RANGE_ROWS`` rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.store import named, staged

#: Rows of a range, roughly; a range is sorted by one task.
RANGE_ROWS = 500_000
#: Ranges a shard is cut into at least.
RANGES_PER_SHARD = 16
#: Sampled keys for each range, on average.
SAMPLES_PER_RANGE = 32
#: A range with more than this many times its share of bytes is subdivided.
OVERFULL = 2.0
#: Times that overfull ranges are subdivided at most; what is left then is one key.
ROUNDS = 6



def _unit(*columns: Column) -> Column:
    """A number in [0, 1) decided by the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 48)).cast("double") / float(1 << 48)


def _splitters(rows: DataFrame, ranges: int, total: int, salt: int) -> list[dict]:
    """Quantile boundaries of ``rows`` by size, from a sample of expected ``ranges * SAMPLES_PER_RANGE`` keys."""
    step = max(1.0, total / (ranges * SAMPLES_PER_RANGE))
    # A row is drawn in proportion to its size; rows larger than a step are drawn for sure.
    drawn = rows.filter(_unit("digest", "id", F.lit(salt)) < F.col("size") / step)
    running = F.sum(F.greatest("size", F.lit(step))).over(Window.orderBy("digest", "id"))
    placed = drawn.select("digest", "id", (running / (step * SAMPLES_PER_RANGE)).cast("long").alias("quantile"))
    bounds = placed.groupBy("quantile").agg(F.max(F.struct("digest", "id")).alias("bound"))
    return [r.bound.asDict() for r in bounds.select("bound").distinct().orderBy("bound").collect()]


def _place(key: Column, bounds: list[dict], kind: str = "bigint") -> Column:
    """How many of the sorted ``bounds`` lie below ``key``: a branch-free binary search."""
    if not bounds:
        return F.lit(0)
    table = F.from_json(F.lit(json.dumps(bounds, default=str)), F.lit(f"array<struct<digest:string,id:{kind}>>"))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])

    def take(found: Column, step: Column) -> Column:
        further = found + step
        return F.when((further <= len(bounds)) & (F.get(table, further - 1) < key), further).otherwise(found)

    return F.aggregate(steps, F.lit(0), take)


def shard_by_bytes(df: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``df``; ids may be of any type that has an order and a JSON form.

    ``size`` is the bytes of the text and one; slots of a shard count from 0 without gaps in key order.
    """
    value = F.coalesce("text", F.lit(""))
    keyed = staged(
        named(df, doc_id, text)
        .toDF("id", "text")
        .select(
            "id",
            F.md5(value).alias("digest"),
            (F.octet_length(value) + 1).cast("long").alias("size"),
            F.crc32(value).alias("crc"),
        ),
        "shard-keys",
    )
    seen = keyed.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    total = seen.bytes or 0
    ranges = max(shards * RANGES_PER_SHARD, -(-seen["rows"] // RANGE_ROWS))
    key, kind = F.struct("digest", "id"), keyed.schema["id"].dataType.simpleString()
    limit = OVERFULL * total / ranges
    bounds = _splitters(keyed, ranges, total, 0) if total else []
    for salt in range(1, ROUNDS):
        sums = keyed.groupBy(_place(key, bounds, kind).alias("range")).agg(
            F.sum("size").alias("bytes"), F.min(key) != F.max(key)
        )
        over = [r for r in sums.filter(F.col("bytes") > limit).collect() if r[2]]
        if not over:
            break
        finer: list[dict] = []
        for r in over:
            inside = keyed.filter(_place(key, bounds, kind) == r["range"])
            finer += _splitters(inside, max(2, round(2 * r.bytes / limit)), r.bytes, salt)
        bounds = sorted(
            {(b["digest"], b["id"]) for b in [*bounds, *finer]}, key=lambda b: (b[0], b[1] is not None, 0 if b[1] is None else b[1])
        )
        bounds = [{"digest": d, "id": i} for d, i in bounds]
    ranged = keyed.withColumn("range", _place(key, bounds, kind))
    # A row for each range: their number is bounded by rows / RANGE_ROWS and the subdivisions.
    sums = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    ahead = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "range",
        F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("bytes_ahead"),
        F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("rows_ahead"),
    )
    inside = Window.partitionBy("range").orderBy("digest", "id")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select(
        "*", F.sum("size").over(upto).alias("bytes_upto"), F.row_number().over(inside).alias("nth")
    )
    middle = 2 * (F.col("bytes_ahead") + F.col("bytes_upto")) - F.col("size")
    placed = staged(
        local.join(F.broadcast(offsets), "range").select(
            "id", "size", "crc",
            F.least(F.lit(shards - 1), F.floor(middle * shards / (2 * max(total, 1)))).cast("int").alias("shard"),
            (F.col("rows_ahead") + F.col("nth") - 1).alias("nth"),
        ),
        "shard-places",
    )
    first = placed.groupBy("shard").agg(F.min("nth").alias("first"))  # at most `shards` rows
    return placed.join(F.broadcast(first), "shard").select(
        F.col("id").alias(doc_id),
        "size",
        F.col("crc").alias("text_crc32"),
        "shard",
        (F.col("nth") - F.col("first")).cast("long").alias("slot"),
    )
