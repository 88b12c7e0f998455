"""Message log: decode, bounded consumption, envelopes, offset bookkeeping.

The envelope has the columns of Spark's Kafka source: ``key``, ``value``,
``topic``, ``partition``, ``offset``, ``timestamp``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.functions.ordered import row_index
from millrace.functions.rules import ERRORS, Rule, validate
from millrace.functions.scalars import iso_text, naive, with_once
from millrace.schemas import POLL_RECORDS

POSITION = ("topic", "partition", "offset")
_CORRUPT = "_corrupt"

# Times in message bodies keep their microseconds; null fields stay visible.
_TIME_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_BODY = {"ignoreNullFields": "false", "timestampFormat": _TIME_TEXT, "timestampNTZFormat": _TIME_TEXT}

# A capped consumption parses messages of one log partition in stretches of at least so many.
STRETCH = 10_000

# Offsets are cut into ranges of this many for ordered work on one partition.
OFFSET_RANGE = 1_000_000


def kafka_options(
    servers: str,
    topics: Sequence[str],
    start: str = "earliest",
    max_per_trigger: int | None = None,
    group_id: str | None = None,
    poll_records: int = POLL_RECORDS,
) -> dict[str, str]:
    """Options of ``readStream.format("kafka")``.

    ``poll_records`` is what one fetch of a consumer returns at most; a
    micro-batch is many fetches and has no limit unless ``max_per_trigger``
    sets one.  Offsets live in the stream's checkpoint; the group id is only a
    prefix for the consumer groups Spark creates.
    """
    if not topics:
        raise ValueError("at least one topic is needed")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": start,
        "kafka.max.poll.records": str(poll_records),
        "failOnDataLoss": "true",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if group_id:
        options["groupIdPrefix"] = group_id
    return options


KAFKA_COLUMNS = ("key", "value", "topic", "partition")


def kafka_sink(envelope: DataFrame, servers: str):
    """A batch writer of envelope rows to Kafka; call ``save()`` on it."""
    return (
        envelope.select(*[c for c in KAFKA_COLUMNS if c in envelope.columns])
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
    )


def kafka_stream_sink(envelope: DataFrame, servers: str, checkpoint: str):
    """A stream writer of envelope rows to Kafka; call ``start()`` on it."""
    return (
        envelope.select(*[c for c in KAFKA_COLUMNS if c in envelope.columns])
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
    )


def decode(envelope: DataFrame, schema: T.StructType) -> DataFrame:
    """Parse ``value`` (JSON text or bytes) into ``message``; key as text.

    Empty bytes become null.  ``_corrupt`` holds the text that is not JSON of
    the declared shape.
    """
    text = F.nullif(F.col("value").cast("string"), F.lit(""))
    key = F.nullif(F.col("key").cast("string"), F.lit(""))
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(F.col("value"), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    fields = [F.col("_parsed")[f.name].alias(f.name) for f in schema.fields]
    return (
        with_once(envelope.withColumn("key", key).withColumn("value", text), "_parsed", parsed)
        .withColumn("message", F.struct(*fields))
        .withColumn(_CORRUPT, F.col("_parsed")[_CORRUPT])
        .drop("_parsed")
    )


def judge(envelope: DataFrame, schema: T.StructType, rules: Sequence[Rule]) -> DataFrame:
    """Decode and check; ``validation_errors`` is empty for a good message.

    Rules refer to the message's fields as ``message.<field>``.
    """
    decoded = decode(envelope, schema)
    readable = Rule("value", "json", F.col("value").isNotNull() & F.col(_CORRUPT).isNull())
    return validate(decoded, [readable, *rules]).drop(_CORRUPT)


def handled(judged: DataFrame, handler: Callable[[dict], object]) -> DataFrame:
    """Run ``handler`` on the message of every good row; what it raises joins the row's errors.

    The handler gets the parsed JSON object.  A failure stops neither its batch
    nor the job, and the row no longer counts as good.  A task that is run
    again calls the handler again, so it should bear repetition.
    """

    @F.pandas_udf("string")
    def failure(values: pd.Series) -> pd.Series:
        def call(text: str | None) -> str | None:
            if text is None:
                return None
            try:
                handler(json.loads(text))
            except Exception as e:  # whatever the user's code raises
                return f"handler: {type(e).__name__}: {e}"
            return None

        return values.map(call).astype(object)

    good = F.when(F.size(ERRORS) == 0, F.col("value"))
    marked = judged.withColumn("_failure", failure.asNondeterministic()(good))
    return marked.withColumn(ERRORS, F.concat(ERRORS, F.array_compact(F.array("_failure")))).drop("_failure")


def consume(
    envelope: DataFrame,
    schema: T.StructType,
    rules: Sequence[Rule],
    max_messages: int | None = None,
    handler: Callable[[dict], object] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(good, bad) messages; with a ``handler``, those it fails on are bad.

    A bad message never stops consumption and does not count towards
    ``max_messages``; 0 or None means no cap.  With a cap, reading stops at the
    last good message taken, so later bad ones are not seen.
    """
    judged = judge(envelope, schema, rules)
    if handler:
        judged = handled(judged, handler)
    good = judged.filter(F.size(ERRORS) == 0)
    bad = judged.filter(F.size(ERRORS) > 0)
    if not max_messages:
        return good, bad
    end = _position_of(envelope, good, max_messages)
    if end is None:
        return good, bad
    # The position is known now, so both sides read the log only up to it.
    last, copies = end
    here = F.struct(*[F.lit(v).cast(judged.schema[n].dataType).alias(n) for n, v in zip(POSITION, last)])
    first = F.col("topic").isNull() if last[0] is None else (F.col("topic") <= last[0]) | F.col("topic").isNull()
    before = first & (F.struct(*POSITION) < here)
    at = F.col("topic").eqNullSafe(last[0]) & F.col("partition").eqNullSafe(last[1]) & (F.col("offset") == last[2])
    return good.filter(before).unionByName(good.filter(at).limit(copies)), bad.filter(before)


# Slices of a stretch that are counted at once, and offsets that are looked at one by one.
SLICES = 256
FEW_OFFSETS = 10_000


class Stretch(NamedTuple):
    """Offsets ``low`` to ``high`` of a log partition."""

    topic: str | None
    partition: int | None
    low: int
    high: int

    @property
    def width(self) -> int:
        """Offsets in a slice."""
        return -(-(self.high - self.low + 1) // SLICES)

    def holds(self) -> Column:
        mine = F.col("topic").eqNullSafe(self.topic) & F.col("partition").eqNullSafe(self.partition)
        return mine & (F.col("offset") >= self.low) & (F.col("offset") <= self.high)

    def slice(self, i: int) -> Stretch:
        low = self.low + i * self.width
        return self._replace(low=low, high=min(self.high, low + self.width - 1))


def _slices(good: DataFrame, stretches: Sequence[Stretch], n: int) -> tuple[Stretch | None, int]:
    """The slice that holds the ``n``-th good message of the stretches, and its number there; or None and how many are missing.

    One job counts the good messages of all slices.
    """
    anywhere, at = F.lit(False), F.lit(None).cast("struct<stretch: int, slice: bigint>")
    for i, s in enumerate(stretches):
        anywhere = anywhere | s.holds()
        place = F.struct(F.lit(i).alias("stretch"), F.floor((F.col("offset") - s.low) / F.lit(s.width)).alias("slice"))
        at = F.when(s.holds(), place).otherwise(at)
    found = good.filter(anywhere).groupBy(at.alias("at")).agg(F.count("offset").alias("n")).collect()
    for (i, part), held in sorted((tuple(r["at"]), r["n"]) for r in found):
        if held >= n:
            return stretches[i].slice(part), n
        n -= held
    return None, n


def _position_of(envelope: DataFrame, good: DataFrame, n: int) -> tuple[tuple, int] | None:
    """Position of the ``n``-th good message and how many of its copies belong to the first ``n``; None if there are fewer.

    Messages are counted without parsing them.  As many as are missing, and
    as many again for bad ones among them, are judged by one job, which tells
    the slice of offsets that holds the end; the rest of the log is not parsed.
    """
    sizes = envelope.groupBy("topic", "partition").agg(
        F.count("offset").alias("n"), F.min("offset").alias("low"), F.max("offset").alias("high")
    ).collect()  # one row for each log partition
    sizes = [r for r in sizes if r.n]
    sizes.sort(key=lambda r: (r.topic is not None, r.topic or "", r.partition is not None, r.partition or 0))
    i, low, hurry = 0, None, 1
    while i < len(sizes):
        stretches, room = [], max(2 * n, STRETCH) * hurry
        while i < len(sizes) and room > 0:
            part = sizes[i]
            low = part.low if low is None else low
            high = part.high if part.n <= room else min(part.high, low + room - 1)
            stretches.append(Stretch(part.topic, part.partition, low, high))
            room -= min(part.n, high - low + 1)
            i, low = (i + 1, None) if high == part.high else (i, high + 1)
        place, missing = _slices(good, stretches, n)
        hurry, n = 2 * hurry if missing == n else 1, missing  # over a gap
        while place is not None:
            if place.high - place.low < FEW_OFFSETS:
                held = good.filter(place.holds()).groupBy("offset").agg(F.count(F.lit(1)).alias("n")).collect()
                for offset, copies in sorted(map(tuple, held)):
                    if copies >= n:
                        return (place.topic, place.partition, offset), n
                    n -= copies
                return None  # the log has changed meanwhile
            place, n = _slices(good, [place], n)
    return None


def consume_counts(judged: DataFrame) -> DataFrame:
    """Processed and failed messages per topic and partition."""
    ok = F.size(ERRORS) == 0
    return judged.groupBy("topic", "partition").agg(
        F.count_if(ok).alias("processed"), F.count_if(~ok).alias("failed")
    )


def for_each_message(judged: DataFrame, handler: Callable, schema: str) -> DataFrame:
    """Apply ``handler(pandas.DataFrame) -> pandas.DataFrame`` batch by batch.

    For handlers that Spark functions cannot express; batches arrive through
    Arrow and never hold more than ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows.
    """

    def run(batches):
        for batch in batches:
            yield handler(batch)

    return judged.mapInPandas(run, schema)


def to_envelope(
    df: DataFrame,
    topic: str,
    producer_id: str,
    as_of: datetime,
    key: str | None = None,
    partition: Column | None = None,
) -> DataFrame:
    """Rows as log messages: all columns but ``key`` become the JSON value.

    ``timestamp`` and ``producer_id`` are stamped and replace fields of the
    same name.  Null fields stay visible in the JSON.
    """
    stamp = {"timestamp": iso_text(naive(as_of)), "producer_id": F.lit(producer_id)}
    body = [F.col(c) for c in df.columns if c != key and c not in stamp]
    value = F.to_json(F.struct(*body, *[c.alias(n) for n, c in stamp.items()]), JSON_BODY)
    key_column = F.nullif(F.col(key).cast("string"), F.lit("")) if key else F.lit(None).cast("string")
    envelope = df.select(
        key_column.alias("key"),
        value.alias("value"),
        F.lit(topic).alias("topic"),
        (partition if partition is not None else F.lit(None)).cast("int").alias("partition"),
        naive(as_of).alias("timestamp"),
    )
    return envelope.withColumn("message_size", F.length("value").cast("long"))


def to_batch_envelope(
    df: DataFrame,
    topic: str,
    producer_id: str,
    as_of: datetime,
    batch: Sequence[str],
    order: Sequence[Column],
    keys: DataFrame | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """As ``to_envelope`` with a 0-based ``batch_index`` inside each batch.

    ``keys`` holds message keys by position (``batch`` columns, ``batch_index``,
    ``message_key``); messages beyond it have a null key.
    """
    indexed = row_index(df, batch, order, bucket, "batch_index")
    if keys is None:
        return to_envelope(indexed, topic, producer_id, as_of)
    keyed = indexed.join(keys, [*batch, "batch_index"], "left")
    return to_envelope(keyed, topic, producer_id, as_of, key="message_key")


def _offsets(envelope: DataFrame, offset_range: int) -> DataFrame:
    """Distinct offsets with their number of copies and the offset before.

    Copies are combined before the shuffle.  The predecessor of the first
    offset of a range comes from the last non-empty range before it, so one
    busy partition is worked on by many tasks.
    """
    parts = ["topic", "partition"]
    distinct = (
        envelope.groupBy(*parts, "offset")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("_range", F.floor(F.col("offset") / offset_range).cast("long"))
    )
    before = Window.partitionBy(*parts).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    borders = (
        envelope.withColumn("_range", F.floor(F.col("offset") / offset_range).cast("long"))
        .groupBy(*parts, "_range")
        .agg(F.max("offset").alias("_last"))
        .select(*parts, "_range", F.max("_last").over(before).alias("_border"))
    )
    inside = F.lag("offset").over(Window.partitionBy(*parts, "_range").orderBy("offset"))
    return (
        distinct.withColumn("_inside", inside)
        .join(borders, [*parts, "_range"])
        .withColumn("previous_offset", F.coalesce("_inside", "_border"))
        .drop("_range", "_inside", "_border")
    )


def offset_gaps(envelope: DataFrame, offset_range: int = OFFSET_RANGE) -> DataFrame:
    """Missing offset stretches and repeated offsets of each topic partition.

    ``kind`` is ``gap`` (``n`` offsets missing after ``previous_offset``) or
    ``repeat`` (``n`` extra copies of ``offset``).
    """
    gap = F.col("offset") - F.col("previous_offset") - 1
    found = F.array(
        F.struct(F.lit("gap").alias("kind"), F.coalesce(gap, F.lit(0)).alias("n")),
        F.struct(F.lit("repeat").alias("kind"), (F.col("copies") - 1).alias("n")),
    )
    return (
        _offsets(envelope, offset_range)
        .select("topic", "partition", "previous_offset", "offset", F.explode(found).alias("f"))
        .select("topic", "partition", "previous_offset", "offset", "f.kind", "f.n")
        .filter("n > 0")
    )


def topic_stats(envelope: DataFrame) -> DataFrame:
    """Per topic partition: messages, offset bounds, missing offsets, last time."""
    span = F.max("offset") - F.min("offset") + 1
    return envelope.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
        (span - F.count_distinct("offset")).alias("missing"),
        F.max("timestamp").alias("last_timestamp"),
    )


def topic_info(envelope: DataFrame, topic: str) -> DataFrame:
    """``topic_stats`` of one topic; an unknown topic is an error."""
    selected = envelope.filter(F.col("topic") == topic)
    if selected.isEmpty():
        raise ValueError(f"topic {topic} not found")
    return topic_stats(selected)
