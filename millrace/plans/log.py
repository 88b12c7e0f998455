"""Queries: message log."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.rules import ERRORS, Rule
from millrace.plans import records
from millrace.plans.records import AS_OF, ctes
from millrace.plans.registry import query
from millrace.sources import log

PAYLOAD = T.StructType([T.StructField("k", T.LongType())])

# Every tenth key sends text that is cut off; values above 90 break a rule.
_SPOILT_SQL = """spoilt as (
select id, msg_key, case when cast(msg_key as bigint) % 10 = 0 then substr(value, 1, 5) else value end as value,
  topic, part_id, log_offset, ts,
  cast(msg_key as bigint) % 10 <> 0 as readable
from envelope),
judged as (
select *, case when readable then cast(value ->> '$.k' as bigint) end as k,
  readable and cast(case when readable then value end ->> '$.k' as bigint) <= 90 as good
from spoilt)"""


def spoilt_envelope(spark, folder):
    messages = records.envelope(spark, folder)
    cut = F.col("key").cast("long") % 10 == 0
    return messages.withColumn("value", F.when(cut, F.substring("value", 1, 5)).otherwise(F.col("value")))


def payload_rules() -> list[Rule]:
    return [Rule("k", "range", F.col("message.k") <= 90)]


def named(df):
    """Columns under the names the SQL twins use."""
    return df.withColumnsRenamed({"key": "msg_key", "partition": "part_id", "offset": "log_offset", "timestamp": "ts"})


@query(
    "log_decode",
    ctes("envelope")
    + f""",
{_SPOILT_SQL}
select msg_key, topic, part_id, log_offset, ts, k, not readable as corrupt from judged""",
)
def log_decode(spark, folder):
    decoded = log.decode(spoilt_envelope(spark, folder), PAYLOAD)
    return named(decoded).select(
        "msg_key", "topic", "part_id", "log_offset", "ts", F.col("message.k").alias("k"),
        F.col("_corrupt").isNotNull().alias("corrupt"),
    )


@query(
    "consume_bounded",
    ctes("envelope")
    + f""",
{_SPOILT_SQL},
counted as (
select *, count(*) filter (where good) over (order by topic, part_id, log_offset) as taken from judged)
select topic, part_id, log_offset, k, good from counted
where (good and taken <= 1500) or (not good and taken < 1500)""",
)
def consume_bounded(spark, folder):
    good, bad = log.consume(spoilt_envelope(spark, folder), PAYLOAD, payload_rules(), 1500)
    both = good.withColumn("good", F.lit(True)).unionByName(bad.withColumn("good", F.lit(False)))
    return named(both).select("topic", "part_id", "log_offset", F.col("message.k").alias("k"), "good")


def _refuse_sevens(message: dict) -> None:
    if message["k"] % 7 == 0:
        raise ValueError(f"{message['k']} is not wanted")


@query(
    "consume_handler",
    ctes("envelope")
    + f""",
{_SPOILT_SQL},
done as (select *, good and k % 7 <> 0 as fine from judged),
counted as (select *, count(*) filter (where fine) over (order by topic, part_id, log_offset) as taken from done)
select topic, part_id, log_offset, k, fine as good, case when good and not fine
  then 'handler: ValueError: ' || cast(k as varchar) || ' is not wanted' end as failure from counted
where (fine and taken <= 1500) or (not fine and taken < 1500)""",
)
def consume_handler(spark, folder):
    """Messages that the handler fails on are set aside and do not count towards the cap."""
    good, bad = log.consume(spoilt_envelope(spark, folder), PAYLOAD, payload_rules(), 1500, _refuse_sevens)
    both = good.withColumn("good", F.lit(True)).unionByName(bad.withColumn("good", F.lit(False)))
    failure = F.get(F.filter(ERRORS, lambda e: e.startswith("handler")), 0)
    return named(both).select(
        "topic", "part_id", "log_offset", F.col("message.k").alias("k"), "good", failure.alias("failure")
    )


@query(
    "consume_counts",
    ctes("envelope")
    + f""",
{_SPOILT_SQL}
select topic, part_id, count(*) filter (where good) as processed, count(*) filter (where not good) as failed
from judged group by topic, part_id""",
)
def consume_counts(spark, folder):
    judged = log.judge(spoilt_envelope(spark, folder), PAYLOAD, payload_rules())
    return named(log.consume_counts(judged))


@query(
    "consume_errors",
    ctes("envelope")
    + f""",
{_SPOILT_SQL}
select topic, part_id, log_offset, value, case when readable then 'k:range' else 'k:range,value:json' end as errors
from judged where not good""",
)
def consume_errors(spark, folder):
    """The dead-letter side of an unbounded consumption."""
    _, bad = log.consume(spoilt_envelope(spark, folder), PAYLOAD, payload_rules())
    errors = F.array_join(F.array_sort(ERRORS), ",")
    return named(bad).select("topic", "part_id", "log_offset", "value", errors.alias("errors"))


@query(
    "produce_envelope",
    ctes("ingestion")
    + """select substr(source_id, 8) as msg_key, id, source_type, '2024-01-31T00:00:00.000000' as stamped_at,
  'client-1' as producer_id, 'data.ingestion' as topic,
  cast(length('{"id":' || cast(id as varchar) || ',"source_type":"' || source_type
    || '","timestamp":"2024-01-31T00:00:00.000000","producer_id":"client-1"}') as bigint) as message_size
from ingestion""",
)
def produce_envelope(spark, folder):
    """The caller's own ``timestamp`` and ``producer_id`` are overwritten."""
    rows = records.ingestion(spark, folder).select(
        "id", "source_type", F.substring("source_id", 8, 20).alias("msg_key"),
        F.col("created_at").alias("timestamp"), F.lit("someone").alias("producer_id"),
    )
    sent = log.to_envelope(rows, "data.ingestion", "client-1", AS_OF, key="msg_key")
    read = F.from_json("value", "id long, source_type string, timestamp string, producer_id string")
    return sent.withColumn("m", read).select(
        F.col("key").alias("msg_key"), "m.id", "m.source_type", F.col("m.timestamp").alias("stamped_at"),
        "m.producer_id", "topic", "message_size",
    )


@query(
    "produce_batch",
    ctes("ingestion")
    + """,
indexed as (
select id, source_type, row_number() over (partition by source_type order by created_at, id) - 1 as batch_index
from ingestion)
select id, source_type, cast(batch_index as bigint) as batch_index,
  case when batch_index < 100 then 'key-' || cast(batch_index as varchar) end as msg_key
from indexed""",
)
def produce_batch(spark, folder):
    """One batch per source type; keys are given for its first hundred messages."""
    rows = records.ingestion(spark, folder).select("id", "source_type", "created_at")
    first_hundred = F.explode(F.sequence(F.lit(0), F.lit(99))).alias("i")
    keys = (
        rows.select("source_type").distinct().select("source_type", first_hundred)
        .select("source_type", F.col("i").cast("long").alias("batch_index"),
                F.concat(F.lit("key-"), F.col("i").cast("string")).alias("message_key"))
    )
    sent = log.to_batch_envelope(
        rows, "data.ingestion", "client-1", AS_OF, ["source_type"], [F.col("created_at"), F.col("id")], keys
    )
    read = F.from_json("value", "id long, source_type string, batch_index long")
    return sent.withColumn("m", read).select("m.*", F.col("key").alias("msg_key"))


_HOLES_SQL = """holes as (
select topic, part_id, log_offset, ts from envelope where not (log_offset % 17 in (3, 4))
union all
select topic, part_id, log_offset, ts from envelope where log_offset % 23 = 5 and not (log_offset % 17 in (3, 4)))"""


def _with_holes(spark, folder):
    """The log with some offsets lost and some delivered twice."""
    messages = records.envelope(spark, folder)
    kept = messages.filter(~(F.col("offset") % 17).isin(3, 4))
    return kept.unionByName(kept.filter(F.col("offset") % 23 == 5))


@query(
    "topic_stats",
    ctes("envelope")
    + f""",
{_HOLES_SQL}
select topic, part_id, count(*) as messages, min(log_offset) as min_offset, max(log_offset) as max_offset,
  max(log_offset) - min(log_offset) + 1 - count(distinct log_offset) as missing, max(ts) as last_timestamp
from holes group by topic, part_id""",
)
def topic_stats(spark, folder):
    return log.topic_stats(_with_holes(spark, folder)).withColumnRenamed("partition", "part_id")


@query(
    "offset_gaps",
    ctes("envelope")
    + f""",
{_HOLES_SQL},
d as (
select topic, part_id, log_offset, count(*) as copies,
  lag(log_offset) over (partition by topic, part_id order by log_offset) as previous_offset
from holes group by topic, part_id, log_offset)
select topic, part_id, previous_offset, log_offset, 'gap' as kind, log_offset - previous_offset - 1 as n
from d where log_offset - previous_offset > 1
union all
select topic, part_id, previous_offset, log_offset, 'repeat', copies - 1 from d where copies > 1""",
)
def offset_gaps(spark, folder):
    return named(log.offset_gaps(_with_holes(spark, folder), offset_range=100))
