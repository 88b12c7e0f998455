"""Continuous ingestion: decode, check, store, and set bad messages aside."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions.rules import ERRORS, Rule
from millrace.sources.log import POSITION, handled, judge
from millrace.sources.tables import UPSERT_GROUPS, merge_groups
from millrace.streaming.source import batch_folder, event_time, run_of


def ingest_writer(
    envelope: DataFrame,
    schema: T.StructType,
    rules: Sequence[Rule],
    table: str,
    dead_letters: str,
    checkpoint: str,
    handler: Callable[[dict], object] | None = None,
) -> DataStreamWriter:
    """Good messages to ``table``, the others to ``dead_letters`` with their errors.

    A bad message never stops the stream, nor does one on which ``handler``
    fails (see ``log.handled``): both are dead letters.  Every row keeps its
    topic, partition and offset.  A query with a fresh checkpoint adds to what
    earlier ones stored; it never overwrites it.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch)
        batch = batch.persist()
        ok = F.size(ERRORS) == 0
        good = batch.filter(ok).select(*POSITION, "key", "timestamp", "message.*")
        bad = batch.filter(~ok).select(*POSITION, "key", "timestamp", "value", ERRORS)
        good.write.mode("overwrite").parquet(batch_folder(table, batch_id, run))
        bad.write.mode("overwrite").parquet(batch_folder(dead_letters, batch_id, run))
        batch.unpersist()

    judged = judge(envelope, schema, rules)
    if handler:
        judged = handled(judged, handler)
    return judged.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


def file_writer(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append-only Parquet sink; exactly-once through its own commit log."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def batch_writer(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataStreamWriter:
    """One folder per micro-batch, for outputs that are updated over time."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, batch_id, run_of(batch)))

    return df.writeStream.outputMode(mode).foreachBatch(store).option("checkpointLocation", checkpoint)


def without_replays(envelope: DataFrame, delay: str, ts: str = "timestamp") -> DataFrame:
    """Drop messages whose topic, partition and offset were seen within ``delay``."""
    return event_time(envelope, ts, delay).dropDuplicatesWithinWatermark(list(POSITION))


def handle_writer(
    df: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str
) -> DataStreamWriter:
    """Run a user function on every micro-batch."""
    return df.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)


def upsert_writer(
    df: DataFrame, keys: Sequence[str], path: str, checkpoint: str, groups: int = UPSERT_GROUPS
) -> DataStreamWriter:
    """Keep one row per key, the newest version, in the Parquet table at ``path``.

    Keys are dealt to ``groups`` folders by hash, and a micro-batch rewrites
    the folders that its keys fall into; see ``tables.merge_groups``.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        merge_groups(batch, keys, path, groups, f"{run_of(batch)}-{batch_id}")

    return df.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
