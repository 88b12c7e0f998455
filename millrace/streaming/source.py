"""Streaming sources and the common way to run a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from millrace.conf import CLUSTER
from millrace.schemas import CHECKPOINT_SECONDS

# Files per micro-batch: bounds what one batch holds per key.
FILES_PER_TRIGGER = 64


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = FILES_PER_TRIGGER
) -> DataFrame:
    """Stream the Parquet files of a folder as they arrive.

    Without ``max_files`` a trigger takes everything that is there, which
    keeps the batches of an upstream query whole.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def table_stream(
    spark: SparkSession, folder: str, name: str, max_files: int = FILES_PER_TRIGGER
) -> DataFrame:
    """Stream a table that is one file or a folder of files.

    The file source takes folders only, except through a pattern; a pattern
    that matches the one name serves both.
    """
    path = f"{folder}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    return file_stream(spark, path[:-1] + f"[{path[-1]}]", schema, max_files)


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Stream Kafka topics; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**options).load()


def event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark on ``ts``; a naive UTC column is cast, the engine needs an instant."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def paced(writer: DataStreamWriter, seconds: int = CHECKPOINT_SECONDS) -> DataStreamWriter:
    """Trigger, and so commit offsets and state, every ``seconds``."""
    return writer.trigger(processingTime=f"{seconds} seconds")


_STORE = "spark.sql.streaming.stateStore.providerClass"


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Process everything that is there now, in batches, and stop.

    The query starts with the state store of ``conf.CLUSTER``; the session's own setting stays as it is.
    """
    spark = writer._spark
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, CLUSTER[_STORE])
    try:
        query = writer.trigger(availableNow=True).start()  # keeps the settings of this moment
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)
    query.awaitTermination()
    return query


class LateRows(StreamingQueryListener):
    """Counts the rows that streams drop for lying behind the watermark, over their whole life.

    Register it before the queries start: ``spark.streams.addListener(LateRows())``.
    """

    def __init__(self):
        super().__init__()
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event):
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event):
        p = event.progress
        rows = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        self.dropped[str(p.id)] = self.dropped.get(str(p.id), 0) + rows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def of(self, query: StreamingQuery) -> int:
        return self.dropped.get(str(query.id), 0)


def run_of(batch: DataFrame) -> str:
    """The id of the query that a micro-batch belongs to; it lives as long as the checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def batch_folder(path: str, batch_id: int, run: str | None = None) -> str:
    """The folder of one micro-batch.

    A batch that is run again overwrites its own folder, which makes a sink
    written through it exactly-once.  With ``run``, the id of the query, the
    batches of another checkpoint, which count from 0 again, have folders of
    their own.
    """
    return f"{path}/run={run}/batch_id={batch_id}" if run else f"{path}/batch_id={batch_id}"


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of a batch-folder sink, with ``run`` and ``batch_id``."""
    wide = T.StructType([*schema.fields, T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])
    return spark.read.schema(wide).option("basePath", path).parquet(path)
