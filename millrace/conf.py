"""Spark settings the operators are designed for; pass them at submit time."""

from __future__ import annotations

CLUSTER = {
    # Naive UTC times are cast to instants in buckets and watermarks.
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution merges small shuffle partitions, splits skewed joins,
    # and turns a join into a broadcast only once the real size is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # An upper bound for the merge above: partitions of about 128 MB for shuffles of 2.5 TB.
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Instants with statistics, by which row groups are skipped; the default type has none.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # Streaming state on local disk with change logs, not on the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Shuffle files of lost executors are moved on decommission.
    "spark.dynamicAllocation.enabled": "true",
    "spark.dynamicAllocation.shuffleTracking.enabled": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}
