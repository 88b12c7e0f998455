"""Parquet tables: append, layout, snapshot, rewrite, retention, compaction."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.ordered import interleaved_ranks, row_index
from millrace.functions.scalars import col, minus, naive
from millrace.operators.jobs import current_state
from millrace.operators.mutations import delete_where, update_where
from millrace.schemas import BATCH_SIZE, RETENTION_DAYS
from millrace.sources.workspace import shared_folder


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_record_id(df: DataFrame, key_columns: Sequence[str], name: str = "id") -> DataFrame:
    """Add a 24-hex id that depends on the row's key only.

    The same row gets the same id when a lost task is run again; a counter
    such as ``monotonically_increasing_id`` would not promise that.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in key_columns]
    return df.withColumn(name, F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 24))


def text_ids(df: DataFrame, *names: str) -> DataFrame:
    """Ids as text, as readers get them."""
    return df.withColumns({n: F.col(n).cast("string") for n in names or ("id",)})


def append(
    df: DataFrame, path: str, partition_by: Sequence[str] | None = None, max_records: int | None = None
) -> None:
    """Append rows to a table, one or many; ``max_records`` bounds a file's rows."""
    writer = df.write.mode("append")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_layout(
    df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str], mode: str = "overwrite"
) -> None:
    """Write partitioned by ``partition_by`` and sorted by ``sort_by`` inside files.

    Readers that filter on these columns skip partitions and row groups.  The
    rebalance hint lets adaptive execution merge small partition values and
    split a value that holds most of the rows.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in partition_by])
        .sortWithinPartitions(*partition_by, *sort_by)
        .write.mode(mode)
        .partitionBy(*partition_by)
        .parquet(path)
    )


# Bits of each column's rank in a Z-order.
Z_BITS = 8


def write_zordered(
    df: DataFrame, path: str, by: Sequence[str], bloom: dict[str, int] | None = None, max_records: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Write clustered by several columns at once, so that a filter on any of them skips row groups.

    Rows are dealt out and sorted by their Z-order; its equal values are told
    apart by the columns themselves.  Times should be instants stored as
    microseconds (``conf.CLUSTER``): the reader compares neither other instants
    nor times without a zone with the statistics of row groups.
    ``bloom`` names columns that are looked
    up by equality, with the number of values to expect: their row groups get
    a Bloom filter.
    """
    placed = df.withColumn("_z", interleaved_ranks(df, by, Z_BITS))
    ordered = placed.repartitionByRange("_z", *by).sortWithinPartitions("_z", *by).drop("_z")
    writer = ordered.write.mode(mode)
    for column, values in (bloom or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(values))
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)


def write_bucketed(
    df: DataFrame, table: str, path: str, key: str, sort_by: Sequence[str], buckets: int
) -> None:
    """Save a table bucketed by ``key`` so that joins on it need no shuffle."""
    (
        df.write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(*sort_by)
        .option("path", path)
        .saveAsTable(table)
    )


def snapshot(tables: dict[str, DataFrame], root: str, as_of: datetime) -> str:
    """Dump every table below a dated folder; returns the folder."""
    folder = f"{root}/{as_of:%Y%m%d_%H%M%S}"
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return folder


def restore(spark: SparkSession, folder: str, name: str, target: str) -> DataFrame:
    """Replace ``target`` by the snapshot's table."""
    spark.read.parquet(f"{folder}/{name}").write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


# Buckets of rows whose checksums are compared before any row is moved.
CHECK_BUCKETS = 4096


def _weighted(source: DataFrame, copy: DataFrame) -> DataFrame:
    """Rows of both tables with ``_weight`` 1 and -1."""
    columns = source.columns
    return source.withColumn("_weight", F.lit(1)).unionByName(copy.select(*columns).withColumn("_weight", F.lit(-1)))


def _checksums(both: DataFrame, columns: Sequence[str], buckets: int) -> tuple[DataFrame, Column]:
    """``_bucket, source_rows, copy_rows, _differs`` for each bucket of rows, and the bucket of a row.

    A bucket's checksum is the sum of its rows' hashes, whatever their order:
    128 bits of hash in four sums, which are equal for different rows by
    chance only.
    """
    one, two = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)
    bucket = F.pmod(one, F.lit(buckets)).cast("int")
    halves = [h for x in (one, two) for h in (x.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(x, 32))]
    rows = both.select(bucket.alias("_bucket"), "_weight", *[h.alias(f"_h{i}") for i, h in enumerate(halves)])
    sums = rows.groupBy("_bucket").agg(
        F.count_if(F.col("_weight") > 0).alias("source_rows"),
        F.count_if(F.col("_weight") < 0).alias("copy_rows"),
        *[F.sum(F.col(f"_h{i}") * F.col("_weight")).alias(f"_s{i}") for i in range(len(halves))],
    )
    differs = F.col("source_rows") != F.col("copy_rows")
    for i in range(len(halves)):
        differs = differs | (F.col(f"_s{i}") != 0)
    return sums.withColumn("_differs", differs), bucket


def reconcile(source: DataFrame, copy: DataFrame, buckets: int = CHECK_BUCKETS) -> DataFrame:
    """Rows whose number differs between two tables, with the difference.

    Checksums of buckets of rows are compared first; only rows of buckets that
    differ are moved, and copies of a row are counted before that.
    """
    columns = source.columns
    both = _weighted(source, copy)
    sums, bucket = _checksums(both, columns, buckets)
    differing = F.broadcast(sums.filter("_differs").select("_bucket"))  # ``buckets`` numbers at most
    return (
        both.withColumn("_bucket", bucket)
        .join(differing, "_bucket", "left_semi")
        .groupBy(*columns)
        .agg(F.sum("_weight").alias("_surplus"))
        .filter("_surplus <> 0")
        .withColumn("side", F.when(F.col("_surplus") > 0, "source_only").otherwise("copy_only"))
        .withColumn("n_rows", F.abs("_surplus"))
        .drop("_surplus")
    )


def reconcile_counts(source: DataFrame, copy: DataFrame, buckets: int = CHECK_BUCKETS) -> DataFrame:
    """One row: row counts of both sides and rows found on one side only."""
    names = ("source_rows", "copy_rows", "source_only", "copy_only")
    sums, _ = _checksums(_weighted(source, copy), source.columns, buckets)
    found = reconcile(source, copy, buckets).select(
        *[F.when(F.col("side") == side, F.col("n_rows")).alias(side) for side in ("source_only", "copy_only")]
    )
    both = sums.select("source_rows", "copy_rows").unionByName(found, allowMissingColumns=True)
    return both.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in names])


def changed_since(df: DataFrame, last_mark: datetime, as_of: datetime) -> DataFrame:
    """Rows created or updated after the last extract, up to ``as_of``."""
    changed = F.coalesce(F.col("updated_at"), F.col("created_at"))
    return df.filter((changed > naive(last_mark)) & (changed <= naive(as_of)))


MARKS = "_marks"


def last_mark(spark: SparkSession, root: str) -> datetime | None:
    """The time up to which the extracts below ``root`` are complete."""
    target, fs = _filesystem(spark, f"{root}/{MARKS}")
    if not fs.exists(target):
        return None
    return spark.read.parquet(f"{root}/{MARKS}").agg(F.max("mark")).collect()[0][0]


def extract(
    spark: SparkSession, tables: dict[str, DataFrame], root: str, as_of: datetime, keys: dict[str, str] | None = None
) -> str:
    """Dump what changed since the last extract, everything the first time.

    For a table named in ``keys``, by its key column, the keys it has now are
    kept, and those that the last extract had and that are gone become
    tombstones, so that ``restore_chain`` gives the table as it was.  The mark
    is written after the data, so a failed extract is simply run again.
    """
    mark, keys, whole = last_mark(spark, root), keys or {}, tables
    if mark is not None:
        tables = {name: changed_since(df, mark, as_of) for name, df in tables.items()}
    else:
        made = F.coalesce(F.col("created_at"), F.col("updated_at"))  # without either, in no later extract
        tables = {name: df.filter((made <= naive(as_of)) | made.isNull()) for name, df in tables.items()}
    folder = snapshot(tables, root, as_of)
    for name, key in keys.items():
        made = F.coalesce(F.col("created_at"), F.col("updated_at"))
        known = whole[name].filter((made <= naive(as_of)) | made.isNull()).select(F.col(key).alias("key")).distinct()
        known.write.mode("overwrite").parquet(f"{folder}/{name}{KEYS}")
        before = f"{root}/{mark:%Y%m%d_%H%M%S}/{name}{KEYS}" if mark is not None else None
        if before is not None and _filesystem(spark, before)[1].exists(_filesystem(spark, before)[0]):
            now = spark.read.parquet(f"{folder}/{name}{KEYS}")
            gone = spark.read.parquet(before).join(now, "key", "left_anti")
            gone.write.mode("overwrite").parquet(f"{folder}/{name}{GONE}")
    marks = spark.range(1).select(naive(as_of).alias("mark"))
    marks.coalesce(1).write.mode("append").parquet(f"{root}/{MARKS}")
    return folder


# Beside an extract's table: the keys that the table had, and those gone since the last extract.
KEYS, GONE = "__keys", "__gone"


def restore_chain(spark: SparkSession, root: str, name: str, key: str) -> DataFrame:
    """The table as of the last extract: of each key the row of the last extract that has one, unless a later one buried it.

    Extracts that were not finished, and so have no mark, do not count.
    """
    marks = [r[0] for r in spark.read.parquet(f"{root}/{MARKS}").distinct().collect()]
    folders = sorted(f"{root}/{m:%Y%m%d_%H%M%S}" for m in marks)

    def rows(suffix: str) -> DataFrame | None:
        paths = [p for p in (f"{f}/{name}{suffix}" for f in folders) if _filesystem(spark, p)[1].exists(_filesystem(spark, p)[0])]
        if not paths:
            return None
        at = F.regexp_extract("_metadata.file_path", r"/(\d{8}_\d{6})/[^/]+/[^/]+$", 1).alias("_at")
        return spark.read.parquet(*paths).select("*", at)

    stored, gone = rows(""), rows(GONE)
    columns = [c for c in stored.columns if c != "_at"]
    versions = stored.select(F.col(key).alias("_key"), "_at", F.struct(*columns).alias("_row"))
    if gone is not None:
        versions = versions.unionByName(gone.select(F.col("key").alias("_key"), "_at"), allowMissingColumns=True)
    newest = versions.groupBy("_key").agg(F.max_by("_row", "_at").alias("_row"))
    return newest.filter("_row is not null").select("_row.*")


def retained(df: DataFrame, ts: str, as_of: datetime, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows not older than ``days`` at ``as_of``; one without a time is not known to be old and stays, as its partition does."""
    return df.filter((F.col(ts) >= minus(naive(as_of), days=days)) | F.col(ts).isNull())


def purge_partitions(
    spark: SparkSession, path: str, date_column: str, as_of: datetime, days: int = RETENTION_DAYS
) -> list[str]:
    """Delete the date partitions that lie wholly before the retention limit.

    Returns the dropped partition values.  No data file is read: the driver
    handles one name per date.
    """
    limit = (as_of - timedelta(days=days)).date()
    dropped = []
    for value in _partition_values(spark, path, date_column):
        if date.fromisoformat(value) < limit:
            _delete(spark, f"{path}/{date_column}={value}")
            dropped.append(value)
    return sorted(dropped)


def assign_batches(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], size: int = BATCH_SIZE, bucket: Column | None = None
) -> DataFrame:
    """Add ``batch_id``: consecutive groups of ``size`` rows inside each key."""
    indexed = row_index(df, keys, order, bucket, "_index")
    return indexed.withColumn("batch_id", F.floor(F.col("_index") / size).cast("long")).drop("_index")


def _folder() -> Column:
    """The name of the partition folder that a row was read from, as it is on disk."""
    address = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))  # a plus is no blank here
    return F.regexp_extract(F.url_decode(address), "([^/]+)/[^/]+$", 1)


def _folders(df: DataFrame) -> list[str]:
    """Partition folders that hold rows of ``df``; at most those that the table's file listing has on the driver anyway."""
    return [r[0] for r in df.select(_folder().alias("folder")).distinct().collect()]


def _rewrite(spark: SparkSession, changed: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions present in ``changed``, others stay untouched.

    The new rows are written aside first, so the table is never read and
    overwritten by one job and a failed run can be repeated.
    """
    aside = shared_folder(spark, "rewrite")
    changed.write.partitionBy(partition).parquet(aside)
    (
        spark.read.schema(changed.schema)
        .parquet(aside)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    _delete(spark, aside)


def _touched(spark: SparkSession, path: str, pred: Column) -> tuple[DataFrame, list[str]]:
    """The rows of the partitions that hold a matching row, read from their folders only, and the folders."""
    table = spark.read.parquet(path)
    folders = _folders(table.filter(pred))
    if not folders:
        return table.limit(0), folders
    rows = spark.read.schema(table.schema).option("basePath", path)
    return rows.parquet(*[f"{path}/{f}" for f in folders]), folders


def update_table(
    spark: SparkSession, path: str, partition: str, pred: Column, sets: dict[str, Column]
) -> None:
    """Update matching rows of a partitioned table, rewriting touched partitions only.

    The partition column itself cannot be set: rows do not move between partitions.
    """
    if partition in sets:
        raise ValueError(f"{partition} is the partition column")
    touched, folders = _touched(spark, path, pred)
    if folders:
        _rewrite(spark, update_where(touched, pred, sets), path, partition)


def delete_from_table(spark: SparkSession, path: str, partition: str, pred: Column) -> None:
    """Delete matching rows of a partitioned table, rewriting touched partitions only.

    A partition that loses all its rows is dropped: a dynamic overwrite alone
    would leave it as it was.
    """
    touched, folders = _touched(spark, path, pred)
    if not folders:
        return
    kept = delete_where(touched, pred)
    left = set(_folders(kept))
    if left:
        _rewrite(spark, kept, path, partition)
    for folder in folders:
        if folder not in left:
            _delete(spark, f"{path}/{folder}")


# File groups of an upserted table; a group should stay below a few hundred megabytes.
UPSERT_GROUPS = 64


def merge_groups(fresh: DataFrame, keys: Sequence[str], path: str, groups: int, label: str) -> None:
    """Merge versions into a table that keeps one row per key, the newest (see ``current_state``).

    The table is plain Parquet in folders ``group_of_{groups}=n``, a key's
    folder being its hash.  Only the folders that keys of ``fresh`` fall into
    are read and replaced; the others keep their files.

    The new content is written below ``_merging`` first, which readers do not
    see, and then moved folder by folder.  ``label`` names the work: run again
    after a failure, it goes on with the move where it stopped, or merges
    again, which gives the same rows.
    """
    spark, name = fresh.sparkSession, f"group_of_{groups}"
    aside = f"{path}/_merging/{label}"
    root, fs = _filesystem(spark, path)
    there = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    odd = [n for n in there if n.startswith("group_of_") and not n.startswith(f"{name}=")]
    if odd:
        raise ValueError(f"{path} has another number of groups: {odd[0]}")
    if not fs.exists(_filesystem(spark, f"{aside}/_SUCCESS")[0]):
        number = F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int")
        placed = fresh.withColumn(name, number).persist()
        touched = [f"{name}={r[0]}" for r in placed.select(name).distinct().collect()]  # at most ``groups``
        known = [t for t in touched if t in there]
        rows = placed
        if known:
            stored = spark.read.schema(placed.schema).option("basePath", path)
            rows = stored.parquet(*[f"{path}/{k}" for k in known]).unionByName(placed)
        if touched:
            newest = current_state(rows, [*keys, name]).select(*placed.columns)
            newest.repartition(min(len(touched), groups), name).write.mode("overwrite").partitionBy(name).parquet(aside)
        placed.unpersist()
        if not touched:
            return
    for status in fs.listStatus(_filesystem(spark, aside)[0]):
        folder = status.getPath().getName()
        if folder.startswith(f"{name}="):
            _delete(spark, f"{path}/{folder}")
            fs.rename(status.getPath(), _filesystem(spark, f"{path}/{folder}")[0])
    _delete(spark, aside)


def compact(spark: SparkSession, path: str, target: str, partition: str, sort_by: Sequence[str]) -> DataFrame:
    """Rewrite a table into few, sorted files; the rows stay the same."""
    write_layout(spark.read.parquet(path), target, [partition], sort_by)
    return spark.read.parquet(target)


def with_date(df: DataFrame, ts: str = "created_at", name: str = "dt") -> DataFrame:
    return df.withColumn(name, F.to_date(col(ts)))


def _filesystem(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    target, fs = _filesystem(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]
    prefix = f"{column}="
    return [n[len(prefix):] for n in names if n.startswith(prefix) and "__HIVE" not in n]


def _delete(spark: SparkSession, path: str) -> None:
    target, fs = _filesystem(spark, path)
    fs.delete(target, True)
