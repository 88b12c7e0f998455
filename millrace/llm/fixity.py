"""Fixity audit of archive replicas by Merkle trees.

Pages become WARC records, packed in id order into archives; a record's leaf is the digest of its
bytes with its offset and length.  Leaves are hashed by range of offsets, ranges by archive, and
archives by groups up to one root.  An audit compares the roots, and descends, level by level,
only into nodes that differ; the records below them are then compared by id.

Rules: a null url has no target line, a null page is empty; rows without an id go to archives of
their own, chosen by their content; records that occur several times are compared in digest order;
an empty table has no root, and two empty tables agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.store import named, staged

#: Ids of an archive, bytes of a range of offsets, and children of a group of archives.
ARCHIVE_IDS = 1000
RANGE_BYTES = 1 << 18
FANOUT = 64
#: Archives for rows without an id.
STRAY_ARCHIVES = 1 << 16


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The text of a page's WARC record."""
    body = F.coalesce(html, F.lit(""))
    target = F.coalesce(F.concat(F.lit("WARC-Target-URI: "), url, F.lit("\r\n")), F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\n"),
        target,
        F.lit("Content-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def leaves(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``archive, page_id, nth, offset, length, digest`` of every record; the page itself is not shuffled."""
    rows = named(pages, page_id, url, html).toDF("page_id", "url", "html")
    text = record(F.col("page_id"), F.col("url"), F.col("html"))
    stray = -1 - F.pmod(F.xxhash64("url", "html"), F.lit(STRAY_ARCHIVES))
    rows = rows.select(
        F.coalesce(F.floor(F.col("page_id") / ARCHIVE_IDS), stray).cast("long").alias("archive"),
        "page_id",
        F.octet_length(text).cast("long").alias("length"),
        F.sha2(text, 256).alias("digest"),
    )
    order = Window.partitionBy("archive").orderBy(F.col("page_id").asc_nulls_first(), "digest")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy("archive", "page_id").orderBy("digest")
    return rows.select(
        "archive",
        "page_id",
        F.row_number().over(same).alias("nth"),
        F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"),
        "length",
        "digest",
    )


def _hash_children(rows: DataFrame, parent: list[Column], order: Column, child: Column) -> DataFrame:
    """One node for each parent: the digest of its children in order, whose number is bounded."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), child.alias("c")))), lambda x: x["c"])
    return rows.groupBy(*parent).agg(F.sha2(F.array_join(listed, "\n"), 256).alias("node"))


class Tree:
    """The levels of a replica's tree, from ranges of offsets up to the root, as staged tables."""

    def __init__(self, pages: DataFrame, levels: int | None = None):
        self.leaves = staged(leaves(pages).withColumn("range", F.floor(F.col("offset") / RANGE_BYTES)), "fixity-leaves")
        leaf = F.concat_ws(" ", "offset", "length", "digest")
        ranges = _hash_children(self.leaves, ["archive", "range"], F.col("offset"), leaf)
        self.ranges = staged(ranges, "fixity-ranges")
        roots = _hash_children(self.ranges, ["archive"], F.col("range"), F.concat_ws(" ", "range", "node"))
        self.groups = [staged(roots.withColumnRenamed("archive", "key"), "fixity-archives")]
        if levels is None:
            width = self.groups[0].agg(F.max(F.abs("key"))).first()[0] or 0
            levels = 1
            while width >= FANOUT:
                width, levels = width // FANOUT, levels + 1
        for _ in range(levels):
            below = self.groups[-1]
            above = _hash_children(below, [F.floor(F.col("key") / FANOUT).alias("key")], F.col("key"), F.concat_ws(" ", "key", "node"))
            self.groups.append(staged(above, "fixity-groups"))


def _differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of nodes that are not the same on both sides."""
    a, b = a.withColumnRenamed("node", "node_a"), b.withColumnRenamed("node", "node_b")
    return a.join(b, keys, "full").filter(~F.col("node_a").eqNullSafe(F.col("node_b"))).select(*keys)


def audit(pages: DataFrame, replica: DataFrame) -> DataFrame:
    """The records in which ``replica`` differs: ``archive, page_id, nth, verdict`` and both sides' offset and digest.

    The verdict is ``corrupt`` (other bytes), ``missing``, ``extra`` or ``moved`` (the same bytes elsewhere).
    """
    a = Tree(pages)
    b = Tree(replica, len(a.groups) - 1)
    bad = staged(_differing(a.groups[-1], b.groups[-1], ["key"]), "fixity-bad")
    for below_a, below_b in zip(reversed(a.groups[:-1]), reversed(b.groups[:-1])):
        parent = bad.withColumnRenamed("key", "parent")
        sides = [
            x.join(parent, F.floor(F.col("key") / FANOUT) == F.col("parent"), "left_semi") for x in (below_a, below_b)
        ]
        bad = staged(_differing(*sides, ["key"]), "fixity-bad")
    archives = bad.withColumnRenamed("key", "archive")
    sides = [x.join(archives, "archive", "left_semi") for x in (a.ranges, b.ranges)]
    ranges = staged(_differing(*sides, ["archive", "range"]), "fixity-bad")
    one, two = (
        t.leaves.join(ranges, ["archive", "range"], "left_semi").select(
            "archive", "page_id", "nth", F.struct("offset", "length", "digest").alias(side)
        )
        for t, side in ((a, "a"), (b, "b"))
    )
    match = F.lit(True)
    for key in ("archive", "page_id", "nth"):
        match &= one[key].eqNullSafe(two[key])
    pairs = one.join(two, match, "full").select(
        *[F.coalesce(one[k], two[k]).alias(k) for k in ("archive", "page_id", "nth")], "a", "b"
    )
    verdict = (
        F.when(F.col("b").isNull(), "missing")
        .when(F.col("a").isNull(), "extra")
        .when(F.col("a.digest") != F.col("b.digest"), "corrupt")
        .when(F.col("a.offset") != F.col("b.offset"), "moved")
    )
    return pairs.select(
        "archive", "page_id", "nth", verdict.alias("verdict"),
        F.col("a.offset").alias("offset"), F.col("b.offset").alias("replica_offset"),
        F.col("a.digest").alias("digest"), F.col("b.digest").alias("replica_digest"),
    ).filter("verdict is not null")
