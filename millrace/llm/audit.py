"""What each of several filters removes in every order in which they could be applied.

A document matters only by its mask, the set of filters that it fails, so documents are counted by
part and mask first.  Orders are numbered by their Lehmer rank, that is lexicographically; all orders
with one beginning are an interval of ranks.  A document with a given mask is removed by the first of
its filters, so each beginning of passed filters and one failed is an interval on which it is removed
at that step.  The counts are added at the interval's begin, taken off at its end, and a running sum
over the ranks of each step gives what is removed there in every order.

Rules: a null text is empty; words are maximal runs of characters other than space and U+0009 to
U+000D.  A null id is neither smaller nor larger than another and has no label, so rows without one
pass the filter on repeats.  Repeated rows of one id do not fail by each other.  Of several labels of
an id, one with quality 1 (toxic 1) makes it good (toxic).  Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as Over

from millrace.llm.store import named, staged

_BLANK = r"[\x20\x09-\x0D]+"

#: More orders than 8! are not meant to be read.
MOST_FILTERS = 8


def removals(filters: int) -> Iterator[tuple[int, int, int, int, int]]:
    """``(mask, step, filter, begin, end)``: ranks of orders in which documents of the mask go at the step.

    Bit ``i`` of a mask is filter ``i``; steps count from 1; the end is exclusive.
    """
    for mask in range(1, 1 << filters):
        passed = [f for f in range(filters) if not mask >> f & 1]
        for before in range(len(passed) + 1):
            for prefix in permutations(passed, before):
                for last in (f for f in range(filters) if mask >> f & 1):
                    free, rank = list(range(filters)), 0
                    for place, f in enumerate((*prefix, last)):
                        rank += free.index(f) * factorial(filters - 1 - place)
                        free.remove(f)
                    yield mask, before + 1, last, rank, rank + factorial(filters - 1 - before)


def interactions(counts: DataFrame, filters: str, sums: Sequence[str] = ("n", "good", "toxic"), part: str = "part") -> DataFrame:
    """One row for each part, order and step.

    ``counts`` has a ``part``, a ``mask`` of failed filters (bit 0 is the first letter of ``filters``)
    and columns to add up, the first of which counts documents.  The result has ``part``,
    ``filter_order``, ``step``, ``kept`` (after the step), ``removed``, ``redundant`` (failing the
    filter but removed earlier), ``unique_fails`` (failing this filter only), ``{x}_lost`` for every
    further sum, and ``shapley`` (the filter's removals added over all orders).
    """
    if not 1 <= len(filters) <= MOST_FILTERS or len(set(filters)) != len(filters):
        raise ValueError(f"one to {MOST_FILTERS} different letters")
    spark, k = counts.sparkSession, len(filters)
    orders = ["".join(p) for p in permutations(filters)]
    count, *others = sums
    totals = counts.groupBy(F.col(part).alias("part"), "mask").agg(*[F.sum(c).cast("long").alias(c) for c in sums])
    # Static tables of the number of filters alone.
    spans = spark.createDataFrame(list(removals(k)), "mask int, step int, filter int, begin int, end int")
    steps = spark.createDataFrame(
        [(rank, order, i + 1, filters.index(f)) for rank, order in enumerate(orders) for i, f in enumerate(order)],
        "rank int, filter_order string, step int, filter int",
    )
    edges = F.explode(
        F.array(
            F.struct(F.col("begin").alias("rank"), F.lit(1).alias("sign")),
            F.struct(F.col("end").alias("rank"), F.lit(-1).alias("sign")),
        )
    ).alias("edge")
    deltas = (
        totals.join(F.broadcast(spans), "mask")
        .select("part", "step", *sums, edges)
        .groupBy("part", "step", F.col("edge.rank").alias("rank"))
        .agg(*[F.sum(F.col(c) * F.col("edge.sign")).alias(c) for c in sums])
    )
    # Of each part: all documents, those that fail each filter, and those that fail it alone.
    of_part = (
        totals.groupBy("part")
        .agg(
            F.sum(count).alias("documents"),
            F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(F.lit(1 << f)) != 0, F.col(count)).otherwise(0)) for f in range(k)]).alias("fails"),
            F.array(*[F.sum(F.when(F.col("mask") == 1 << f, F.col(count)).otherwise(0)) for f in range(k)]).alias("alone"),
        )
    )
    grid = of_part.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k)))).join(F.broadcast(steps), "step")
    along = Over.partitionBy("part", "step").orderBy("rank").rowsBetween(Over.unboundedPreceding, Over.currentRow)
    by_filter = Over.partitionBy("part", "filter")
    down = Over.partitionBy("part", "rank").orderBy("step").rowsBetween(Over.unboundedPreceding, Over.currentRow)
    found = grid.join(deltas, ["part", "step", "rank"], "left").select(
        "*", *[F.sum(F.coalesce(F.col(c), F.lit(0))).over(along).alias(f"{c}_lost") for c in sums]
    )
    removed = F.col(f"{count}_lost")
    return found.select(
        "part",
        "filter_order",
        "step",
        (F.col("documents") - F.sum(removed).over(down)).alias("kept"),
        removed.alias("removed"),
        (F.col("fails")[F.col("filter")] - removed).alias("redundant"),
        F.col("alone")[F.col("filter")].alias("unique_fails"),
        *[F.col(f"{c}_lost") for c in others],
        F.sum(removed).over(by_filter).alias("shapley"),
    )


def text_failures(text: Column) -> list[Column]:
    """Few words, few different words, many capitals, a symbol: the filters A to D."""
    words = F.filter(F.split(text, _BLANK), lambda w: w != "")
    n = F.size(words).cast("long")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return [
        n < 200,
        2 * F.size(F.array_distinct(words)) < n,
        100 * capitals.cast("long") > 3 * F.length(text),
        text.rlike(r"[#$%&*|]"),
    ]


def masks(docs: DataFrame, labels: DataFrame, part: str = "lang", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the filters A to E that they fail, E being a repeat of a smaller id's text.

    Copies are counted together before they are brought together, so a text may have any number.
    """
    rows = named(docs, doc_id, text, part).toDF("id", "text", "part")
    body = F.coalesce("text", F.lit(""))
    flags = text_failures(body)
    mask = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(flags)), F.lit(0))
    measured = staged(
        rows.select(
            "id", F.unhex(F.md5(body)).alias("same"), F.coalesce("part", F.lit("")).alias("part"), mask.cast("int").alias("mask")
        ),
        "failed-filters",
    )
    known = (
        named(labels, doc_id, "quality", "toxic")
        .toDF("id", "quality", "toxic")
        .filter(F.col("id").isNotNull())
        .groupBy("id")
        .agg(
            F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).cast("int").alias("good"),
            F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).cast("int").alias("toxic"),
        )
    )
    label = [F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    # Copies are counted before they meet: rows of an id, then rows of one text and class, all and those of its smallest id.
    each = measured.filter(F.col("id").isNotNull()).groupBy("id", "same", "part", "mask").agg(F.count("*").alias("n"))
    classes = (
        each.join(known, "id", "left")
        .groupBy("same", "part", "mask", *label)
        .agg(F.sum("n").alias("n"), F.min("id").alias("least"), F.min_by("n", "id").alias("n_least"))
    )
    least = F.min("least").over(Over.partitionBy("same"))  # a row for each part and label at most
    first = F.when(F.col("least") == least, F.col("n_least")).otherwise(0)
    split = classes.withColumn("first", first).select(
        "part",
        "good",
        "toxic",
        F.explode(
            F.array(
                F.struct("mask", F.col("first").alias("n")),
                F.struct(F.col("mask").bitwiseOR(16).alias("mask"), (F.col("n") - F.col("first")).alias("n")),
            )
        ).alias("as"),
    )
    no_id = measured.filter(F.col("id").isNull()).groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic")
    )
    with_id = split.groupBy("part", F.col("as.mask").alias("mask")).agg(
        F.sum("as.n").alias("n"),
        F.sum(F.col("as.n") * F.col("good")).alias("good"),
        F.sum(F.col("as.n") * F.col("toxic")).alias("toxic"),
    )
    return with_id.unionByName(no_id)
