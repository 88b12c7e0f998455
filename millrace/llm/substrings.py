"""Repeated passages: words covered by a window that also starts in a document of a lower id.

Every window of consecutive words is dealt by the least hash among its short n-grams, so equal
windows meet.  Only windows whose least hash occurs in several documents matter; runs of them are
cut out as segments and dealt to shards.  A shard's distinct segments are indexed by a compressed
FM-index, and backward search gives their matching statistics against lower documents: intervals
of at least a window are repeats.

Documents of the same word sequence are one from the start: those with a higher id are repeats as
a whole.  An n-gram of more documents than a shard may hold is dealt by whole windows instead,
whose lowest document is an aggregate that is combined before the shuffle.

Rules: words are runs outside U+0020 and U+0009 to U+000D, unchanged; null text has none; a text
shorter than the window keeps everything; rows without an id neither remove nor lose words; rows
of one id do not remove each other's words; windows are judged on the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import words as W
from millrace.llm.fmindex import FMIndex, covered_intervals
from millrace.llm.memory import lean, lean_column
from millrace.llm.store import named, staged

WINDOW = 50
#: Words of the n-grams whose hashes deal the windows.
GRAM = 8
#: Words that a shard holds, roughly, and documents of one n-gram that go to a shard at most.
SHARD_WORDS = 300_000
HOT_DOCUMENTS = 20_000
#: Windows of a segment at most.
SEGMENT = 64

_EMPTY = hashlib.sha256(b"").hexdigest()


def _least(found: W.Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Where windows start, and the least n-gram hash of each."""
    grams = W.ngrams(found.hashes(), min(GRAM, window))
    at = np.flatnonzero(found.room() >= window)
    if not len(at):
        return at, grams[:0]
    span, width = window - min(GRAM, window) + 1, 1
    while 2 * width <= span:
        grams = np.minimum(grams[: len(grams) - width], grams[width:])
        width *= 2
    return at, np.minimum(grams[at], grams[at + span - width])


def _digest(found: W.Words, text: int) -> bytes:
    """128 bits that tell a word sequence from others."""
    b, e = found.first[text], found.first[text + 1]
    joined = b" ".join(_cut(found, b, e))
    return hashlib.blake2b(joined, digest_size=16).digest()


def _cut(found: W.Words, b: int, e: int) -> list[bytes]:
    return found.data[found.starts[b] : found.ends[e - 1]].tobytes().split() if e > b else []


def scan(df: DataFrame, window: int) -> DataFrame:
    """``id, digest, n_words, sha256`` of the words of every row, and the distinct ``anchors`` of its windows."""
    kind = df.schema["id"].dataType.simpleString()

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, counts, hashes, anchors = [], [], [], []
            for _, _, found in W.blocks(batch.column(1)):
                at, least = _least(found, window)
                text = found.text[at] if len(at) else at
                new = np.flatnonzero((np.diff(least, prepend=least[:1] + np.uint64(1)) != 0) | (np.diff(text, prepend=-1) != 0))
                cut = np.searchsorted(text[new], np.arange(len(found.first)))
                least = least[new]
                for i, (b, e) in enumerate(zip(found.first[:-1].tolist(), found.first[1:].tolist())):
                    joined = b" ".join(_cut(found, b, e))
                    digests.append(hashlib.blake2b(joined, digest_size=16).digest())
                    hashes.append(hashlib.sha256(joined).hexdigest())
                    anchors.append(np.unique(least[cut[i] : cut[i + 1]]).astype(np.int64))
                counts.append(found.counts)
            ends = np.cumsum([0, *(len(a) for a in anchors)])
            flat = np.concatenate(anchors) if anchors else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(digests, pa.binary()),
                    pa.array(np.concatenate(counts).astype(np.int64) if counts else [], pa.int64()),
                    pa.array(hashes, pa.string()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                ],
                ["id", "digest", "n_words", "sha256", "anchors"],
            )

    return df.mapInArrow(run, f"id {kind}, digest binary, n_words bigint, sha256 string, anchors array<bigint>")


def _runs(
    found: W.Words, window: int, wanted: list[list[int]], digests: list[bytes]
) -> Iterator[tuple[int, int, int, int]]:
    """``(text, anchor, first window, end window)`` of the runs of windows with a wanted least hash.

    A text that is not the one of its digest is another row of the same id and has none.
    """
    at, least = _least(found, window)
    if not len(at):
        return
    least = least.astype(np.int64)
    text = found.text[at]
    new = np.flatnonzero((np.diff(least, prepend=least[:1] + 1) != 0) | (np.diff(text, prepend=-1) != 0))
    end = np.append(new[1:], len(at))
    cut = np.searchsorted(text[new], np.arange(len(found.first)))
    for i, own in enumerate(wanted):
        if not own or not _own(found, i, digests[i]):
            continue
        b, e = cut[i], cut[i + 1]
        for r in (b + np.flatnonzero(np.isin(least[new[b:e]], np.array(own, np.int64)))).tolist():
            for first in range(int(new[r]), int(end[r]), SEGMENT):
                last = min(first + SEGMENT, int(end[r]))
                yield i, int(least[new[r]]), int(at[first]), int(at[last - 1]) + 1


def _segments(docs: DataFrame, window: int, shards: int) -> DataFrame:
    """``shard, id, digest, first, symbols``: the runs of windows with a shared least hash."""
    kind = docs.schema["id"].dataType.simpleString()
    names = ["shard", "id", "digest", "first", "symbols"]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, wanted = batch.column(1).to_pylist(), batch.column(3).to_pylist()
            for begin, end, found in W.blocks(batch.column(2)):
                symbols = found.hashes()
                rows, shard, first, data = [], [], [], []
                for i, anchor, a, b in _runs(found, window, wanted[begin:end], digests[begin:end]):
                    rows.append(begin + i)
                    shard.append(anchor % shards)
                    first.append(a - int(found.first[i]))
                    data.append(symbols[a : b + window - 1].tobytes())
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), batch.column(0).take(take), batch.column(1).take(take), pa.array(first, pa.int64()), pa.array(data, pa.binary())],
                    names,
                )

    rows = docs.select("id", "digest", "text", "shared")
    return rows.mapInArrow(run, f"shard int, id {kind}, digest binary, first bigint, symbols binary")


def _search(rows: list[tuple], window: int) -> Iterator[tuple]:
    """``(id, digest, begin, end)`` of the repeats in one shard of ``(id, digest, first, symbols)``."""
    lowest: dict[bytes, object] = {}
    for doc, _, _, data in rows:
        if data not in lowest or doc < lowest[data]:
            lowest[data] = doc
    sequences = list(lowest)
    ids = sorted(set(lowest.values()))
    rank = {doc: i for i, doc in enumerate(ids)}
    owners = np.array([rank[lowest[s]] for s in sequences])
    arrays = [np.frombuffer(s, np.uint64) for s in sequences]
    intervals: dict[bytes, list[tuple[int, int]]] = {}
    if len(ids) > 1:
        index = FMIndex(arrays, owners)
        lengths = np.array([len(a) for a in arrays])
        for part in covered_intervals(index, lengths, owners, window):
            for s, b, e in part.T.tolist():
                intervals.setdefault(sequences[s], []).append((b, e))
    for doc, digest, first, data in rows:
        if doc != lowest[data]:
            yield doc, digest, first, first + len(data) // 8
        else:
            for b, e in intervals.get(data, ()):
                yield doc, digest, first + b, first + e


def _repeats(segments: DataFrame, window: int) -> DataFrame:
    """``id, digest, begin, end`` of the repeats; one shard is held at a time."""
    kind = segments.schema["id"].dataType.simpleString()
    names = ["id", "digest", "begin", "end"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                yield from zip(*(c.to_pylist() for c in batch.slice(start, 1000).columns))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = None
        for _, shard in groupby(rows(batches), lambda r: r[0]):
            found = list(_search([r[1:] for r in shard], window))
            for start in range(0, len(found), 20_000):
                columns = zip(*found[start : start + 20_000])
                kinds = kinds or (None, pa.binary(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    dealt = segments.repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(run, f"id {kind}, digest binary, begin bigint, end bigint")


def _hot_repeats(docs: DataFrame, window: int) -> DataFrame:
    """The repeats among windows of hot n-grams, by the lowest document of each whole window."""
    kind = docs.schema["id"].dataType.simpleString()
    names = ["id", "digest", "begin", "high", "low"]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, wanted = batch.column(1).to_pylist(), batch.column(3).to_pylist()
            for begin, end, found in W.blocks(batch.column(2)):
                keys = [W.ngrams(found.hashes(seed), window, seed).astype(np.int64) for seed in (0, 1)]
                for i, _, a, b in _runs(found, window, wanted[begin:end], digests[begin:end]):
                    n, own = b - a, pa.array([begin + i] * (b - a), pa.int64())
                    first = np.arange(a, b) - int(found.first[i])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(own), batch.column(1).take(own), pa.array(first[:n]), *(pa.array(k[a:b]) for k in keys)], names
                    )

    rows = docs.select("id", "digest", "text", "hot").mapInArrow(
        run, f"id {kind}, digest binary, begin bigint, high bigint, low bigint"
    )
    lowest = rows.groupBy("high", "low").agg(F.min("id").alias("least"))
    return (
        rows.join(lowest, ["high", "low"])
        .filter("id > least")
        .select("id", "digest", "begin", (F.col("begin") + window).alias("end"))
    )


def repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Two tables: ``id, digest, n_words, sha256, is_copy`` of every row, and those with repeats.

    The second has ``id, digest, text, spans``; spans are word ranges ``(begin, end)`` to remove.  A
    copy repeats a document of a lower id word by word and has at least a window of words.
    """
    rows = named(df, doc_id, text).toDF("id", "text")
    scanned = staged(scan(rows, window), "words")
    # The first row of each word sequence: a hot text is combined before the shuffle.
    firsts = scanned.filter("id is not null and n_words >= %d" % window).groupBy("digest").agg(F.min("id").alias("first"))
    firsts = staged(firsts, "firsts")
    docs = scanned.drop("anchors").join(firsts, "digest", "left").withColumn("is_copy", F.coalesce(F.col("id") > F.col("first"), F.lit(False)))
    anchors = (
        scanned.join(firsts, (scanned["digest"] == firsts["digest"]) & (scanned["id"] == firsts["first"]))
        .select("id", scanned["digest"], F.explode("anchors").alias("anchor"))
        .distinct()
    )
    anchors = staged(anchors, "anchors")
    common = staged(anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1"), "common")
    size = common.agg(F.sum("n"), F.max("n")).first()
    shards = max(1, -(-int(size[0] or 0) * (window + window // 2) // SHARD_WORDS))
    is_hot = F.col("n") > HOT_DOCUMENTS
    wanted = (
        anchors.join(common, "anchor")
        .groupBy("id", "digest")
        .agg(
            F.collect_list(F.when(~is_hot, F.col("anchor"))).alias("shared"),  # of one text
            F.collect_list(F.when(is_hot, F.col("anchor"))).alias("hot"),
        )
    )
    candidates = staged(rows.join(wanted, "id"), "candidates")
    found = _repeats(_segments(candidates, window, shards), window)
    if (size[1] or 0) > HOT_DOCUMENTS:
        found = found.unionByName(_hot_repeats(candidates, window))
    spans = found.groupBy("id", "digest").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))  # of one text
    # Another row of the same id may have other words; users compare the digest.
    return docs, candidates.drop("shared", "hot").join(spans, ["id", "digest"])


def _dropped(found: W.Words, text: int, spans: list[dict]) -> np.ndarray:
    """Which words of a text the spans cover."""
    b, e = int(found.first[text]), int(found.first[text + 1])
    mark = np.zeros(e - b + 1, np.int64)
    for s in spans:
        mark[s["begin"]] += 1
        mark[s["end"]] -= 1
    return np.cumsum(mark[:-1]) > 0


def _own(found: W.Words, text: int, digest: bytes) -> bool:
    return _digest(found, text) == digest


def kept_words(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row, the digest being that of the kept words."""
    docs, cut = repeats(df, doc_id, text, window)
    kind = docs.schema["id"].dataType.simpleString()
    names = ["id", "digest", "n_removed", "kept"]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, digests = batch.column(3).to_pylist(), batch.column(1).to_pylist()
            for begin, end, found in W.blocks(batch.column(2)):
                at, removed, kept = [], [], []
                for i in range(end - begin):
                    if not _own(found, i, digests[begin + i]):
                        continue
                    drop = _dropped(found, i, spans[begin + i])
                    words = _cut(found, int(found.first[i]), int(found.first[i + 1]))
                    at.append(begin + i)
                    removed.append(int(drop.sum()))
                    left = b" ".join([w for w, d in zip(words, drop.tolist()) if not d])
                    kept.append(hashlib.sha256(left).hexdigest())
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names
                )

    judged = cut.select("id", "digest", "text", "spans").mapInArrow(run, f"id {kind}, digest binary, n_removed bigint, kept string")
    judged = judged.distinct()
    # The null-safe match keeps rows without an id; they have no repeats.
    joined = docs.join(judged, ["id", "digest"], "left")
    return joined.select(
        F.col("id").alias(doc_id),
        "n_words",
        F.when(F.col("is_copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("is_copy"), F.lit(_EMPTY)).otherwise(F.coalesce("kept", "sha256")).alias("kept_sha256"),
    )


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``df`` with the repeated words cut out of ``text``, and without the rows that lose all their words.

    A word goes with the blanks behind it; rows that lose nothing keep their text as it is.
    """
    docs, cut = repeats(df, doc_id, text, window)
    none = F.lit(None).cast("array<struct<begin:bigint,end:bigint>>")
    marks = (
        docs.filter("is_copy").select("id", "digest", none.alias("spans")).distinct()
        .unionByName(cut.select("id", "digest", "spans").dropDuplicates(["id", "digest"]))
        .groupBy("id").agg(F.collect_list(F.struct("digest", "spans")).alias("__marks"))  # one for each text of an id
        .withColumnRenamed("id", "__id")
    )
    marked = df.join(marks, df[doc_id] == marks["__id"], "left").drop("__id")

    @F.arrow_udf("string")
    @lean_column
    def left(column: pa.Array, marks: pa.Array) -> pa.Array:
        out: list[str | None] = column.to_pylist()
        todo = [i for i, m in enumerate(marks) if m.is_valid]
        some = column.take(pa.array(todo, pa.int64()))
        for begin, end, found in W.blocks(some):
            for i in range(end - begin):
                digest = _digest(found, i)
                for mark in marks[todo[begin + i]].as_py():
                    if mark["digest"] == digest:
                        out[todo[begin + i]] = _without(found, i, mark["spans"])
        return pa.array(out, pa.string())

    gone = F.col("__marks").isNotNull() & F.col("__left").isNull()
    # Marked so that Spark does not cut once more, in workers of its own, for the filter.
    uncovered = left.asNondeterministic()(F.col(text), F.col("__marks"))
    cuts = marked.withColumn("__left", F.when(F.col("__marks").isNull(), F.col(text)).otherwise(uncovered))
    return cuts.filter(~gone).withColumn(text, F.col("__left")).select(*df.columns)


def _without(found: W.Words, text: int, spans: list[dict] | None) -> str | None:
    """A text without its repeated words; None if no word is left.  No spans: the text is a copy."""
    if spans is None:
        return None
    b, e = int(found.first[text]), int(found.first[text + 1])
    keep = np.flatnonzero(~_dropped(found, text, spans)) + b
    if not len(keep):
        return None
    low, high = int(found.offsets[text]), int(found.offsets[text + 1])
    stop = np.append(found.starts[b + 1 : e], high)  # where the blanks behind each word end
    parts = [found.data[low : found.starts[b]].tobytes()]
    cuts = np.flatnonzero(np.diff(keep) > 1) + 1
    for p, q in zip(np.append(0, cuts), np.append(cuts, len(keep))):
        parts.append(found.data[found.starts[keep[p]] : stop[keep[q - 1] - b]].tobytes())
    return b"".join(parts).decode("utf-8", "replace")
