"""Documents whose sets of word n-grams are similar, by a MinHash LSH forest and exact checks.

Every tree of the forest orders the documents by a sequence of MinHash values; documents with the
same first values share a prefix of its trie.  Prefixes of a depth are matched in all trees and the
pairs verified exactly; from the similarities found follows how many pairs a depth misses
(Horvitz-Thompson), and the prefixes are shortened until the estimated recall reaches the target in
every band of similarity, so that many near-equal pairs do not hide what is missed at the threshold.

Equal sets are one class from the start.  A group of documents that share a prefix in several
trees is verified once; a pair that meets in several groups counts in the first.  A group larger
than a block is verified block against block, so no task holds more than two blocks, no pair
becomes a row, and no link is lost.

Rules: words are runs outside U+0020 and U+0009 to U+000D, unchanged; a text with fewer words
than an n-gram has its whole word sequence as the only one; a text without words (null, empty) is
alone in its class, and so is a row without an id; similarity of the threshold counts as linked;
repeated rows are copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import words as W
from millrace.llm.components import components
from millrace.llm.memory import lean
from millrace.llm.store import named, staged

SIZE = 5
THRESHOLD = 0.8
TREES = 16
#: Depths that are matched, from the deepest on.
DEPTHS = (5, 4, 3)
TARGET_RECALL = 0.998
#: Recall is estimated by itself where similarity passes these shares of the way from the threshold to 1.
BANDS = (0.0, 0.125, 0.25, 0.5)
#: Sets verified against each other at once, and columns of their product.
BLOCK = 512
COLUMNS = 4096
_WORD = r"[^\x20\x09-\x0D]"
#: Shingles hashed at once by all functions.
SLICE = 1 << 17


def recall(similarity: np.ndarray | float, depth: int) -> np.ndarray | float:
    """The chance that a pair shares a prefix of ``depth`` in some tree."""
    return 1 - (1 - similarity**depth) ** TREES


def shingle_sets(found: W.Words, size: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    hashes = found.hashes()
    grams = W.ngrams(hashes, size)
    out = []
    for b, e in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        if e - b >= size:
            out.append(np.unique(grams[b : e - size + 1]))
        else:
            out.append(W.ngrams(hashes[b:e], e - b, 1)[:1] if e > b else grams[:0])
    return out


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """``TREES * max(DEPTHS)`` MinHash values of each set (rows); empty sets get the largest value."""
    count = TREES * max(DEPTHS)
    factors = np.random.default_rng(3).integers(1, 1 << 63, count, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.full((len(sets), count), ~np.uint64(0))
    i = 0
    while i < len(sets):
        j, held = i, 0
        while j < len(sets) and (j == i or held + len(sets[j]) <= SLICE):
            held += len(sets[j])
            j += 1
        some = [k for k in range(i, j) if len(sets[k])]
        if some:
            flat = np.concatenate([sets[k] for k in some])
            begins = np.cumsum([0] + [len(sets[k]) for k in some[:-1]])
            for c, factor in enumerate(factors):
                out[some, c] = np.minimum.reduceat(flat * factor, begins)
        i = j
    return out


def _key(grams: np.ndarray) -> bytes | None:
    """128 bits that tell a set from another."""
    if not len(grams):
        return None
    one = W.mix(grams + np.uint64(len(grams))).sum(dtype=np.uint64)
    two = W.mix(grams ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
    return int(one).to_bytes(8, "big") + int(two).to_bytes(8, "big")


def _digest(text: str) -> Column:
    """Tells the texts of one id apart."""
    return F.unhex(F.md5(F.col(text)))


def sketches(df: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """``id, key, digest`` and the prefix hashes of each depth, ``p<depth> array<bigint>``, one for each tree."""
    rows = named(df, doc_id, text).toDF("id", "text").withColumn("digest", _digest("text"))
    kind = rows.schema["id"].dataType.simpleString()

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, prefixes = [], {d: [] for d in DEPTHS}
            for _, _, found in W.blocks(batch.column(1)):
                sets = shingle_sets(found, size)
                keys += [_key(s) for s in sets]
                values = _signatures(sets).reshape(len(sets), TREES, max(DEPTHS))
                chain = np.broadcast_to(np.arange(TREES, dtype=np.uint64), values.shape[:2])
                for d in range(max(DEPTHS)):
                    chain = W.mix(chain * np.uint64(0x9E3779B97F4A7C15) + values[:, :, d])
                    if d + 1 in prefixes:
                        prefixes[d + 1].append(chain.astype(np.int64))
            columns = [batch.column(0), pa.array(keys, pa.binary()), batch.column(2)]
            for d in DEPTHS:
                flat = np.concatenate(prefixes[d]).ravel() if prefixes[d] else np.zeros(0, np.int64)
                ends = pa.array(np.arange(0, len(flat) + 1, TREES), pa.int32())
                columns.append(pa.ListArray.from_arrays(ends, pa.array(flat)))
            yield pa.RecordBatch.from_arrays(columns, ["id", "key", "digest", *(f"p{d}" for d in DEPTHS)])

    return rows.mapInArrow(run, f"id {kind}, key binary, digest binary, " + ", ".join(f"p{d} array<bigint>" for d in DEPTHS))


def _groups(classes: DataFrame, depth: int, deeper: int | None) -> DataFrame:
    """``key, groups``: the sets of documents that a document shares a prefix with, as (tree, group, size).

    A group that all shares a prefix of the depth ``deeper``, done before, as well has no new pair and is left out.
    """
    longer = F.col(f"p{deeper}") if deeper else F.col(f"p{depth}")
    both = F.posexplode(F.arrays_zip(F.col(f"p{depth}").alias("prefix"), longer.alias("longer"))).alias("tree", "at")
    places = classes.select("key", both).select("key", "tree", "at.prefix", "at.longer")
    fresh = (F.min("longer") != F.max("longer")) if deeper else F.lit(True)
    shared = (
        places.groupBy("tree", "prefix")
        .agg(F.count("*").alias("size"), F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("sum"), fresh.alias("fresh"))
        .filter("size > 1 and fresh")
        .select("tree", "prefix", "size", F.xxhash64("sum", "size").alias("group"))
    )
    return (
        places.join(shared, ["tree", "prefix"])
        .groupBy("key")
        .agg(F.collect_list(F.struct("tree", "group", "size")).alias("groups"))  # one for each tree at most
    )


_UNITS = "group bigint, low int, high int, block int, tree int, key binary, copies bigint, now binary, before binary, grams binary"


def _units(rows: DataFrame, size: int) -> DataFrame:
    """A row for every block pair that a document's set is needed in."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, copies = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            groups, now, before = (batch.column(i).to_pylist() for i in (3, 4, 5))
            for begin, _, found in W.blocks(batch.column(0)):
                out = []
                for i, grams in enumerate(shingle_sets(found, size), begin):
                    if _key(grams) != keys[i]:
                        continue  # another row with the same id
                    firsts: dict[int, tuple[int, int]] = {}
                    for g in groups[i]:
                        firsts[g["group"]] = min(firsts.get(g["group"], (TREES, 0)), (g["tree"], g["size"]))
                    data = grams.tobytes()
                    codes = [np.array(x, np.int64).tobytes() if x is not None else b"" for x in (now[i], before[i])]
                    for group, (tree, members) in firsts.items():
                        blocks = -(-members // BLOCK)
                        own = int.from_bytes(keys[i][:8], "big") % blocks
                        for other in range(blocks):
                            out.append((group, min(own, other), max(own, other), own, tree, keys[i], copies[i], *codes, data))
                            if len(out) >= 2000:
                                yield _unit_batch(out)
                                out = []
                if out:
                    yield _unit_batch(out)

    return rows.select("text", "key", "copies", "groups", "now", "before").mapInArrow(run, _UNITS)


_UNIT_SCHEMA = pa.schema(
    [("group", pa.int64()), *((n, pa.int32()) for n in ("low", "high", "block", "tree")), ("key", pa.binary()),
     ("copies", pa.int64()), *((n, pa.binary()) for n in ("now", "before", "grams"))]
)


def _unit_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _UNIT_SCHEMA)], schema=_UNIT_SCHEMA)


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """How many n-grams every two sets share."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[code]
    owner, column = owner[keep], number[code[keep]]
    total = np.zeros((len(sets), len(sets)), np.float64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for begin in range(0, int(shared.sum()), COLUMNS):
        low, high = np.searchsorted(column, [begin, begin + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[low:high], column[low:high] - begin] = 1
        total += part @ part.T
    return total


def _verify(unit: list[dict], threshold: float) -> list[tuple[bytes, int, bytes, list[float], list[int]]]:
    """``(key, links, root, found, pairs)`` of the documents of a unit that have links there.

    ``pairs`` counts the links by ``BANDS``, ``found`` by band and depth the links they stand for.
    """
    sets = [np.frombuffer(r["grams"], np.uint64) for r in unit]
    size = np.array([len(s) for s in sets], np.float64)
    common = _common(sets)
    either = size[:, None] + size[None, :] - common
    linked = common >= threshold * either - 1e-9
    np.fill_diagonal(linked, False)
    if unit[0]["low"] != unit[0]["high"]:
        block = np.array([r["block"] for r in unit])
        linked &= block[:, None] != block[None, :]
    now = np.stack([np.frombuffer(r["now"], np.int64) for r in unit])
    for tree in range(unit[0]["tree"]):
        linked &= now[:, None, tree] != now[None, :, tree]  # counted in that tree's group
    if unit[0]["before"]:
        old = np.stack([np.frombuffer(r["before"], np.int64) for r in unit])
        for tree in range(TREES):
            linked &= old[:, None, tree] != old[None, :, tree]  # counted at a greater depth
    some = np.flatnonzero(linked.any(axis=1))
    if not len(some):
        return []
    copies = np.array([r["copies"] for r in unit], np.float64)
    links = linked @ copies
    # For each band and depth, how many pairs those found stand for.
    one, other = np.nonzero(linked)
    alike = np.clip(common[one, other] / np.maximum(either[one, other], 1), threshold, 1)
    band = np.searchsorted([threshold + (1 - threshold) * b for b in BANDS], alike, "right") - 1
    cell = one * len(BANDS) + band
    pairs = np.bincount(cell, minlength=len(unit) * len(BANDS)).reshape(len(unit), -1)
    found = np.stack(
        [np.bincount(cell, 1 / recall(alike, d), len(unit) * len(BANDS)).reshape(len(unit), -1) for d in DEPTHS], axis=2
    )
    # Within the unit, every document points at the least key that it reaches.
    rank = np.argsort(np.argsort([r["key"] for r in unit]))
    label = rank.copy()
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], len(unit)).min(axis=1))
        if (least == label).all():
            break
        label = least
    by_rank = sorted(r["key"] for r in unit)
    return [
        (unit[i]["key"], int(links[i]), by_rank[label[i]], found[i].ravel().tolist(), pairs[i].tolist()) for i in some.tolist()
    ]


def _links(units: DataFrame, threshold: float) -> DataFrame:
    """``key, links, root, found, pairs`` of every unit; rows of a unit lie in one partition, one unit is held at a time."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                yield from batch.slice(begin, 256).to_pylist()

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for _, unit in groupby(rows(batches), lambda r: (r["group"], r["low"], r["high"])):
            own = {r["key"]: r for r in unit}  # rows that occur several times bring their set as often
            out += _verify(list(own.values()), threshold)
            if len(out) >= 10_000:
                yield _link_batch(out)
                out = []
        if out:
            yield _link_batch(out)

    dealt = units.repartition("group", "low", "high").sortWithinPartitions("group", "low", "high")
    return dealt.mapInArrow(run, "key binary, links bigint, root binary, found array<double>, pairs array<bigint>")


def _link_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["key", "links", "root", "found", "pairs"]
    )


def _classes(df: DataFrame, doc_id: str, text: str, size: int, threshold: float, target: float) -> tuple[DataFrame, DataFrame]:
    """The sketches of all rows, and for each set ``key, rep, head, n``: its least id, the least ``(id, digest)`` of its class, and its links."""
    ids = staged(sketches(df, doc_id, text, size), "sketches")
    firsts = [F.first(f"p{d}").alias(f"p{d}") for d in DEPTHS]  # equal for equal keys
    classes = staged(
        ids.filter("key is not null and id is not null").groupBy("key").agg(
            F.min("id").alias("rep"), F.min(F.struct("id", "digest")).alias("least"), F.count("*").alias("copies"), *firsts
        ),
        "classes",
    )
    texts = named(df, doc_id, text).toDF("id", "text")
    parts: list[DataFrame] = []
    deeper = None
    for depth in DEPTHS:
        before = F.col(f"p{deeper}") if deeper else F.lit(None).cast("array<bigint>")
        members = classes.select("key", "rep", "copies", F.col(f"p{depth}").alias("now"), before.alias("before")).join(
            _groups(classes, depth, deeper), "key"
        )
        rows = texts.join(members, texts["id"] == members["rep"])
        part = staged(_links(_units(rows, size), threshold), "links")
        parts.append(part)
        total = parts[0]
        for other in parts[1:]:
            total = total.unionByName(other)
        at = DEPTHS.index(depth)
        sums = [F.sum(F.col(name)[i]) for b in range(len(BANDS)) for name, i in (("pairs", b), ("found", b * len(DEPTHS) + at))]
        seen = total.agg(*sums).first()
        if all(not n or n >= target * stands for n, stands in zip(seen[::2], seen[1::2])):
            break
        deeper = depth
    linked = staged(total.groupBy("key").agg(F.sum("links").alias("links")), "linked")
    roots = components(total.select("key", "root"), "key", "root")
    reps = classes.select("key", "rep", "least", "copies")
    located = reps.join(linked, "key", "left").join(roots.withColumnRenamed("node", "key"), "key", "left")
    heads = located.filter("root is not null").groupBy("root").agg(F.min("least").alias("head"))
    return ids, located.join(heads, "root", "left").select(
        "key",
        "rep",
        F.coalesce("head", "least").alias("head"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"),
    )


def similar(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, threshold: float = THRESHOLD,
    target: float = TARGET_RECALL,
) -> DataFrame:
    """``doc_id, class_id, copy_id, n_links`` for every row.

    ``class_id`` is the least id of the documents reached by links, ``copy_id`` the least id with the
    same set of n-grams, ``n_links`` the number of other rows that are similar, copies included.
    """
    ids, placed = _classes(df, doc_id, text, size, threshold, target)
    return (
        ids.select("id", F.when(F.col("id").isNotNull(), F.col("key")).alias("key"))
        .join(placed, "key", "left")
        .select(
            F.col("id").alias(doc_id),
            F.coalesce("head.id", "id").alias("class_id"),
            F.coalesce("rep", "id").alias("copy_id"),
            F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        )
    )


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one row of each class: the one of the least id, of several texts of that id the one of the least digest.

    Rows without an id, and rows without words, stay.  Of rows that are equal in id and text one stays.
    """
    ids, placed = _classes(df, doc_id, text, SIZE, THRESHOLD, TARGET_RECALL)
    rows = ids.filter("key is not null and id is not null").select("key", "id", "digest")
    gone = (
        rows.join(placed.select("key", "head"), "key")
        .filter(F.struct("id", "digest") != F.col("head"))
        .select(F.col("id").alias("__id"), F.col("digest").alias("__gone"))
        .distinct()
    )
    marked = df.withColumn("__digest", _digest(text))
    left = marked.join(gone, (marked[doc_id] == gone["__id"]) & (marked["__digest"] == gone["__gone"]), "left_anti")
    known = left[doc_id].isNotNull() & F.coalesce(left[text].rlike(_WORD), F.lit(False))
    return left.filter(known).dropDuplicates([doc_id, text]).unionByName(left.filter(~known)).drop("__digest")
