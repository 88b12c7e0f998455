"""Tokens of two tokenizers laid side by side: groups, links, and how usual each link is.

Both tokenizers cut the same bytes.  In every block of texts two ``merge_asof`` joins, keyed by
document, find for each token's start the token of the other side that covers it; their union is
the set of overlapping pairs (links), since of two overlapping ranges one starts within the other.
Offsets at which tokens of both sides end cut a document into groups.  A link's count is the
number of links of the whole corpus between the same two ids.

Counts are looked up in two ways.  The most frequent pairs, at most ``FREQUENT`` whatever the size
of the corpus, are broadcast and looked up while the documents stream by; all other links meet
their counts in a join.  Both together are exact.

Rules: a text has no tokens, hence zeros and no groups, if it is null or empty or if the joined
bytes of either side are not a space and the text (a tokenizer that rewrites the text).  Special
tokens in a text are ordinary text.  Repeated rows and ids are documents of their own.  Only the
id and the text of a row are read, so further columns may have any name.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as Over
from tokenizers import Tokenizer

from millrace.llm import words as W
from millrace.llm.store import named, staged

#: Bytes of text aligned at once (or one text).
BLOCK_BYTES = 1 << 20
#: Pairs of ids broadcast with their counts, at most; the rest is joined.
FREQUENT = 400_000
#: Tokenizer files are sent to the executors whole and are a few megabytes; larger ones are refused.
FILE_BYTES = 64 << 20

#: The pattern of the library's byte-level pre-tokenizer (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LINKS = "array<struct<a: int, b: int, n: int>>"
_SUMS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint"


# -- tokenizers ------------------------------------------------------------------------------


@dataclass
class Side:
    """One tokenizer: ids of a space and each text, and the bytes of every id."""

    encode: Callable[[list[str]], list]
    data: np.ndarray  # the bytes of all ids, one after another
    offsets: np.ndarray

    @staticmethod
    def of(encode: Callable[[list[str]], list], tokens: list[bytes]) -> Side:
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        return Side(encode, np.frombuffer(b"".join(tokens), np.uint8), np.concatenate([[0], np.cumsum(sizes)]))

    def __len__(self) -> int:
        return len(self.offsets) - 1


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _ranked(config: dict, tokens: list[bytes]) -> dict[bytes, int] | None:
    """Ids by bytes, if merging the pair of the lowest joined id is what this tokenizer does.

    So it is when merges make ids in ascending order.  A token is then made by one merge only: had
    another pair with the same bytes come to stand side by side, the merges of lower rank, which
    know nothing of their surroundings, would have made the token's own pair of it.
    """
    model = config["model"]
    cut = config["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and config["normalizer"] is None and cut.get("type") == "ByteLevel"
    odd = any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if not plain or odd or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return None
    joined = [m if isinstance(m, str) else "".join(m) for m in model["merges"]]
    made = [model["vocab"].get(j.replace(" ", "")) for j in joined]
    if None in made or any(a >= b for a, b in zip(made, made[1:])):
        return None
    ranks = {tokens[i]: i for i in model["vocab"].values() if tokens[i]}
    special = {t["content"].encode() for t in config.get("added_tokens", ())}
    ranks = {t: i for t, i in ranks.items() if t not in special}
    return ranks if len(made) + 256 == len(ranks) else None


def _byte_level(content: bytes) -> Side:
    config = json.loads(content)
    of_char = _byte_of_char()
    vocabulary = config["model"]["vocab"] | {t["content"]: t["id"] for t in config.get("added_tokens", ())}
    tokens = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        tokens[i] = bytes(of_char[c] for c in token) if all(c in of_char for c in token) else token.encode()
    ranks = _ranked(config, tokens)
    if ranks is not None:
        cutter = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return Side.of(lambda texts: [cutter.encode_ordinary(" " + t) for t in texts], tokens)
    library = Tokenizer.from_str(content.decode())
    library.encode_special_tokens = True
    return Side.of(lambda texts: [e.ids for e in library.encode_batch([" " + t for t in texts], add_special_tokens=False)], tokens)


def _pieces(content: bytes) -> Side:
    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    tokens = []
    for i in range(len(model)):
        piece = model.id_to_piece(i)
        tokens.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return Side.of(lambda texts: model.encode(texts, num_threads=1), tokens)


@lru_cache(maxsize=4)
def _side(content: bytes, kind: str) -> Side:
    return _byte_level(content) if kind == "json" else _pieces(content)


@dataclass
class Shared:
    """A tokenizer's file on the executors; ``.json`` is byte-level BPE, ``.model`` pieces that add the space themselves."""

    content: object
    kind: str

    @staticmethod
    def of(spark: SparkSession, path: str) -> Shared:
        kind = path.rsplit(".", 1)[-1]
        if kind not in ("json", "model"):
            raise ValueError(f"neither .json nor .model: {path}")
        with open(path, "rb") as file:
            content = file.read(FILE_BYTES + 1)
        if len(content) > FILE_BYTES:
            raise ValueError(f"more than {FILE_BYTES} bytes: {path}")
        return Shared(spark.sparkContext.broadcast(content), kind)

    def side(self) -> Side:
        return _side(self.content.value, self.kind)


# -- one block -------------------------------------------------------------------------------


@dataclass
class Tokens:
    """One side's tokens of the documents of a block; offsets count the block's bytes."""

    ids: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray


def _flat(ids: list) -> np.ndarray:
    """The lists of ``ids`` one after another."""
    return np.concatenate([np.asarray(x, np.int64) for x in ids]) if ids else np.zeros(0, np.int64)


def _spelled(side: Side, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of ``ids``."""
    total = int(sizes.sum())
    shift = np.repeat(side.offsets[ids] - (np.cumsum(sizes) - sizes), sizes)
    return side.data[shift + np.arange(total)]


def cut(texts: list[bytes], a: Side, b: Side) -> tuple[np.ndarray, Tokens, Tokens]:
    """Which of ``texts`` both sides spell as a space and the text, and their tokens.

    ``doc`` numbers the texts that are left.
    """
    readable, strings = [], []
    for i, text in enumerate(texts):
        try:
            string = text.decode()
        except UnicodeDecodeError:
            continue
        if string:
            readable.append(i)
            strings.append(string)
    found = [side.encode(strings) for side in (a, b)]
    good = np.ones(len(readable), bool)
    for side, ids in zip((a, b), found):
        flat = _flat(ids)
        sizes = np.diff(side.offsets)[flat]
        spelled = _spelled(side, flat, sizes).tobytes()
        at = np.concatenate([[0], np.cumsum(sizes)])
        ends = at[np.cumsum([len(x) for x in ids])] if ids else at[:0]
        begin = 0
        for i, end in enumerate(ends.tolist()):
            good[i] &= spelled[begin:end] == b" " + texts[readable[i]]
            begin = end
    left = np.flatnonzero(good)
    tokens = []
    for side, ids in zip((a, b), found):
        mine = [ids[i] for i in left]
        flat = _flat(mine)
        sizes = np.diff(side.offsets)[flat]
        end = np.cumsum(sizes)
        tokens.append(Tokens(flat, np.repeat(np.arange(len(mine)), [len(x) for x in mine]), end - sizes, end))
    return np.array(readable, np.int64)[left], *tokens


def overlaps(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of each pair whose ranges overlap."""
    left = pd.DataFrame({"doc": a.doc, "start": a.start, "at_a": np.arange(len(a.ids))})
    right = pd.DataFrame({"doc": b.doc, "start": b.start, "at_b": np.arange(len(b.ids))})
    forth = pd.merge_asof(left, right, on="start", by="doc")
    back = pd.merge_asof(right, left, on="start", by="doc")
    # A pair that starts at one place comes from both sides.
    from_a, of_b = back["at_a"].to_numpy(), back["at_b"].to_numpy()
    fresh = a.start[from_a] < b.start[of_b]
    return (
        np.concatenate([forth["at_a"].to_numpy(), from_a[fresh]]),
        np.concatenate([forth["at_b"].to_numpy(), of_b[fresh]]),
    )


@dataclass
class Groups:
    """Tokens between common ends; counts of each side's tokens, and groups before each document."""

    n_a: np.ndarray
    n_b: np.ndarray
    first: np.ndarray  # one more than documents


def grouped(a: Tokens, b: Tokens, docs: int) -> Groups:
    common = np.intersect1d(a.end, b.end, assume_unique=True)
    n_a, n_b = (np.diff(np.searchsorted(t.end, common, "right"), prepend=0) for t in (a, b))
    # A document's last bytes are a common end, so its last group ends where its last token does.
    last = a.end[np.searchsorted(a.doc, np.arange(docs), "right") - 1] if docs else a.end[:0]
    return Groups(n_a, n_b, np.concatenate([[0], np.searchsorted(common, last, "right")]))


@lru_cache(maxsize=2)
def _digits(ids: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimals of the numbers below ``ids`` with a place for what follows, and their lengths."""
    width = len(str(max(ids - 1, 0)))
    size = np.fromiter((len(str(i)) for i in range(ids)), np.int64, ids)
    table = np.zeros((ids, width + 1), np.uint8)
    table[:, :width] = np.array([str(i).ljust(width).encode() for i in range(ids)], f"S{width}").view(np.uint8).reshape(ids, width)
    return table, size


def digests(a: Tokens, b: Tokens, groups: Groups, ids: int) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` for each document."""
    before_a, before_b = np.cumsum(groups.n_a) - groups.n_a, np.cumsum(groups.n_b) - groups.n_b
    # Where each token stands when the groups are written one after another.
    at_a = np.arange(len(a.ids)) + np.repeat(before_b, groups.n_a)
    at_b = np.arange(len(b.ids)) + np.repeat(before_a + groups.n_a, groups.n_b)
    token = np.empty(len(at_a) + len(at_b), np.int64)
    token[at_a], token[at_b] = a.ids, b.ids
    mark = np.full(len(token), ord(","), np.uint8)
    mark[at_a[before_a + groups.n_a - 1]] = ord("|")
    group_ends = at_b[before_b + groups.n_b - 1]
    mark[group_ends] = ord(";")
    doc_ends = group_ends[groups.first[1:] - 1]
    table, size = _digits(ids)
    chars, width = table[token], size[token]
    chars[np.arange(len(token)), width] = mark
    width = width + 1
    width[doc_ends] -= 1
    text = chars[np.arange(chars.shape[1]) < width[:, None]].tobytes()
    ends = np.cumsum(width)[doc_ends].tolist()
    return [hashlib.sha256(text[begin:end]).hexdigest() for begin, end in zip([0, *ends], ends)]


def tallies(a: Tokens, b: Tokens, pairs: tuple[np.ndarray, np.ndarray], docs: int, ids_b: int) -> tuple[np.ndarray, ...]:
    """``(links of each document, a, b, n)``: a document's links counted by their two ids."""
    at_a, at_b = pairs
    bits = max(1, int(ids_b - 1).bit_length())
    high = max(1, int(a.ids.max(initial=0)).bit_length())
    key, n = np.unique((a.doc[at_a] << (bits + high)) | (a.ids[at_a] << bits) | b.ids[at_b], return_counts=True)
    mine = np.searchsorted(key >> (bits + high), np.arange(docs + 1))
    return np.diff(mine), (key >> bits) & ((1 << high) - 1), key & ((1 << bits) - 1), n


def _lists(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def _spread(values: np.ndarray, rows: np.ndarray, total: int) -> np.ndarray:
    """``values`` at ``rows`` of ``total``, zero elsewhere."""
    out = np.zeros(total, np.int64)
    out[rows] = values
    return out


def _aligned(texts: list[bytes], a: Side, b: Side, whole: bool) -> list[pa.Array]:
    """The result columns of a block of texts."""
    n = len(texts)
    rows, mine, other = cut(texts, a, b)
    docs = len(rows)
    groups = grouped(mine, other, docs)
    n_groups = np.diff(groups.first)
    per_doc, pair_a, pair_b, times = tallies(mine, other, overlaps(mine, other), docs, len(b))
    n_a, n_b = np.bincount(mine.doc, minlength=docs), np.bincount(other.doc, minlength=docs)
    linked = np.diff(np.concatenate([[0], np.cumsum(times)])[np.concatenate([[0], np.cumsum(per_doc)])])
    sums = [pa.array(_spread(x, rows, n)) for x in (n_a, n_b, n_groups, linked)]
    links = pa.StructArray.from_arrays([pa.array(x, pa.int32()) for x in (pair_a, pair_b, times)], ["a", "b", "n"])
    if whole:
        sides = [_lists(groups.n_a, pa.array(mine.ids, pa.int32())), _lists(groups.n_b, pa.array(other.ids, pa.int32()))]
        shown = _lists(_spread(n_groups, rows, n), pa.StructArray.from_arrays(sides, ["a", "b"]))
    else:
        shown = np.full(n, "", object)
        shown[rows] = digests(mine, other, groups, max(len(a), len(b)))
        shown = pa.array(shown, pa.string())
    return [*sums, shown, _lists(_spread(per_doc, rows, n), links)]


def align(df: DataFrame, a: str, b: str, doc_id: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """The groups and links of every text, cut by the tokenizers in the files ``a`` and ``b``.

    ``doc_id, n_a, n_b, n_groups, n_links, groups, links``: ``groups`` has the ids of both sides in
    each group, ``links`` how often each pair of ids is linked.  With ``digest`` there is
    ``groups_sha256`` instead of ``groups``, the digest of ``a1,a2|b1;a3|b2,b3`` (empty without tokens).
    """
    rows = named(df, doc_id, text).withColumn(text, F.col(f"`{text}`").cast("binary"))
    shared = [Shared.of(df.sparkSession, path) for path in (a, b)]
    shown = "groups_sha256 string" if digest else "groups array<struct<a: array<int>, b: array<int>>>"
    names = [doc_id, "n_a", "n_b", "n_groups", "n_links", shown.split()[0], "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = (s.side() for s in shared)
        for batch in batches:
            column, begin = batch.column(1), 0
            _, offsets = W.raw(column)
            while begin < len(column):
                end = int(np.searchsorted(offsets, offsets[begin] + BLOCK_BYTES, "right")) - 1
                end = min(len(column), max(end, begin + 1))
                texts = [t or b"" for t in column.slice(begin, end - begin).to_pylist()]
                found = _aligned(texts, left, right, not digest)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin), *found], names)
                begin = end

    return rows.mapInArrow(run, f"`{doc_id}` {rows.dtypes[0][1]}, {_SUMS}, {shown}, links {_LINKS}")


# -- counts ----------------------------------------------------------------------------------


def frequencies(aligned: DataFrame) -> DataFrame:
    """``a, b, count, best``: links of each pair in all documents, and whether no other has more for its ``b``.

    A ``b`` has at most as many pairs as side A has ids.
    """
    pairs = aligned.select(F.inline("links")).groupBy("a", "b").agg(F.sum("n").alias("count"))
    return pairs.withColumn("best", F.col("count") == F.max("count").over(Over.partitionBy("b")))


def _frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys in ascending order, counts and ``best`` of the pairs with the highest counts, ``most`` at most."""
    power = F.floor(F.log2("count")).cast("int").alias("power")
    least = None
    for row in counts.groupBy(power).agg(F.count("*").alias("n")).orderBy(F.desc("power")).collect():
        most -= row["n"]
        if most < 0:
            break
        least = row["power"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    table = counts.filter(F.floor(F.log2("count")) >= least).toArrow()
    a, b, count, best = (table.column(c).to_numpy() for c in ("a", "b", "count", "best"))
    key = (a.astype(np.int64) << 32) | b
    order = np.argsort(key)
    return key[order], count[order], best[order].astype(np.int64)


def scored(aligned: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``aligned`` with ``n_best``, links whose pair is the best of its ``b``, and ``count_sum``, the counts of all links.

    ``groups`` are left out.
    """
    kept = [c for c in aligned.columns if c not in ("groups", "links")]
    rows = aligned.select(*kept, "links").withColumn("_row", F.monotonically_increasing_id())
    shared = aligned.sparkSession.sparkContext.broadcast(_frequent(counts, frequent))
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "links")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, count, best = shared.value
        for batch in batches:
            links = batch.column(len(kept))
            flat = links.flatten()
            a, b, n = (flat.field(i).to_numpy() for i in range(3))
            ends = np.concatenate([[0], np.cumsum(links.value_lengths().to_numpy())])
            key = (a.astype(np.int64) << 32) | b
            at = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
            known = keys[at] == key if len(keys) else np.zeros(len(key), bool)
            n_best, sums = (np.zeros(len(key) + 1, np.int64) for _ in range(2))
            if len(keys):
                np.cumsum(np.where(known, n * best[at], 0), out=n_best[1:])
                np.cumsum(np.where(known, n * count[at], 0), out=sums[1:])
            missed = np.concatenate([[0], np.cumsum(~known)])[ends]
            rest = pa.ListArray.from_arrays(pa.array(missed, pa.int32()), flat.filter(pa.array(~known)))
            own = [c for i, c in enumerate(batch.columns) if i != len(kept)]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(np.diff(n_best[ends])), pa.array(np.diff(sums[ends])), rest],
                [*kept, "_row", "n_best", "count_sum", "rest"],
            )

    found = staged(rows.mapInArrow(run, f"{schema}, n_best bigint, count_sum bigint, rest {_LINKS}"), "link-counts")
    rare = found.select("_row", F.inline("rest")).join(counts, ["a", "b"]).groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("rare_best"), F.sum(F.col("n") * F.col("count")).alias("rare_sum")
    )
    return found.drop("rest").join(rare, "_row", "left").select(
        *kept,
        (F.col("n_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"),
    )
