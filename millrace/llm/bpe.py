"""Byte-level BPE: encoding with a rank queue of hierarchical bitmaps, and decoding.

The bytes of many pre-tokens form one linked list in arrays.  Every adjacent pair whose joined
bytes have a rank waits in the bucket of that rank; a bitmap over ranks, with a bitmap over its
words above it, says which buckets are in use, so the lowest rank is two find-first-set steps
away.  An entry whose pair has changed meanwhile is stale and skipped.  All waiting pairs of a
rank are joined at once: left to right where they overlap, and only the leftmost of each
pre-token where joining could make a pair of lower rank.  A pre-token of n bytes takes about
O(n log n) however long it is.

Rules: null text counts as empty and has no tokens; special tokens are ordinary text; invalid
UTF-8 becomes U+FFFD, as decoding with replacement does.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.memory import kept, lean_column
from millrace.llm.store import small_batches

#: Bits of a bitmap word; two levels cover the square of it.
WORD = 256
#: Pieces a worker remembers between blocks, about.
MEMO = 150_000
#: Longer pieces are forgotten after their block.
MEMO_CHARS = 40
#: Characters of text, and bytes of new pre-tokens, worked on at once (or one text, one pre-token).
BLOCK_CHARS = 2_500_000
QUEUE_BYTES = 1_000_000

#: So few positions of a rank are joined one by one, more as arrays; the result is the same.
FEW = 64

#: Larger vocabulary files are refused.
FILE_CHARS = 64 << 20

NONE = -1


def parse_ranks(content: str) -> dict[bytes, int]:
    """Ranks by token bytes, from lines of base64 and rank."""
    pairs = (line.split() for line in content.splitlines())
    return {base64.b64decode(p[0]): int(p[1]) for p in pairs if len(p) == 2}


class PairTable:
    """The rank of two neighbouring tokens' joined bytes, for arrays of tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no rank for {len(missing)} single bytes")
        found = [
            (left, right, rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None
        ]
        left, right, rank = np.array(found, np.int64).reshape(-1, 3).T
        self.size = max(ranks.values()) + 1
        key = left * self.size + right
        order = np.argsort(key)
        self.keys = np.append(key[order], np.iinfo(np.int64).max)
        self.ranks = np.append(rank[order], NONE).astype(np.int32)
        self.known = dict(zip(key.tolist(), rank.tolist()))  # for one pair at a time
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        # A rank is plain if every pair with its token ranks higher: joining it makes no lower pair.
        lowest = np.full(self.size, self.size, np.int64)
        np.minimum.at(lowest, left, rank)
        np.minimum.at(lowest, right, rank)
        self.plain = lowest > np.arange(self.size)

    def __call__(self, left: np.ndarray | int, right: np.ndarray | int) -> np.ndarray:
        key = np.asarray(left, np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)


class RankQueue:
    """Buckets of positions by rank; two bitmap levels tell the lowest rank in use."""

    def __init__(self, ranks: int):
        self.low = [0] * (ranks // WORD + 1)
        self.high = 0
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.single: dict[int, list[int]] = {}  # positions added one at a time

    def _mark(self, rank: int) -> None:
        self.low[rank // WORD] |= 1 << rank % WORD
        self.high |= 1 << rank // WORD

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        begins = [0, *cuts.tolist()]
        for rank, begin, end in zip(ranks[begins].tolist(), begins, [*begins[1:], len(ranks)]):
            self.buckets.setdefault(rank, []).append(positions[begin:end])
            self._mark(rank)

    def add(self, rank: int, position: int) -> None:
        found = self.single.get(rank)
        if found is None:
            self.single[rank] = [position]
            self._mark(rank)
        else:
            found.append(position)

    def take(self) -> tuple[int, list[int] | np.ndarray]:
        """The lowest rank and its positions in ascending order, few of them as a list; the rank is -1 when nothing waits."""
        if not self.high:
            return NONE, []
        word = (self.high & -self.high).bit_length() - 1
        bits = self.low[word]
        rank = word * WORD + (bits & -bits).bit_length() - 1
        self.low[word] = bits = bits & (bits - 1)
        if not bits:
            self.high &= self.high - 1
        bucket, single = self.buckets.pop(rank, []), self.single.pop(rank, [])
        if len(single) + sum(map(len, bucket)) <= FEW:
            return rank, sorted({*single, *(p for part in bucket for p in part.tolist())})
        if single:
            bucket.append(np.array(single, np.int32))
        return rank, bucket[0] if len(bucket) == 1 and not single else np.unique(np.concatenate(bucket))

    def pop(self) -> tuple[int, np.ndarray]:
        """As ``take``, the positions always as an array."""
        rank, at = self.take()
        return rank, np.asarray(at, np.int32)


def _alternate(positions: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of pairs that overlap their predecessor, every second of a run stays for the left one."""
    chained = np.zeros(len(positions), bool)
    chained[1:] = after[positions[:-1]] == positions[1:]
    if not chained.any():
        return positions
    place = np.arange(len(positions))
    run = np.maximum.accumulate(np.where(chained, 0, place))
    return positions[(place - run) % 2 == 0]


def _lowers(at, rank, table, token, owner, after, before) -> np.ndarray:
    """Which of the joins at ``at`` would make a pair of a rank below ``rank``."""
    right, left = after[after[at]], before[at]
    after_it = table(rank, token[right])
    before_it = table(token[left], rank)
    low = (after_it != NONE) & (after_it < rank) & (owner[right] == owner[at])
    low |= (before_it != NONE) & (before_it < rank) & (left >= 0) & (owner[left] == owner[at])
    twice = int(table(rank, rank))
    return low | (NONE < twice < rank)


def _joiner(table: PairTable, queue: RankQueue, *arrays: np.ndarray):
    """A function that joins the pairs at given positions, in order, on the arrays of ``merge_all``.

    It does nothing and says so where a join would make a pair of a lower rank.
    """
    token, owner, after, before, waits = map(memoryview, arrays)
    known, size = table.known.get, table.size

    def lowers(rank: int, at: int) -> bool:
        left, right = before[at], after[after[at]]
        if owner[right] == owner[at] and known(rank * size + token[right], rank) < rank:
            return True
        return left >= 0 and owner[left] == owner[at] and known(token[left] * size + rank, rank) < rank

    def join(rank: int, positions: list[int]) -> bool:
        if not table.plain[rank]:
            positions = [at for at in positions if waits[at] == rank]
            if known(rank * size + rank, rank) < rank or any(lowers(rank, at) for at in positions):
                return False
        for at in positions:
            if waits[at] != rank:
                continue  # stale
            gone = after[at]
            right = after[gone]
            waits[gone] = token[gone] = NONE
            token[at] = rank
            after[at] = right
            before[right] = at
            mine = owner[at]
            fresh = known(rank * size + token[right], NONE) if owner[right] == mine else NONE
            waits[at] = fresh
            if fresh != NONE:
                queue.add(fresh, at)
            left = before[at]
            if left >= 0 and owner[left] == mine:
                fresh = known(token[left] * size + rank, NONE)
                waits[left] = fresh
                if fresh != NONE:
                    queue.add(fresh, left)
        return True

    return join


def merge_all(pieces: list[bytes], table: PairTable) -> list[bytes]:
    """Token ids of every pre-token, as the bytes of 32-bit integers."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    n = int(lengths.sum())
    token = np.append(table.bytes[np.frombuffer(b"".join(pieces), np.uint8)], np.int32(NONE))
    owner = np.append(np.repeat(np.arange(len(pieces), dtype=np.int32), lengths), NONE)
    after = np.arange(1, n + 2, dtype=np.int32)
    before = np.arange(-1, n, dtype=np.int32)
    waits = np.full(n + 1, NONE, np.int32)
    inner = np.flatnonzero(owner[:-2] == owner[1:-1]).astype(np.int32) if n > 1 else np.zeros(0, np.int32)
    waits[inner] = table(token[inner], token[inner + 1])
    inner = inner[waits[inner] != NONE]
    queue = RankQueue(table.size)
    queue.push(waits[inner], inner)
    one_by_one = _joiner(table, queue, token, owner, after, before, waits)
    while True:
        rank, at = queue.take()
        if rank == NONE:
            break
        if isinstance(at, list):
            if one_by_one(rank, at):
                continue
            at = np.array(at, np.int32)
        at = at[waits[at] == rank]  # the rest is stale
        if not len(at):
            continue
        if not table.plain[rank]:
            mine = owner[at]
            now = np.ones(len(at), bool)
            now[1:] = mine[1:] != mine[:-1]  # the leftmost
            low = _lowers(at, rank, table, token, owner, after, before)
            now |= ~np.isin(mine, mine[low]) if low.any() else True
            later = at[~now]
            queue.push(np.full(len(later), rank, np.int32), later)
            at = at[now]
        at = _alternate(at, after)
        gone = after[at]
        right = after[gone]
        waits[gone] = token[gone] = NONE
        token[at] = rank
        after[at] = right
        before[right] = at
        left = before[at]
        mine = owner[at]
        has = owner[right] == mine
        fresh = np.full(len(at), NONE, np.int32)
        fresh[has] = table(rank, token[right[has]])
        waits[at] = fresh
        has = (left >= 0) & (owner[left] == mine)
        left = left[has]
        # A left neighbour may itself have been joined in this step: its token is `rank` by now.
        waits[left] = table(token[left], rank)
        both = np.concatenate([at, left])
        now = waits[both]
        some = now != NONE
        queue.push(now[some], both[some])
    alive = token >= 0
    ids = token[alive].tobytes()
    ends = (4 * np.cumsum(np.add.reduceat(alive[:n], np.cumsum(lengths) - lengths, dtype=np.int64))).tolist()
    return [ids[b:e] for b, e in zip([0, *ends[:-1]], ends)]


class Memo(dict):
    """Remembers what was used of late: a full one becomes the older half, from which used entries come back."""

    def __init__(self):
        super().__init__()
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        found = self[key] = self.older[key]
        return found

    def without(self, keys: Iterable[str]) -> set[str]:
        """Those of ``keys`` that are not known."""
        unknown = set(keys)
        unknown.difference_update(self)
        unknown.difference_update(self.older)
        return unknown

    def trim(self, keys: Iterable[str]) -> None:
        """Forget the long ones of ``keys``, and what was not used for long."""
        for key in keys:
            if len(key) > MEMO_CHARS:
                self.pop(key, None)
        if len(self) > MEMO // 2:
            self.older = dict(self)
            self.clear()


class Encoder:
    """Encodes blocks of texts with one vocabulary.

    With ``spaced``, a text without two blanks in a row is cut at its single spaces and line
    ends, and each cut is encoded once per block.  That needs a pattern whose matches hold a
    space only as their first character or among blanks, and that match letters after at most
    one space as a whole: then a single space between two other characters begins a match, and
    a single line end between two is one.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, spaced: bool = True):
        self.ranks = ranks
        self.table = PairTable(ranks)
        self.match = regex.compile(pattern).findall
        self.spaced = spaced
        self.known = Memo()  # ids by pre-token, as bytes of 32-bit integers
        self.cuts = Memo()  # ids by cut

    def _learn(self, pieces: Iterable[str]) -> set[str]:
        """Encode the pre-tokens not yet known; which ones those were."""
        new = self.known.without(pieces)
        todo: list[str] = []
        held = 0
        for piece in new:
            data = piece.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                self.known[piece] = whole.to_bytes(4, sys.byteorder)
                continue
            todo.append(piece)
            held += len(data)
            if held >= QUEUE_BYTES:
                self._merge(todo)
                todo, held = [], 0
        self._merge(todo)
        return new

    def _merge(self, pieces: list[str]) -> None:
        if pieces:
            self.known.update(zip(pieces, merge_all([p.encode() for p in pieces], self.table)))

    @staticmethod
    def _bad(cut: str) -> bool:
        """A cut that shows that blanks touch in its text."""
        core = cut[1:] if cut[:1] == " " else cut
        return core != "\n" and (not core or core[0].isspace() or core[-1].isspace())

    def _matches(self, cut: str) -> list[str]:
        return [cut] if (cut[1:] if cut[0] == " " else cut).isalpha() else self.match(cut)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text, as the bytes of 32-bit integers."""
        cuts: list[list[str] | None] = [None] * len(texts)
        if self.spaced:
            cuts = [
                None if "\0" in text else text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
                for text in texts
            ]
        fresh: set[str] = set()
        for parts in cuts:
            fresh.update(parts or ())
        fresh = self.cuts.without(fresh)
        bad = {cut for cut in fresh if self._bad(cut)}
        if bad:
            cuts = [None if parts is None or not bad.isdisjoint(parts) else parts for parts in cuts]
            fresh -= bad
        whole = {i: self.match(texts[i]) for i, parts in enumerate(cuts) if parts is None}
        inside = {cut: self._matches(cut) for cut in fresh}
        pieces = set(chain.from_iterable(inside.values()))
        pieces.update(chain.from_iterable(whole.values()))
        new = self._learn(pieces)
        known = self.known.__getitem__
        for cut, matches in inside.items():
            self.cuts[cut] = known(matches[0]) if len(matches) == 1 else b"".join(map(known, matches))
        found = self.cuts.__getitem__
        out = [
            b"".join(map(known, whole[i])) if parts is None else b"".join(map(found, parts))
            for i, parts in enumerate(cuts)
        ]
        self.cuts.trim(fresh)
        self.known.trim(new)
        return out


def _encoder(content: str, pattern: str, spaced: bool) -> Encoder:
    return kept((Encoder, content, pattern, spaced), lambda: Encoder(parse_ranks(content), pattern, spaced))


def _tokens(content: str) -> tuple[np.ndarray, np.ndarray]:
    return kept((_token_bytes, content), lambda: _token_bytes(content))


def _token_bytes(content: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens by rank, one after another, and where each begins; unused ranks have none."""
    ranks = parse_ranks(content)
    sizes = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    by_rank = sorted(ranks, key=ranks.__getitem__)
    return np.frombuffer(b"".join(by_rank), np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def _shipped(spark: SparkSession, vocabulary: str):
    """The vocabulary file's text, broadcast; it is a few megabytes, larger ones are refused."""
    with open(vocabulary, encoding="ascii") as lines:
        content = lines.read(FILE_CHARS + 1)
    if len(content) > FILE_CHARS:
        raise ValueError(f"more than {FILE_CHARS} characters: {vocabulary}")
    return spark.sparkContext.broadcast(content)


def encode(
    df: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids", spaced: bool = True
) -> DataFrame:
    """Add ``ids array<int>``, the tokens of column ``text``.

    ``vocabulary`` is the path of a file of base64 tokens and ranks, sent to the executors;
    ``pattern`` matches pre-tokens; ``spaced`` says that it has the property ``Encoder`` names.
    A column of the name ``ids`` is replaced; other columns pass.
    """
    shared = _shipped(df.sparkSession, vocabulary)
    small_batches(df.sparkSession)

    @F.arrow_udf("array<int>")
    @lean_column
    def encoded(column: pa.Array) -> pa.Array:
        return _ids(column, _encoder(shared.value, pattern, spaced))

    # Marked so that Spark does not encode once more for each use of the result.
    return df.withColumn(ids, encoded.asNondeterministic()(df[text].cast("binary")))


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``decoded binary``, the bytes of the tokens in ``ids``; null ids give no bytes, an unknown id is an error."""
    shared = _shipped(df.sparkSession, vocabulary)
    small_batches(df.sparkSession)

    @F.arrow_udf("binary")
    @lean_column
    def joined(column: pa.Array) -> pa.Array:
        return _bytes(column, *_tokens(shared.value))

    return df.withColumn(decoded, joined(df[ids]))


def round_trip(
    df: DataFrame,
    vocabulary: str,
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    decoded: str = "decoded",
    spaced: bool = True,
) -> DataFrame:
    """``encode`` and then ``decode`` by the same worker: two of each task's would hold the tables and memos twice."""
    shared = _shipped(df.sparkSession, vocabulary)
    small_batches(df.sparkSession)

    @F.arrow_udf("struct<ids: array<int>, decoded: binary>")
    @lean_column
    def both(column: pa.Array) -> pa.Array:
        found = _ids(column, _encoder(shared.value, pattern, spaced))
        return pa.StructArray.from_arrays([found, _bytes(found, *_tokens(shared.value))], ["ids", "decoded"])

    done = both.asNondeterministic()(df[text].cast("binary"))
    parts = df.withColumn("__tokens", done)
    return parts.withColumns({ids: F.col("__tokens.ids"), decoded: F.col("__tokens.decoded")}).drop("__tokens")


def _ids(column: pa.Array, encoder: Encoder) -> pa.Array:
    """The tokens of each text, given as UTF-8."""
    values, ends, block, held = [], [0], [], 0

    def flush():
        found = encoder.encode(block)
        ends.extend((ends[-1] + np.cumsum([len(x) // 4 for x in found])).tolist())
        values.append(pa.array(np.frombuffer(b"".join(found), np.int32)))
        block.clear()

    for item in column:
        block.append(str(item.as_buffer() or b"", "utf-8", "replace"))
        held += len(block[-1])
        if held >= BLOCK_CHARS:
            flush()
            held = 0
    if block:
        flush()
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays(values or [pa.array([], pa.int32())]))


def _bytes(column: pa.Array, data: np.ndarray, begins: np.ndarray) -> pa.Array:
    """The bytes of each list of ids, by the table ``_tokens`` makes."""
    sizes = np.diff(begins)
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values, at, row, out = column.flatten().to_numpy(zero_copy_only=False), 0, 0, []
    while row < len(lengths):
        # Rows of about BLOCK_CHARS tokens at once.
        stop = row + max(1, int(np.searchsorted(np.cumsum(lengths[row:]), BLOCK_CHARS, "right")))
        ends = np.cumsum(lengths[row:stop])
        ids = values[at : at + ends[-1]]
        if len(ids) and (ids.min() < 0 or ids.max() >= len(sizes) or not sizes[ids].all()):
            raise KeyError("an id without a token")
        width = sizes[ids]
        upto = np.concatenate([[0], np.cumsum(width)])
        text = data[np.repeat(begins[ids] - upto[:-1], width) + np.arange(upto[-1])]
        offsets = upto[np.concatenate([[0], ends])].astype(np.int32)
        out.append(pa.Array.from_buffers(pa.binary(), stop - row, [None, pa.py_buffer(offsets), pa.py_buffer(text)]))
        at, row = at + int(ends[-1]), stop
    return pa.concat_arrays(out) if out else pa.array([], pa.binary())
