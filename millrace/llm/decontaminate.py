"""Benchmark items that occur in documents, up to a share of edited words.

Windows of the size of the items are embedded by the CGK random walk, which turns few word edits
into few differing positions; several walks, each sampled at a few positions, are looked up among
the items' (bit-sampling LSH); what matches is verified by exact edit distance over words.  A walk
reads about the first ``REACH`` of an item, so items are walked from both ends and towards both:
forwards from the first word and from ``REACH`` before the end, backwards from the last word and
from ``REACH`` behind the beginning.  Wherever the edits lie, some of these begin among few.

Windows are taken wherever an occurrence is possible at all: by the q-gram lemma, one within t
edits of an item of n words holds at least n - q + 1 - q*t of its q-grams.  So a window with too
few words sequences of any item is skipped without losing a match.

Rules: words are lower-cased runs of letters, digits and non-ASCII characters; null and empty
texts and items match nothing; an item of n words matches within ``floor(EDITS * n)`` edits; equal
items are reported each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import words as W
from millrace.llm.memory import lean, lean_column
from millrace.llm.store import named

#: Edited words that a match may have, as a share of the item's words.
EDITS = 0.2
#: Walks, half of them in each direction, and positions sampled of each; see the README for the measured recall.
WALKS = 32
SAMPLED = 3
#: Steps of a walk for each word of the class's shortest item; a step advances by half a word on average.
STEPS_PER_WORD = 1.2
#: Share of the shortest item's words that a walk reads, with some slack.
REACH = 0.67
#: Items are indexed and broadcast in blocks of about so many words.
BLOCK_WORDS = 2_000_000
#: Windows embedded, and cells of alignments computed, at once.
WINDOWS = 20_000
CELLS = 1 << 15
#: A cell's lower bits hold the place at which its alignment begins.
_BITS = 32
_COST = np.int64(1 << _BITS)

_PAD = np.uint64(0)


@dataclass
class Items:
    """A class of items of similar length, with the keys of their embeddings."""

    low: int  # words of the shortest
    width: int  # words that hold the longest with its edits
    q: int
    need: int  # q-grams that an occurrence of any of them has at least
    grams: np.ndarray
    keys: np.ndarray  # sorted; owner[i] is the item of keys[i], place[i] the word that its walk begins at
    owner: np.ndarray
    place: np.ndarray


@dataclass
class Index:
    ids: list
    words: list[np.ndarray]  # hashes of each item's words
    grams: list[np.ndarray]  # each item's q-grams, sorted, of the q that it has in its class
    classes: list[Items]
    maybe: dict[int, np.ndarray]  # by q: bit table of the grams of all classes


def budget(n: int) -> int:
    """Edits that an item of ``n`` words may have."""
    return int(EDITS * n + 1e-9)


def _gram_size(n: int) -> int:
    """The longest q, up to 3, of which an occurrence must keep at least one."""
    return next(q for q in (3, 2, 1) if n - q + 1 - q * budget(n) >= 1)


def _reach(low: int) -> int:
    return max(1, int(REACH * low))


def _walk(tokens: np.ndarray, start: np.ndarray, edge: np.ndarray, low: int, back: bool = False) -> np.ndarray:
    """Keys of ``WALKS / 2`` sampled embeddings (rows) of the words from ``start`` on, up to the word before ``edge``.

    ``back`` reads towards the beginning, down to the word ``edge``.
    """
    count = WALKS // 2
    steps = max(SAMPLED, int(STEPS_PER_WORD * low))
    pick = np.random.default_rng([low, WALKS, back])
    turn = pick.integers(1, 1 << 63, (count, steps), np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    taken = np.zeros((count, steps), bool)
    for w in range(count):
        taken[w, pick.choice(steps, SAMPLED, replace=False)] = True
    ends = steps - taken[:, ::-1].argmax(axis=1)
    order = np.argsort(-ends, kind="stable")
    keys = np.empty((count, len(start)), np.uint64)
    # Where no walk can reach the edge, its tests are spared.
    far = (start - steps >= edge) if back else (start + steps < edge)
    for own, free in ((np.flatnonzero(far), True), (np.flatnonzero(~far), False)):
        if len(own):
            keys[np.ix_(order, own)] = _steps(tokens, start[own], edge[own], low, back, turn[order], taken[order], ends[order], order, free)
    return keys


def _steps(tokens, start, edge, low, back, turn, taken, ends, names, free) -> np.ndarray:
    """The keys of the walks ``names``, the longest first; each ends with its last sampled step."""
    count = len(names)
    at = np.tile(start, (count, 1))
    keys = np.tile((names.astype(np.uint64) + np.uint64(low << 9 | back << 8))[:, None], (1, len(start)))
    last = len(tokens) - 1
    for j in range(ends[0]):
        at = at[: np.count_nonzero(ends > j)]
        if free:
            token = tokens[at]
        else:
            inside = at >= edge if back else at < edge
            token = np.where(inside, tokens[np.clip(at, 0, last)], _PAD)
        own = np.flatnonzero(taken[: len(at), j])
        keys[own] = W.mix(keys[own] * np.uint64(0x9E3779B97F4A7C15) + token[own])
        moved = ((token * turn[: len(at), j, None]) >> np.uint64(63)).astype(np.int64)
        at += -moved if back else moved
    return keys


def build(ids: list, texts: list[str | None]) -> Index:
    """Index the items; classes of lengths are a quarter apart."""
    hashes = [np.zeros(0, np.uint64)] * len(texts)
    for begin, _, found in W.blocks(_lowered(pa.array(texts, pa.string())), W.NOT_ALNUM):
        all_words = found.hashes()
        for i, (b, e) in enumerate(zip(found.first[:-1], found.first[1:])):
            hashes[begin + i] = all_words[b:e]
    groups: dict[tuple[int, int], list[int]] = {}
    for i, words in enumerate(hashes):
        if n := len(words):
            groups.setdefault((int(np.log(n) / np.log(1.25)), _gram_size(n)), []).append(i)
    classes = []
    for (_, q), members in sorted(groups.items()):
        sizes = [len(hashes[i]) for i in members]
        low = min(sizes)
        tokens = np.concatenate([hashes[i] for i in members])
        n = np.array(sizes)
        stop = np.cumsum(n)
        reach = _reach(low)
        walks = [(np.zeros_like(n), False), (n - reach, False), (n - 1, True), (np.full_like(n, reach - 1), True)]
        keys = np.concatenate(
            [_walk(tokens, stop - n + place, stop - n if back else stop, low, back) for place, back in walks], axis=1
        )
        owner = np.tile(np.array(members), (WALKS // 2, len(walks)))
        place = np.tile(np.concatenate([place for place, _ in walks]), (WALKS // 2, 1))
        order = np.argsort(keys, axis=None, kind="stable")
        classes.append(
            Items(
                low,
                max(n + budget(n) for n in sizes),
                q,
                min(n - q + 1 - q * budget(n) for n in sizes),
                np.unique(np.concatenate([W.ngrams(hashes[i], q) for i in members])),
                keys.ravel()[order],
                owner.ravel()[order],
                place.ravel()[order],
            )
        )
    maybe = {}
    for c in classes:
        table = maybe.setdefault(c.q, np.zeros(1 << 20, bool))
        table[(c.grams & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    grams = [np.unique(W.ngrams(x, _gram_size(len(x)))) if len(x) else x for x in hashes]
    return Index(ids, hashes, grams, classes, maybe)


def _lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.cast(pa.large_string()))


def _last_rows(pairs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each ``(item, words)`` its number, and by end the least distance of the item to words that end there, and where they begin.

    Of equally good beginnings the first.  Pairs of similar size are worked on together; a cell
    holds the distance and, below it, the beginning, so one minimum finds both.
    """
    order = sorted(range(len(pairs)), key=lambda i: (len(pairs[i][0]), len(pairs[i][1])))
    at = 0
    while at < len(order):
        end, widest = at, 0
        while end < len(order):
            widest = max(widest, len(pairs[order[end]][1]))
            if end > at and (end + 1 - at) * widest > CELLS:
                break
            end += 1
        chunk = order[at:end]
        at = end
        width = max(len(pairs[i][1]) for i in chunk)
        text = np.zeros((len(chunk), width), np.uint64)
        item = np.zeros((len(chunk), len(pairs[chunk[-1]][0])), np.uint64)
        for row, i in enumerate(chunk):
            item[row, : len(pairs[i][0])], text[row, : len(pairs[i][1])] = pairs[i]
        place = np.arange(width + 1, dtype=np.int64)
        cell, done = np.tile(place, (len(chunk), 1)), 0
        for step in range(item.shape[1]):
            replaced = cell[:, :-1] + (text[done:] != item[done:, step, None]) * _COST
            fresh = np.empty_like(cell)
            fresh[:, 0] = cell[:, 0] + _COST
            np.minimum(replaced, cell[:, 1:] + _COST, out=fresh[:, 1:])
            # An extra word of the text costs one for each step to the right.
            fresh -= place * _COST
            cell = np.minimum.accumulate(fresh, axis=1)
            cell += place * _COST
            while done < len(chunk) and len(pairs[chunk[done]][0]) == step + 1:
                ends = cell[0, : len(pairs[chunk[done]][1]) + 1]
                yield chunk[done], ends >> _BITS, ends & (_COST - 1)
                cell, done = cell[1:], done + 1


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """``(distance, begin, end)`` of the part of ``words`` nearest to ``item``; ties go to the first end, then the first begin."""
    _, cost, begin = next(_last_rows([(item, words)]))
    end = int(cost.argmin())
    return int(cost[end]), int(begin[end]), end


def _disjoint(cost: np.ndarray, origin: np.ndarray, most: int) -> list[tuple[int, int, int]]:
    """``(distance, begin, end)`` of parts within ``most`` edits that do not overlap, the nearest first."""
    ends = np.flatnonzero(cost <= most)
    taken, out = np.zeros(len(cost), bool), []
    for end in ends[np.lexsort((ends, cost[ends]))].tolist():
        begin = int(origin[end])
        if not (taken[begin] or taken[end - 1] or taken[begin:end].any()):
            taken[begin:end] = True
            out.append((int(cost[end]), begin, end))
    return out


def _occurrences(index: Index, tokens: np.ndarray, regions: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """``(item, distance, begin, end)`` of the occurrences in ``(item, low, high)`` regions of the words.

    What is left on both sides of one found, if an occurrence fits there, is looked at again.
    """
    while regions:
        left = []
        pairs = [(index.words[item], tokens[low:high]) for item, low, high in regions]
        for i, cost, origin in _last_rows(pairs):
            item, low, high = regions[i]
            most, edge = budget(len(index.words[item])), 0
            found = sorted(_disjoint(cost, origin, most), key=lambda f: f[1])
            for distance, begin, end in found:
                yield item, distance, low + begin, low + end
            for begin, end in [*[f[1:] for f in found], (high - low, high - low)] if found else ():
                if begin - edge >= len(index.words[item]) - most:
                    left.append((item, low + edge, low + begin))
                edge = end
        regions = left


def _starts(
    c: Items, at: np.ndarray, gram: np.ndarray, stop: np.ndarray, total: int, begin: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The words from which a window that holds enough of the class's q-grams is walked, forwards and backwards."""
    place = np.minimum(np.searchsorted(c.grams, gram), len(c.grams) - 1)
    at = at[c.grams[place] == gram]
    if len(at) < c.need:
        return at[:0], at[:0]
    a, b = at[: len(at) - c.need + 1], at[c.need - 1 :]
    near = (b + c.q - a <= c.width) & (stop[a] == stop[b])
    a, b = a[near], b[near]
    first, end = np.maximum(begin[a], b + c.q - c.width), np.minimum(stop[a], a + c.width)
    # Edits move the places of the walks by the budget at most.
    inner = _reach(c.low) - 1 - budget(c.width)
    ranges = (first, np.maximum(a + 1, end - inner)), (np.minimum(b + c.q - 1, first + max(0, inner)), end)
    out = []
    for low, high in ranges:
        mark = np.zeros(total + 1, np.int64)
        np.add.at(mark, low, 1)
        np.add.at(mark, np.minimum(high, stop[a]), -1)
        out.append(np.flatnonzero(np.cumsum(mark[:-1]) > 0))
    return out[0], out[1]


def search(index: Index, column: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
    """``(row, item, distance, first word, words)`` of every match, the best of overlapping ones.

    What adjoins a match is searched by itself, so another occurrence right before or behind it is found too.
    """
    for offset, _, found in W.blocks(_lowered(column), W.NOT_ALNUM):
        tokens = found.hashes()
        if not len(tokens):
            continue
        begin, stop = np.repeat(found.first[:-1], found.counts), np.repeat(found.first[1:], found.counts)
        text = found.text
        hits = {}
        for q, table in index.maybe.items():
            gram = W.ngrams(tokens, q)
            at = np.flatnonzero(table[(gram & np.uint64((1 << 20) - 1)).astype(np.int64)])
            at = at[at + q <= stop[at]]
            hits[q] = at, gram[at]
        items, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for c in index.classes:
            for back, starts in enumerate(_starts(c, *hits[c.q], stop, len(tokens), begin)):
                for i in range(0, len(starts), WINDOWS):
                    own = starts[i : i + WINDOWS]
                    keys = _walk(tokens, own, (begin if back else stop)[own], c.low, bool(back))
                    left, right = np.searchsorted(c.keys, keys, "left"), np.searchsorted(c.keys, keys, "right")
                    walk, window = np.nonzero(right > left)
                    left, count = left[walk, window], (right - left)[walk, window]
                    entry = np.repeat(left - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
                    at = np.repeat(own[window], count)
                    items.append(c.owner[entry])
                    places.append(np.maximum(begin[at], at - c.place[entry]))
        regions = _regions(index, tokens, np.concatenate(items), np.concatenate(places), begin, stop)
        for item, distance, b, e in _occurrences(index, tokens, regions):
            t = int(text[b])
            yield offset + t, item, distance, b - int(found.first[t]), e - b


def _regions(
    index: Index, tokens: np.ndarray, items: np.ndarray, places: np.ndarray, begin: np.ndarray, stop: np.ndarray
) -> list[tuple[int, int, int]]:
    """``(item, low, high)``: the words around places near which items may begin, as far as they hold enough of the item's q-grams.

    Places of one item whose surroundings overlap share a region; each lies within one text.
    """
    if not len(items):
        return []
    key = np.unique(items * len(tokens) + places)
    items, places = key // len(tokens), key % len(tokens)
    size = np.array([len(w) for w in index.words])[items]
    slack = (EDITS * size + 1e-9).astype(np.int64)
    lows = np.maximum(begin[places], places - 2 * slack)
    highs = np.minimum(stop[places], places + size + 2 * slack + size // 2)
    merged: list[tuple[int, int, int]] = []
    for item, low, high in zip(items.tolist(), lows.tolist(), highs.tolist()):
        if merged and merged[-1][0] == item and low < merged[-1][2]:
            merged[-1] = item, merged[-1][1], max(high, merged[-1][2])
        else:
            merged.append((item, low, high))
    out, grams = [], {}
    for item, low, high in merged:
        n = len(index.words[item])
        q = _gram_size(n)
        if q not in grams:
            grams[q] = W.ngrams(tokens, q)
        mine, here = index.grams[item], grams[q][low : high - q + 1]
        at = np.minimum(np.searchsorted(mine, here), len(mine) - 1)
        if np.count_nonzero(mine[at] == here) >= n - q + 1 - q * budget(n):
            out.append((item, low, high))
    return out


def _blocks(benchmark: DataFrame, item_id: str, item_text: str) -> Iterator[Index]:
    """Indexes of the items, about ``BLOCK_WORDS`` words in each."""
    items = named(benchmark, item_id, item_text).toDF("item", "text")
    size = items.agg(F.coalesce(F.sum(F.size(F.split("text", r"\s+"))), F.lit(0))).first()[0]
    blocks = max(1, -(-int(size) // BLOCK_WORDS))
    for block in range(blocks):
        mine = F.pmod(F.coalesce(F.xxhash64("text"), F.lit(0)), F.lit(blocks)) == block
        part = items.filter(mine).orderBy("item").collect()
        yield build([r.item for r in part], [r.text for r in part])


def matches(
    df: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``doc_id, item_id, distance, first_word, n_words`` of every occurrence of an item in a document.

    The documents are read once for each block of items; a benchmark of up to ``BLOCK_WORDS`` is one block.
    """
    rows = named(df, doc_id, text)
    key = rows.schema[doc_id].dataType.simpleString()
    own = benchmark.select(benchmark[item_id])
    kind = own.limit(0).toArrow().schema.field(0).type
    schema = f"`{doc_id}` {key}, `{item_id}` {own.dtypes[0][1]}, distance int, first_word bigint, n_words int"
    out = None
    for index in _blocks(benchmark, item_id, item_text):
        shared = df.sparkSession.sparkContext.broadcast(index)

        @lean
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index: Index = shared.value
            for batch in batches:
                found = list(search(index, batch.column(1)))
                row, item, distance, first, n = zip(*found) if found else ([],) * 5
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row, pa.int64())),
                        pa.array([index.ids[i] for i in item], kind),
                        pa.array(distance, pa.int32()),
                        pa.array(first, pa.int64()),
                        pa.array(n, pa.int32()),
                    ],
                    [doc_id, item_id, "distance", "first_word", "n_words"],
                )

        found = rows.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def without_matches(df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``df`` in whose text no item occurs."""
    for index in _blocks(benchmark, item_id, item_text):
        df = df.filter(_clean(df.sparkSession.sparkContext.broadcast(index))(df[text]))
    return df


def _clean(shared):
    """A function that tells the texts in which no item of the broadcast index occurs."""

    @F.arrow_udf("boolean")
    @lean_column
    def clean(column: pa.Array) -> pa.Array:
        out = np.ones(len(column), bool)
        for row, *_ in search(shared.value, column):
            out[row] = False
        return pa.array(out)

    return clean
