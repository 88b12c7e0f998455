"""Repeated passages against a dictionary of all windows; the index against plain search."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from cases import empty, odd, prose

from millrace.llm import substrings
from millrace.llm.fmindex import Bits, FMIndex, WaveletMatrix, covered_intervals, suffix_array

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def covered(rows, window):
    """``{(id, text): flags}`` of the removed words; ``rows`` are (id, text)."""
    least = {}
    for doc, text in rows:
        w = WORD.findall(text or "")
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            if doc is not None:
                least[k] = min(least.get(k, doc), doc)
    out = {}
    for doc, text in rows:
        w = WORD.findall(text or "")
        flags = [False] * len(w)
        for i in range(len(w) - window + 1):
            if doc is not None and least[tuple(w[i : i + window])] < doc:
                flags[i : i + window] = [True] * window
        out[doc, text] = flags
    return out


def plain(rows, window):
    out = []
    for (doc, text), flags in covered(rows, window).items():
        w = WORD.findall(text or "")
        kept = " ".join(x for x, f in zip(w, flags) if not f)
        row = (doc, len(w), sum(flags), hashlib.sha256(kept.encode()).hexdigest())
        out += [row] * rows.count((doc, text))
    return sorted(out, key=str)


def check(df, window=50):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in substrings.kept_words(df, window=window).collect()), key=str)
    assert got == plain(rows, window)


def passages(n=80):
    pick = random.Random(5)
    shared = [prose(1000 + i, pick.choice((49, 50, 51, 60, 120))) for i in range(6)]
    rows = []
    for i in range(n):
        parts = [prose(i, pick.randrange(40))]
        for _ in range(pick.randrange(4)):
            text = pick.choice(shared).split()
            cut = pick.randrange(3)
            parts += [" ".join(text[cut:]), prose(i * 7, pick.randrange(30))]
        rows.append((pick.choice((i, i, i // 2)) * 3, "  ".join(parts)))
    rows += [(500, rows[3][1]), (501, rows[3][1].replace(" ", "\n")), (502, "the " * 200), (503, "the " * 130), (2, "the " * 90)]
    return rows


def test_passages(spark):
    check(spark.createDataFrame(passages(), "doc_id long, text string"))


def test_short_windows(spark):
    rows = [(i, prose(i, 60, 6)) for i in range(40)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), window=9)


def test_many_shards(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_WORDS", 500)
    check(spark.createDataFrame(passages(), "doc_id long, text string"))


def test_hot_passages_go_by_windows(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HOT_DOCUMENTS", 5)
    check(spark.createDataFrame(passages(120), "doc_id long, text string"))


def test_given_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_odd_documents(spark):
    check(odd(spark))


def test_empty_table(spark):
    assert substrings.kept_words(empty(spark)).collect() == []
    assert substrings.remove_repeats(empty(spark)).collect() == []


def test_removal_keeps_the_rest_as_it_is(spark):
    df = spark.createDataFrame(passages(), "doc_id long, text string").withColumnRenamed("text", "body")
    rows = [(r.doc_id, r.body) for r in df.collect()]
    got = sorted((tuple(r) for r in substrings.remove_repeats(df, text="body").collect()), key=str)
    want = []
    for (doc, text), flags in covered(rows, 50).items():
        if flags and all(flags):
            continue
        spans = [m.start() for m in WORD.finditer(text)] + [len(text)]
        left = text[: spans[0]] + "".join(text[a:b] for a, b, f in zip(spans, spans[1:], flags) if not f)
        want += [(doc, left)] * rows.count((doc, text))
    assert got == sorted(want, key=str)


def test_removal_of_odd_documents(spark):
    df = odd(spark)
    left = substrings.remove_repeats(df)
    assert left.columns == df.columns
    ids = [r.doc_id for r in left.collect()]
    assert sorted(i for i in ids if i) == [1, 3, 4, 5, 6, 7, 8, 9, 10, 10] and ids.count(None) == 2


def test_removal_cuts_each_text_once(spark, capsys):
    substrings.remove_repeats(spark.createDataFrame(passages(), "doc_id long, text string")).explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1


def test_bits_and_wavelets():
    pick = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 500):
        bits = pick.integers(0, 2, n)
        assert Bits(bits).rank(np.arange(n + 1)).tolist() == [int(bits[:i].sum()) for i in range(n + 1)]
    symbols = pick.integers(0, 13, 300)
    matrix = WaveletMatrix(symbols, 4)
    base = matrix.descend(np.arange(13), np.zeros(13, np.int32))
    for c in range(13):
        at = np.arange(301, dtype=np.int32)
        got = matrix.descend(np.full(301, c), at) - base[c]
        assert got.tolist() == [int((symbols[:i] == c).sum()) for i in at]


def test_suffix_array():
    pick = np.random.default_rng(2)
    for n, k in ((1, 1), (30, 2), (200, 3), (64, 1)):
        text = pick.integers(0, k, n).tolist()
        assert suffix_array(np.array(text)).tolist() == sorted(range(n), key=lambda i: text[i:])


@pytest.mark.parametrize("seed", range(6))
def test_matching_and_intervals(seed):
    pick = random.Random(seed)
    sequences = [[pick.randrange(2 + seed % 3) for _ in range(pick.randrange(1, 40))] for _ in range(14)]
    owners = [pick.randrange(6) for _ in sequences]
    index = FMIndex([np.array(s, np.uint64) for s in sequences], np.array(owners))

    def occurs(part, owner):
        return any(o < owner and part == s[i : i + len(part)] for s, o in zip(sequences, owners) for i in range(len(s)))

    queries = [(s, e) for s in range(14) for e in range(len(sequences[s]))]
    got = index.matching(np.array([s for s, _ in queries]), np.array([e for _, e in queries]), np.array([owners[s] for s, _ in queries]))
    for (s, e), m in zip(queries, got.tolist()):
        want = 0
        while want <= e and occurs(sequences[s][e - want : e + 1], owners[s]):
            want += 1
        assert m == want
    for window in (1, 3, 6):
        flags = [[False] * len(s) for s in sequences]
        for part in covered_intervals(index, np.array([len(s) for s in sequences]), np.array(owners), window):
            for s, b, e in part.T.tolist():
                flags[s][b:e] = [True] * (e - b)
        for s, seq in enumerate(sequences):
            want = [False] * len(seq)
            for b in range(len(seq) - window + 1):
                if occurs(seq[b : b + window], owners[s]):
                    want[b : b + window] = [True] * window
            assert flags[s] == want, (window, s)
