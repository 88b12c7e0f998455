"""The similarity join against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from cases import empty, odd, prose

from millrace.llm import components, jaccard
from millrace.llm import words as W


def shingles(text):
    w = [x for x in (text or "").encode().split()]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)])


def plain(rows):
    """Links and classes over rows ``(id, text)``; ids are distinct."""
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(i for i in sets if i is not None)
    links = {i: set() for i in ids}
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            c = len(sets[i] & sets[j])
            if c and c >= 0.8 * (len(sets[i]) + len(sets[j]) - c) - 1e-9:
                links[i].add(j)
                links[j].add(i)
    root = {}
    for i in ids:
        if i not in root:
            stack = [i]
            while stack:
                j = stack.pop()
                if j not in root:
                    root[j] = i
                    stack += links[j]
    return {i: (root[i], len(links[i])) for i in ids}


def check(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = plain(rows)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.similar(df).collect() if r.doc_id is not None}
    wrong = [i for i in want if want[i] != got[i]]
    assert not wrong, [(i, want[i], got[i]) for i in wrong[:5]]


def changed(text, seed, n):
    words, pick = text.split(), random.Random(seed)
    for _ in range(n):
        words[pick.randrange(len(words))] = f"z{pick.randrange(10_000)}"
    return " ".join(words)


def near(n=120):
    rows = []
    for i in range(n):
        base = prose(i // 4, 150)
        rows.append((i, changed(base, i, i % 4)))
    return rows + [(1000 + i, prose(500 + i, 3 + i % 5)) for i in range(20)]


def test_near_copies(spark):
    check(spark.createDataFrame(near(), "doc_id long, text string"))


def test_large_group_in_blocks(spark, monkeypatch):
    """Most rows are near copies of one text; blocks of ten split the group, some links are chains."""
    monkeypatch.setattr(jaccard, "BLOCK", 10)
    base = prose(9, 200)
    rows = [(i, changed(base, i, 1 + i % 5)) for i in range(90)] + near(20)[:20]
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    # The workers import the module anew; blocks are made and matched there.
    members = spark.createDataFrame(rows, "doc_id long, text string")
    check(members)


def unit(sets, low=0, high=0, block=None, tree=0):
    values = np.arange(len(sets) * jaccard.TREES).reshape(len(sets), -1)
    values[:, tree] = 5
    return [
        {"group": 1, "low": low, "high": high, "block": (block or [0] * len(sets))[i], "tree": tree, "key": bytes([i]),
         "copies": 1 + i, "now": values[i].astype(np.int64).tobytes(), "before": b"", "grams": s.tobytes()}
        for i, s in enumerate(sets)
    ]


def test_unit_counts_pairs_between_blocks_only():
    sets = [np.arange(10, dtype=np.uint64)] * 4
    whole = jaccard._verify(unit(sets), 0.8)
    assert [r[1] for r in whole] == [2 + 3 + 4, 1 + 3 + 4, 1 + 2 + 4, 1 + 2 + 3]
    cross = jaccard._verify(unit(sets, 0, 1, [0, 0, 1, 1]), 0.8)
    assert [r[1] for r in cross] == [3 + 4, 3 + 4, 1 + 2, 1 + 2] and {r[2] for r in cross} == {b"\0"}


def test_pair_of_an_earlier_tree_is_not_counted_again():
    rows = unit([np.arange(10, dtype=np.uint64)] * 2, tree=3)
    assert jaccard._verify(rows, 0.8)
    for r in rows:
        now = np.frombuffer(r["now"], np.int64).copy()
        now[1] = 77
        r["now"] = now.tobytes()
    assert jaccard._verify(rows, 0.8) == []


def test_common_in_column_blocks(monkeypatch):
    monkeypatch.setattr(jaccard, "COLUMNS", 3)
    pick = np.random.default_rng(1)
    sets = [np.unique(pick.integers(0, 60, 25)).astype(np.uint64) for _ in range(12)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    got = jaccard._common(sets)
    assert all(got[i, j] == want[i][j] for i in range(12) for j in range(12) if i != j)


def test_threshold_itself_is_linked(spark):
    a = [f"w{i}" for i in range(22)]  # 18 n-grams; the longer text has 4 more, but one of them short
    texts = [" ".join(a[:20]), " ".join(a[:20] + a[20:22] + ["x", "y"])]
    assert len(shingles(texts[0])) / len(shingles(texts[1])) == 0.8
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_repeated_rows_count_once_each(spark):
    base = prose(3, 100)
    rows = [(1, base), (1, base), (2, changed(base, 1, 1)), (3, changed(base, 2, 1)), (3, changed(base, 2, 1)), (9, prose(8, 90))]
    got = jaccard.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 1, 4), (1, 1, 1, 4), (2, 1, 2, 4), (3, 1, 3, 4), (3, 1, 3, 4), (9, 9, 9, 0)]


def test_given_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_odd_documents(spark):
    df = odd(spark)
    got = jaccard.similar(df).collect()
    assert len(got) == df.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.class_id, r.copy_id, r.n_links))
    assert by[1] == [(1, 1, 2)] and by[2] == [(1, 1, 2)] * 2
    assert by[3] == [(3, 3, 0)] and by[4] == [(4, 4, 0)] and by[5] == [(5, 5, 0)]
    assert by[None] == [(None, None, 0)] * 2
    left = jaccard.one_of_each(df)
    assert left.columns == df.columns
    ids = [r.doc_id for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 7, 8, 9, 10, 10] and ids.count(None) == 2


def test_a_hot_group_hides_no_borderline_pairs(spark):
    """Pairs at the threshold are searched to the target although a hot group's pairs, all found, outnumber them by far."""
    base = prose(1, 120)
    rows = [(i, changed(base, i, 1)) for i in range(400)]
    for i in range(600):
        w = prose(10_000 + i, 50, 10**6).split()
        rows += [(1000 + 2 * i, " ".join(w)), (1001 + 2 * i, " ".join([*w[:46], "x", *w[47:]]))]  # 42 of 50 n-grams, 0.84
    got = {r.doc_id: r.class_id for r in jaccard.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[1001 + 2 * i] == 1000 + 2 * i for i in range(600)) >= 599


def test_texts_of_one_id_are_told_apart(spark):
    a, b, c = prose(1, 90), prose(2, 90), prose(3, 90)
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (2, b, "x"), (3, c, "x"), (3, changed(c, 1, 1), "x"), (4, None, "x"), (4, None, "y"), (4, " ", "x")]
    left = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = sorted(((r.doc_id, r.text, r.lang) for r in left.collect()), key=str)
    of_three = [r for r in got if r[0] == 3]
    assert len(of_three) == 1 and of_three[0] in rows
    assert [r for r in got if r[0] != 3] == sorted([(1, a, "x"), (2, b, "x"), (4, None, "x"), (4, None, "y"), (4, " ", "x")], key=str)


def test_empty_table(spark):
    assert jaccard.similar(empty(spark)).collect() == []


@pytest.mark.parametrize("size", [1, 3, 5])
def test_sets(size):
    texts = ["a b c d e f a b c d e", "a b", "", "a  b\nc\x0bd e"]
    (_, _, found), = W.blocks(pa.array(texts))
    for text, got in zip(texts, jaccard.shingle_sets(found, size)):
        w = text.split()
        want = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
        assert len(got) == len(want)


def test_components(spark):
    pick = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(pick.randrange(200, 300), pick.randrange(200, 300)) for _ in range(60)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    root = {n: n for e in edges for n in e}
    for _ in range(300):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {n: r for n, r in root.items() if any(a != b for a, b in edges if n in (a, b))}
