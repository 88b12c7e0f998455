"""Benchmark matches against dynamic programming over every document."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from cases import empty, odd, prose

from millrace.llm import decontaminate

WORD = re.compile(r"[a-z0-9\x80-\U0010ffff]+")


def words(text):
    return WORD.findall((text or "").lower())


def distance(item, text):
    """Least edit distance of ``item`` to any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(text, seed, n):
    w, pick = text.split(), random.Random(seed)
    for _ in range(n):
        i = pick.randrange(len(w))
        kind = pick.randrange(3)
        w[i : i + 1] = [[f"q{pick.randrange(99)}"], [], [w[i], f"q{pick.randrange(99)}"]][kind]
    return " ".join(w)


def items():
    return [(i, prose(100 + i, 10 + 4 * i, 3000)) for i in range(14)] + [(20, prose(100, 10, 3000)), (21, None), (22, "")]


def documents(most=1.0):
    pick, rows = random.Random(7), []
    bench = items()[:14]
    for i in range(160):
        text = prose(i, 60 + i, 3000)
        if i % 2:
            _, item = bench[i % 14]
            n = len(item.split())
            at = pick.randrange(50)
            w = text.split()
            part = edited(item, i, int(pick.random() * most * decontaminate.budget(n) + 0.5))
            text = " ".join(w[:at]) + "\n" + part.upper().replace(" ", ", ") + ". " + " ".join(w[at:])
        rows.append((i, text))
    return rows


def want(rows):
    found = {}
    for i, text in rows:
        for item, t in items():
            w = words(t)
            if w and (d := distance(w, words(text))) <= decontaminate.budget(len(w)):
                found[i, item] = d
    return found


def test_recall_and_exactness(spark):
    bench = spark.createDataFrame(items(), "item_id long, text string")
    rows = documents()
    expected = want(rows)
    got = decontaminate.matches(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    found = {(r.doc_id, r.item_id): r.distance for r in got}
    assert found.items() <= expected.items()  # every match is one, with its least distance
    assert len(found) >= 0.95 * len(expected) and len(expected) > 80
    exact = {k for k, d in expected.items() if d == 0}
    assert exact <= found.keys()


def test_edits_at_the_limit_in_one_place():
    """Wherever the edits lie: the first half, the last, both ends, a block lost near the beginning."""
    for low, n in ((15, 18), (45, 50), (45, 55)):
        bench = [prose(1000 * n + i, n, 10**6) for i in range(100)] + [prose(n, low, 10**6)]
        index = decontaminate.build(list(range(101)), bench)
        k, pick = decontaminate.budget(n), random.Random(n)
        places = [range(n // 2), range(n - n // 2, n), [*range(n // 5), *range(n - n // 5, n)], range(2, 2 + k)]
        for where in places:
            texts = []
            for i, item in enumerate(bench[:100]):
                w = item.split()
                for j in pick.sample(list(where), k):
                    w[j] = "" if where is places[-1] else f"q{pick.randrange(10**6)}"
                texts.append(" ".join([prose(5000 + i, 40, 10**6), *w, prose(7000 + i, 40, 10**6)]))
            found = {row for row, item, *_ in decontaminate.search(index, pa.array(texts)) if row == item}
            assert len(found) >= 98


def test_positions(spark):
    item = prose(1, 30, 3000)
    rows = [(1, prose(2, 40, 3000) + " " + item + " " + prose(3, 40, 3000) + " " + item)]
    bench = spark.createDataFrame([(5, item)], "item_id long, text string")
    got = decontaminate.matches(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert sorted((r.first_word, r.n_words, r.distance) for r in got) == [(40, 30, 0), (110, 30, 0)]


def test_occurrences_side_by_side(spark):
    """An occurrence at the limit of edits, next to an exact one on either side, and many in a row."""
    items = [prose(50 + i, 50, 3000) for i in range(10)]
    rows = []
    for i, item in enumerate(items):
        w = item.split()
        for j in random.Random(i).sample(range(50), 10):
            w[j] = f"q{j}"
        near = " ".join(w)
        rows.append((i, f"{prose(2, 30)} {near} {item} {prose(3, 30)}"))
        rows.append((100 + i, f"{item} {near}"))
        rows.append((200 + i, " ".join([item] * 30)))
    index = decontaminate.build(list(range(10)), items)
    found = {}
    for row, item, d, first, n in decontaminate.search(index, pa.array([t for _, t in rows])):
        assert item == rows[row][0] % 100
        found.setdefault(rows[row][0], []).append((first, n, d))
    for i in range(10):
        exact = [f for f in found[i] if f[1:] == (50, 0)]
        assert exact == [(80, 50, 0)] and len(found[i]) == 2
        assert sorted(found[100 + i])[0] == (0, 50, 0) and len(found[100 + i]) == 2
        assert sorted(found[200 + i]) == [(50 * k, 50, 0) for k in range(30)]


def test_blocks_of_items(spark, monkeypatch):
    bench = spark.createDataFrame(items(), "item_id long, text string")
    docs = spark.createDataFrame(documents(0), "doc_id long, text string")
    one = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 100)
    more = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()}
    assert one == more and len(one) >= 80


def test_align():
    pick = random.Random(3)
    for _ in range(300):
        item = [pick.randrange(4) for _ in range(pick.randrange(1, 8))]
        text = [pick.randrange(4) for _ in range(pick.randrange(0, 12))]
        d, b, e = decontaminate.align(np.array(item, np.uint64), np.array(text, np.uint64))
        assert d == distance(item, text) and 0 <= b <= e <= len(text)
        part = text[b:e]
        row = list(range(len(part) + 1))  # the whole of the part has this distance
        for i, x in enumerate(item, 1):
            new = [i]
            for j, y in enumerate(part, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
            row = new
        assert row[-1] == d


def test_short_items():
    index = decontaminate.build([1, 2, 3], ["one", "two words", "five words are in here"])
    texts = ["x one y", "two, WORDS!", "five words are not in here", "nothing of that kind"]
    found = {(row, index.ids[item]) for row, item, *_ in decontaminate.search(index, pa.array(texts))}
    assert found == {(0, 1), (1, 2), (2, 3)}


def test_clean_documents_stay(spark):
    bench = spark.createDataFrame(items(), "item_id long, text string")
    docs = odd(spark)
    assert decontaminate.matches(docs, bench).count() == 0
    assert sorted(map(str, decontaminate.without_matches(docs, bench).collect())) == sorted(map(str, docs.collect()))
    rows = documents(0)
    left = decontaminate.without_matches(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    assert {r.doc_id for r in left.collect()} == {i for i, _ in rows} - {i for i, _ in want(rows)}


def test_empty_tables(spark):
    bench = spark.createDataFrame(items(), "item_id long, text string")
    assert decontaminate.matches(empty(spark), bench).count() == 0
    assert decontaminate.matches(odd(spark), bench.limit(0)).count() == 0
    assert decontaminate.without_matches(odd(spark), bench.limit(0)).count() == odd(spark).count()


def test_given_items_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()}
    texts = [(r.item_id, r.text) for r in bench.collect()]
    whole = {(r.doc_id, i) for r in docs.collect() for i, t in texts if t in r.text}
    assert whole and whole <= found
