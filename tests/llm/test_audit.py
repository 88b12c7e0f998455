from __future__ import annotations

import re
from collections import defaultdict
from itertools import permutations

import pytest
from cases import empty, odd
from pyspark.sql import functions as F

from millrace.llm import audit


def failures(docs, labels):
    """``(part, set of failed filters, good, toxic)`` of every document, one by one."""
    out = []
    for doc, text, part in docs:
        body = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", body)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", body)) > 3 * len(body):
            fails.add("C")
        if re.search("[#$%&*|]", body):
            fails.add("D")
        if doc is not None and any(d is not None and d < doc and (t or "") == body for d, t, _ in docs):
            fails.add("E")
        mine = [x for x in labels if doc is not None and x[0] == doc]
        out.append((part or "", fails, any(q == 1 for _, q, _ in mine), any(t == 1 for _, _, t in mine)))
    return out


def brute(found, letters="ABCDE"):
    rows, totals = {}, defaultdict(int)
    for part in {f[0] for f in found}:
        mine = [f for f in found if f[0] == part]
        for order in permutations(letters):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [f for f in left if letter in f[1]]
                failing = [f for f in mine if letter in f[1]]
                left = [f for f in left if letter not in f[1]]
                totals[part, letter] += len(gone)
                rows[part, "".join(order), step] = (
                    len(left), len(gone), len(failing) - len(gone), sum(f[1] == {letter} for f in failing),
                    sum(f[2] for f in gone), sum(f[3] for f in gone),
                )
    return {k: (*v, totals[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def found_in(df):
    columns = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): tuple(r[c] for c in columns) for r in rows}
    assert len(out) == len(rows)
    return out


LONG = " ".join(f"word{i}" for i in range(250))
DOCS = [
    (1, LONG, "en"), (2, LONG, "de"), (3, LONG + " #", "en"), (3, LONG + " #", "en"), (4, "a a a a", "en"), (5, "a a a a", None),
    (6, None, ""), (7, "", "en"), (None, LONG, "en"), (None, None, None), (8, "SHOUT " * 300, "de"), (9, "SHOUT " * 300, "de"),
    (10, "Ä" * 40 + " é", "fr"), (11, "one two\u00a0three\x0bfour\n", "fr"), (2, "another of the same id", "de"), (12, LONG, "en"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (4, None, None), (5, 1, 1), (9, 1, 1), (None, 1, 1), (99, 1, 1)]


def test_equals_applying_every_order(spark):
    docs = spark.createDataFrame([(*d, 1) for d in DOCS], "doc_id long, text string, lang string, mask int").repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert found_in(audit.interactions(audit.masks(docs, labels), "ABCDE")) == brute(failures(DOCS, LABELS))


def test_odd_and_empty_tables(spark):
    df, labels = odd(spark), spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    rows = [(r.doc_id, r.text, r.lang) for r in df.collect()]
    assert found_in(audit.interactions(audit.masks(df, labels), "ABCDE")) == brute(failures(rows, LABELS))
    assert audit.interactions(audit.masks(empty(spark), labels), "ABCDE").count() == 0
    none = labels.limit(0)
    assert found_in(audit.interactions(audit.masks(df, none), "ABCDE")) == brute(failures(rows, []))


def test_text_ids_and_other_filters(spark):
    docs = spark.createDataFrame([("b", "same", "x"), ("a", "same", "x"), ("c", "Other", "x")], "doc_id string, text string, lang string")
    labels = spark.createDataFrame([("a", 1, 0)], "doc_id string, quality int, toxic int")
    summed = audit.masks(docs, labels).groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    counts = {(r.part, r.mask): (r.n, r.good) for r in summed.filter("n > 0").collect()}
    assert counts == {("x", 1): (1, 1), ("x", 1 | 16): (1, 0), ("x", 1 | 4): (1, 0)}
    table = spark.createDataFrame([("p", 3, 5), ("p", 2, 1), ("p", 0, 7)], "part string, mask int, n long")
    rows = {(r.filter_order, r.step): (r.kept, r.removed) for r in audit.interactions(table, "xy", ["n"]).collect()}
    assert rows == {("xy", 1): (8, 5), ("xy", 2): (7, 1), ("yx", 1): (7, 6), ("yx", 2): (7, 0)}
    with pytest.raises(ValueError):
        audit.interactions(table, "xx")


def test_intervals_cover_each_order_once():
    for mask in range(1, 32):
        ranks = sorted(r for m, *_, begin, end in audit.removals(5) if m == mask for r in range(begin, end))
        assert ranks == list(range(120))
