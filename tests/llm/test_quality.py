"""Quality measures against plain counts; cutoffs against their guarantee."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
from cases import empty, odd, prose

from millrace.llm import quality

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = BLANK.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if BLANK.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    cover = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(cover))


def check(df):
    got = quality.measures(df.select("doc_id", "text"))
    rows = got.collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    have = sorted(str((r.doc_id, *(r[n] for n in names))) for r in rows)
    assert have == sorted(str((r.doc_id, *plain(r.text))) for r in df.collect())


def test_odd_documents(spark):
    check(odd(spark))
    extra = quality.measures(odd(spark))
    assert extra.count() == odd(spark).count() and "key" in extra.columns


def test_given_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_repeats_and_lines(spark):
    texts = [
        "a\na\n\n \na \nb\na",
        prose(1, 30) + " " + prose(1, 30),
        "x " * 40,
        "    ## **\x0b\x0c<|>",
        "no\r\nno\r\nno",
    ]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_binomial():
    for n, p in ((1, 0.3), (17, 0.05), (400, 0.5), (900, 0.01)):
        exact = [math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1)]
        for k in range(-1, n + 1):
            assert abs(quality.binomial_cdf(k, n, p) - sum(exact[: k + 1])) < 1e-9
    bound = quality.upper_bound(0, 300, 0.05)
    assert abs(bound - (1 - 0.05 ** (1 / 300))) < 1e-9
    assert quality.upper_bound(5, 5, 0.1) == 1.0


def test_strictest_is_the_last_that_passes():
    above = [0, 0, 1, 2, 40, 3]
    n = quality.strictest(above, 1000, 0.02, 0.01)
    assert n == 4  # the fifth fails and ends the sequence
    assert all(quality.upper_bound(k, 1000, 0.01) <= 0.02 for k in above[:n])
    assert quality.strictest([0], 10, 0.02, 0.01) == 0  # too few labels for any claim


def test_guarantee_holds_on_fresh_draws():
    """Over many draws, the true false rejection exceeds the limit rarely."""
    pick = random.Random(2)
    grid = [i / 40 for i in range(40, 0, -1)]
    broken = 0
    for _ in range(150):
        sample = [pick.random() ** 3 for _ in range(800)]
        n = quality.strictest([sum(x > c for x in sample) for c in grid], len(sample), 0.05, 0.1)
        if n and 1 - grid[n - 1] ** (1 / 3) > 0.05:
            broken += 1
    assert broken <= 150 * 0.1 + 10


def labelled(spark):
    rows = []
    for i in range(4000):
        words = prose(i, 60)
        if i % 4 == 0:
            words = " ".join(w + "$$##" for w in words.split())
        rows.append((i, words, "en" if i % 2 else "de"))
    rows.append((9999, prose(1, 60), None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(4000)] + [(None, 1), (1, 1), (3, None)], "doc_id long, quality int")
    return docs, labels


def test_rules_reject_junk_and_keep_good(spark):
    docs, labels = labelled(spark)
    measured = quality.measures(docs)
    cutoffs = quality.thresholds(measured, labels, ["lang"], limit=0.05)
    for r in cutoffs.collect():
        assert r.bound <= 0.05 / len(quality.rules()) and r.lang in ("en", "de")
    judged = {r.doc_id: r.rejected_by for r in quality.verdicts(measured, cutoffs, ["lang"]).collect()}
    assert len(judged) == 4001
    assert all("symbols" in judged[i] for i in range(0, 4000, 4))
    assert sum(bool(judged[i]) for i in range(4000) if i % 4) <= 0.05 * 3000
    assert judged[9999] == []  # a stratum without labels


def test_cutoffs_count_as_brute_force(spark):
    """Good texts spread over a rule's cutoffs: the lenient ones pass, and the counts are those of the cutoff."""
    rows = [(i, " ".join(w.upper() if j < i % 13 else w for j, w in enumerate(prose(i, 60).split())), "en") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.selectExpr("doc_id", "1 as quality")
    limit, delta = 0.1, 0.05
    got = {r.rule: r for r in quality.thresholds(quality.measures(docs), labels, ["lang"], limit=limit, delta=delta).collect()}
    share = [sum(c.isupper() for c in t) / sum(not c.isspace() for c in t) for _, t, _ in rows]
    rules = quality.rules()
    above = [sum(x > c for x in share) for c in rules["capitals"][1]]
    passed = 0
    while quality.upper_bound(above[passed], len(rows), delta / len(rules)) <= limit / len(rules):
        passed += 1
    assert 0 < passed < len(above) and above[-1] > len(rows) / 2  # good texts exceed the strict end
    found = got["capitals"]
    assert (found.cutoff, found.n_good, found.n_rejected) == (rules["capitals"][1][passed - 1], 3000, above[passed - 1])
    assert found.bound <= limit / len(rules)


def test_joint_cutoffs_hold_the_limit_with_few_labels(spark):
    docs, labels = labelled(spark)
    few = labels.filter("doc_id < 1400")
    measured = quality.measures(docs)
    assert quality.thresholds(measured, few, ["lang"]).count() == 0  # each rule by itself: too few labels
    cutoffs = quality.joint_thresholds(measured, few, ["lang"])
    found = cutoffs.collect()
    assert {r.lang for r in found} == {"en", "de"} and all(r.bound <= quality.LIMIT for r in found)
    judged = {r.doc_id: r.rejected_by for r in quality.verdicts(measured, cutoffs, ["lang"]).collect()}
    assert sum("symbols" in judged[i] for i in range(0, 4000, 4)) >= 990
    assert sum(bool(judged[i]) for i in range(4000) if i % 4) <= quality.LIMIT * 3000
    for lang in ("en", "de"):
        mine = [r for r in found if r.lang == lang]
        assert len({(r.n_good, r.n_rejected, r.bound) for r in mine}) == 1


def test_tightenings_prefer_what_rejects_bad_rows_only():
    pick = np.random.default_rng(1)
    good = pick.random(2000) < 0.7
    clear = np.where(good, 40, pick.integers(0, 41, 2000))  # rejects no good row at any step
    vague = pick.integers(0, 41, 2000)  # says nothing
    path = quality.tightenings(np.column_stack([vague, clear]), good, [40, 40], 0.04)
    assert all(a[r] <= b[r] for a, b in zip(path, path[1:]) for r in (0, 1))
    assert path[-1][1] == 40
    first_vague = next((t for t, s in enumerate(path) if s[0]), len(path))
    assert path[first_vague - 1][1] >= 38
    hit = (vague < path[-1][0]) | (clear < path[-1][1])
    assert (hit & good).sum() <= 0.04 * good.sum()
    assert quality.tightenings(np.zeros((0, 2), int), np.zeros(0, bool), [40, 40], 0.04) == []


def test_joint_cutoffs_of_odd_tables(spark):
    docs = odd(spark).select("doc_id", "text", "lang")
    measured = quality.measures(docs)
    for labels in ([], [(1, None), (None, 1), (7, 1), (7, 0)], [(1, 1), (2, 1), (3, 0)]):
        table = spark.createDataFrame(labels, "doc_id long, quality int")
        judged = quality.verdicts(measured, quality.joint_thresholds(measured, table, ["lang"]), ["lang"])
        assert [r.rejected_by for r in judged.collect()] == [[]] * docs.count()


def test_without_labels_nothing_is_rejected(spark):
    docs = odd(spark).select("doc_id", "text", "lang")
    measured = quality.measures(docs)
    none = spark.createDataFrame([], "doc_id long, quality int")
    judged = quality.verdicts(measured, quality.thresholds(measured, none, ["lang"]), ["lang"])
    assert [r.rejected_by for r in judged.collect()] == [[]] * docs.count()


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    measured = quality.measures(empty(spark).select("doc_id", "text", "lang"))
    assert quality.verdicts(measured, quality.thresholds(measured, none, ["lang"]), ["lang"]).count() == 0
