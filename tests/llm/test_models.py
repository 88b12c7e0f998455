"""Toxicity chains and licence notices."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F
from cases import empty, odd, prose

from millrace.llm import licenses, linear, toxicity


def test_fit_separates():
    pick = np.random.default_rng(1)
    lists = [np.unique(pick.integers(0, 30, 5)) for _ in range(400)]
    dense = pick.normal(size=(400, 2))
    truth = np.array([3.0 * (3 in x) - 4.0 * (7 in x) for x in lists]) + dense[:, 0] - 0.5
    target = (linear.sigmoid(truth) > pick.random(400)).astype(float)
    w, v, b = linear.fit(linear.Rows(lists), dense, target, 30, 1e-3, 400)
    assert w[3] > 1 and w[7] < -1 and v[0] > 0.4 and abs(v[1]) < 0.5
    rows = linear.Rows(lists)
    error = linear.sigmoid(rows.times(w) + dense @ v + b) - target  # the gradient is nearly zero
    assert np.abs(rows.gather(error, 30) / 400 + 1e-3 * w).max() < 2e-3


def labelled(spark, n=1500):
    pick, rows = random.Random(3), []
    for i in range(n):
        words = prose(i, 50, 600).split()
        rude = i % 5 == 0
        severe = i % 10 == 0
        if rude:
            words[pick.randrange(50)] = pick.choice(("Blarg,", "snork"))
        if severe:
            words[pick.randrange(50)] = "zonk!"
        rows.append((i, " ".join(words), int(rude), int(severe), "x"))
    return spark.createDataFrame(rows, "doc_id long, text string, rude int, severe int, words string")


def test_chain(spark):
    docs = labelled(spark)
    chain = toxicity.learn(docs, ["rude", "severe"])
    assert [link.category for link in chain] == ["rude", "severe"]
    assert len(chain[0].earlier) == 0 and len(chain[1].earlier) == 1  # the later one sees the earlier
    assert {"blarg", "snork"} <= chain[0].words.keys() and "zonk" in chain[1].words
    got = toxicity.score(docs, chain).join(docs, "doc_id").collect()
    wrong = sum((r.p_rude >= 0.5) != r.rude or (r.p_severe >= 0.5) != r.severe for r in got)
    assert len(got) == 1500 and wrong <= 30


def test_fresh_documents(spark):
    chain = toxicity.learn(labelled(spark), ["rude", "severe"])
    texts = [(1, prose(9001, 3000, 600)), (2, prose(9002, 3000, 600) + " SNORK"), (3, None), (4, "")]
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(texts, "doc_id long, text string"), chain).collect()}
    assert got[1].p_rude < 0.5 <= got[2].p_rude and got[3].p_rude == got[4].p_rude < 0.5


def test_same_data_in_another_order_gives_the_same_model(spark):
    one = toxicity.learn(labelled(spark), ["rude", "severe"])
    two = toxicity.learn(labelled(spark).orderBy("words", "text").repartition(3), ["rude", "severe"])
    assert [link.words for link in one] == [link.words for link in two]


def test_toxicity_odd_and_empty(spark):
    chain = toxicity.learn(labelled(spark), ["rude", "severe"])
    got = toxicity.score(odd(spark), chain).collect()
    assert len(got) == odd(spark).count() and all(0 <= r.p_rude <= 1 for r in got)
    assert toxicity.score(empty(spark), chain).count() == 0
    bare = toxicity.learn(labelled(spark).limit(0), ["rude", "severe"])
    assert toxicity.score(odd(spark), bare).count() == odd(spark).count()


def licence_model(spark):
    docs = [(i, prose(i, 30) + "\n" + "the license of this work is in the file under terms\n" * (i % 2)) for i in range(60)]
    return licenses.learn(spark.createDataFrame(docs, "doc_id long, text string"))


def test_held_out_documents_of_the_given_table(spark):
    """Trained on two thirds of the labels, right on the rest: hardly any junk or clean text is mistaken."""
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").selectExpr("doc_id", "1 - quality as junk", "toxic")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").join(labels, "doc_id")
    docs = docs.withColumn("out", F.pmod(F.xxhash64("text"), F.lit(3)) == 0)
    chain = toxicity.learn(docs.filter("not out"), ["junk", "toxic"])
    found = toxicity.score(docs.filter("out").select("doc_id", "text"), chain).join(labels, "doc_id").collect()
    for kind, least in (("junk", 0.95), ("toxic", 0.75)):
        hits = [r[f"p_{kind}"] >= 0.5 for r in found if r[kind]]
        false = [r[f"p_{kind}"] >= 0.5 for r in found if not r[kind]]
        assert len(hits) > 100 and sum(hits) >= least * len(hits) and sum(false) <= 0.005 * len(false)


def test_notices(spark):
    model = licence_model(spark)
    texts = [
        (1, "Some words first.\n\nRELEASED under the MIT license\nand more words"),
        (2, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-SA 4.0."),
        (3, "Licensed under the Frobnicate Public Accord, Version 9, see the License for terms of this license"),
        (4, "It was released in the spring of that year by the author of this text."),
        (5, None),
        (6, ""),
        (7, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version."),
    ]
    rows = licenses.scan(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()
    got = sorted((r.doc_id, r.line, r.family) for r in rows)
    assert [g for g in got if g[0] != 3] == [(1, 1, "MIT"), (2, 0, "CC-BY-NC"), (2, 1, "CC-BY-SA"), (7, 0, "GPL")]
    assert [g[2] for g in got if g[0] == 3] in ([], ["unknown"])
    assert all(0 <= r.agreement <= 1 and r.probability >= licenses.NOTICE for r in rows)


def test_notice_amid_other_text(spark):
    """Text on the same line does not take a notice's family."""
    model = licence_model(spark)
    mit = next(t for t in licenses.TEMPLATES["MIT"] if t.startswith("Permission"))
    texts = [
        (1, "Copyright (c) 2023 Jane Doe. All rights reserved."),
        (2, f"{prose(1, 400)} {mit} {prose(2, 400)}"),
        (3, f"{prose(3, 30)} Licensed under the BSD 3-Clause License. {prose(4, 30)}"),
        (4, prose(5, 400) + " the license of this work is in the file under terms"),
    ]
    rows = licenses.scan(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()
    got = {r.doc_id: r.family for r in rows}
    assert (got[1], got[2], got[3]) == ("Reserved", "MIT", "BSD") and got.get(4, "unknown") == "unknown"
    assert all(licenses.AGREEMENT <= r.agreement <= 1 for r in rows if r.family != "unknown")


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""


def test_wrapped_notices_and_near_families(spark):
    model = licence_model(spark)
    agpl = next(t for t in licenses.TEMPLATES["AGPL"] if t.startswith("This program"))
    texts = [
        (1, "MIT", MIT),
        (2, "ISC", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above"),
        (3, "AGPL", agpl),
        (4, "CC-BY-NC-ND", "Licensed under CC BY-NC-ND 4.0."),
        (5, "CC-BY-NC", "Licensed under CC BY-NC 4.0."),
        (6, "GPL", agpl.replace("Affero ", "")),
    ]
    rows = licenses.scan(spark.createDataFrame(texts, "doc_id long, family string, text string"), model).collect()
    for doc, family, text in texts:
        found = [r.family for r in rows if r.doc_id == doc]
        assert found.count(family) >= 0.5 * len(text.split("\n")) and set(found) <= {family, "unknown"}, (family, found)


def test_the_bound_is_the_calibrated_one(spark):
    """No more than the stated share of the notices of families held out would pass as another family."""
    model = licence_model(spark)
    assert 0.5 <= model.bound <= 1 and model.held_out <= licenses.WRONG_FAMILY


def test_every_template_is_its_family(spark):
    model = licence_model(spark)
    texts = [(k, f, t) for k, (f, t) in enumerate((f, t) for f, ts in licenses.TEMPLATES.items() for t in ts)]
    docs = spark.createDataFrame(texts, "doc_id long, family string, text string")
    got = {r.doc_id: r.family for r in licenses.scan(docs, model).collect()}
    assert len(got) == len(texts)
    right = sum(got[k] == f for k, f, _ in texts)
    assert right >= 0.9 * len(texts) and all(got[k] in (f, "unknown") for k, f, _ in texts)


def test_held_out_family_is_unknown(spark):
    """Notices of a family that was never shown are not given another's name."""
    rest = {f: t for f, t in licenses.TEMPLATES.items() if f != "MPL-2.0"}
    docs = spark.createDataFrame([(i, prose(i, 30)) for i in range(30)], "doc_id long, text string")
    model = licenses.learn(docs, templates=rest)
    unseen = spark.createDataFrame(list(enumerate(licenses.TEMPLATES["MPL-2.0"])), "doc_id long, text string")
    assert {r.family for r in licenses.scan(unseen, model).collect()} <= {"unknown"}


def test_licences_odd_and_empty(spark):
    model = licence_model(spark)
    assert licenses.scan(odd(spark), model).collect() == []
    assert licenses.scan(empty(spark), model).collect() == []
    bare = licenses.learn(empty(spark))
    assert licenses.scan(odd(spark), bare).collect() == []
