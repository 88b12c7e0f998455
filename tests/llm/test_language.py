"""Language identification: held-out accuracy, mixed texts, and the walk itself."""

from __future__ import annotations

import itertools

import numpy as np
import pytest
from cases import empty, odd
from pyspark.sql import functions as F

from millrace.llm import language


def test_viterbi_is_the_best_path():
    pick = np.random.default_rng(1)
    scores = -pick.random((30, 3)).astype(np.float32) * 6
    lengths = [0, 1, 2, 5, 6, 0, 4]
    first = np.concatenate([[0], np.cumsum(lengths)])
    word = pick.integers(0, 30, first[-1])
    labels = language.viterbi(scores, word, first, 2.5)
    for b, e in zip(first[:-1], first[1:]):
        def worth(path):
            return sum(scores[word[b + t], k] for t, k in enumerate(path)) - 2.5 * sum(x != y for x, y in zip(path, path[1:]))

        if e > b:
            best = max(worth(p) for p in itertools.product(range(3), repeat=e - b))
            assert abs(worth(labels[b:e].tolist()) - best) < 1e-4


def test_scripts():
    assert [language.script_of(w) for w in ("word", "слово", "λόγος", "語", "あ", "½", "")] == [
        "Latin", "Cyrillic", "Greek", "Han", "Kana", "", ""
    ]


def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(spark):
    docs = corpus(spark).withColumn("out", F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2)
    found = language.identify(docs.filter("out"), language.learn(docs.filter("not out")))
    right, n = found.agg(F.avg((F.col("lang") == F.col("language.lang_pred")).cast("double")), F.count("*")).first()
    assert n > 200 and right > 0.97


def test_spans_of_mixed_text(spark):
    model = language.learn(corpus(spark))
    texts = {
        r.lang: " ".join(language._lower_words(r.text)[:60])
        for r in corpus(spark).filter("n_chars > 1500").orderBy("doc_id").collect()
    }
    both = spark.createDataFrame([(1, texts["en"] + " " + texts["de"] + " " + texts["en"])], "doc_id long, text string")
    got = language.identify(both, model).first().language
    assert [s.lang for s in got.spans] == ["en", "de", "en"]
    assert sum(s.n_words for s in got.spans) == 180 and abs(got.spans[1].first_word - 60) <= 2
    assert got.lang_pred == "en" and 0.5 < got.score < 0.8


def test_odd_documents(spark):
    docs = odd(spark)
    model = language.learn(docs.unionByName(corpus(spark).select(*[c for c in ("doc_id", "text", "lang", "source")]), True))
    rows = language.identify(docs, model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r.language.score <= 1
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.language.lang_pred == language.UNDETERMINED) == (not letters)
    found = {r.doc_id: r.language.lang_pred for r in rows}
    assert found[9] in model.languages


def test_no_labels_and_empty(spark):
    model = language.learn(empty(spark))
    assert {r.language.lang_pred for r in language.identify(odd(spark), model).collect()} == {"und"}
    assert language.identify(empty(spark), model).count() == 0


def test_languages_of_a_script_only(spark):
    """A Cyrillic word cannot be English."""
    rows = [(i, "the quick brown fox jumps over it", "en") for i in range(30)] + [
        (i, "быстрая лиса прыгает через собаку", "ru") for i in range(30, 60)
    ]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    scores, _ = model.words(["собаку", "fox"])
    en, ru = model.languages.index("en"), model.languages.index("ru")
    assert scores[0, ru] == 0 and scores[0, en] == -language.WORD_FLOOR and scores[1, en] == 0


def test_combining_marks_belong_to_their_word():
    assert language._lower_words("हिन्दी में e\u0301te\u0301 1a2 x_y") == ["हिन्दी", "में", "e\u0301te\u0301", "a", "x", "y"]


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 2)
    df = spark.createDataFrame([("one text", k) for k in ("a", "b")], "text string, lang string")
    assert language.learn(df).languages == ["a", "b"]
    with pytest.raises(ValueError):
        language.learn(df.union(spark.createDataFrame([("text", "c")], df.schema)))


def test_a_column_keeps_its_name(spark):
    df = spark.createDataFrame([(1, "some text", "mine")], "doc_id long, text string, language string")
    row = language.identify(df, language.Model([], np.zeros((language.BUCKETS, 0), np.float32), {}), out="found").first()
    assert row.language == "mine" and row.found.lang_pred == language.UNDETERMINED
