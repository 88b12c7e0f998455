"""Toxicity categories by a chain of linear classifiers.

The categories are predicted one after the other.  Every model sees the words that tell its
category apart, a few measures of the text (what is wrong with junk shows in those, not in words),
and the probabilities of the categories before it; for training, those come from
models that did not see the document (out of fold), so later models learn from predictions as
good as the ones they will get.

Fitting takes a bounded sample of labelled documents; scoring covers every document and whole texts.

Rules: words are lower-cased runs of letters, digits and marks; null or wordless text gets the
probabilities of no features; labels of a document are combined by their maximum, null is 0;
equal texts get equal scores.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.linear import Rows, fit, sigmoid
from millrace.llm.store import named

#: Labelled documents that are learned from, on average; a hash of the id picks them.
TRAIN_DOCUMENTS = 12_000
#: Words a category's model may use: the ones whose presence says most about it.
FEATURES = 2_000
#: A word must occur in so many sampled documents, and its association pass this chi-square.
LEAST_DOCUMENTS = 4
LEAST_CHI2 = 30.0
FOLDS = 4
PENALTY = 1e-4

_WORD = re.compile(r"\w+")
_CAPITAL = re.compile(r"[A-Z]")


#: Measures of a text.
MEASURES = 7
#: Marks and digits whose share of the characters is a measure.
_SYMBOLS, _DIGITS = "#*$%&|<>{}=_~^\\", "0123456789"


def _words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _measures(text: str | None, words: list[str]) -> list[float]:
    """Shares of symbols, digits, capitals, repeated words and repeated lines, mean length and number of words; each about 0 to 1."""
    text = text or ""
    chars, n, lines = max(1, len(text)), max(1, len(words)), [x for x in text.split("\n") if x.strip()]
    return [
        min(1.0, 10 * sum(map(text.count, _SYMBOLS)) / chars),
        min(1.0, 5 * sum(map(text.count, _DIGITS)) / chars),
        sum(1 for _ in _CAPITAL.finditer(text)) / chars,
        1 - len(set(words)) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        min(1.0, sum(map(len, words)) / n / 16),
        min(1.0, math.log1p(len(words)) / 10),
    ]


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


@dataclass
class Link:
    """One category's model: weights of words, of measures and earlier categories, and the bias."""

    category: str
    words: dict[str, float]
    measures: np.ndarray
    earlier: np.ndarray
    bias: float


def _chi2(docs: Column, hits: Column, total: Column, positives: Column) -> Column:
    """Association of a word with a category; 0 for rare words."""
    expected = docs * positives / total
    value = (hits - expected) ** 2 * total / (expected * (total - docs) * (1 - positives / total) + 1e-9)
    told = (docs >= LEAST_DOCUMENTS) & (positives > 0) & (positives < total)
    return F.when(told, value).otherwise(0.0)


def _telling(bags: DataFrame, categories: list[str]) -> pd.DataFrame:
    """Words that tell a category apart, with their association in all folds but one (``c<category>_<fold>``) and in all (``_all``).

    ``bags`` has ``fold, words`` and a 0/1 column for each category.  Counted in Spark; at most
    ``FEATURES`` words for each category and choice of folds come to the driver.
    """
    folds = range(FOLDS)
    flags = [F.when(F.col("fold") == k, 1).otherwise(0).alias(f"n{k}") for k in folds]
    flags += [F.when(F.col("fold") == k, F.col(c)).otherwise(0).alias(f"p{i}_{k}") for i, c in enumerate(categories) for k in folds]
    counted = bags.select("words", *flags)
    names = [n for n in counted.columns if n != "words"]
    sums = [F.sum(n).cast("double").alias(n) for n in names]
    totals = counted.agg(*sums).first()
    words = counted.select(F.explode("words").alias("word"), *names).groupBy("word").agg(*sums)
    scores = []
    for i, _ in enumerate(categories):
        for left in (*folds, "all"):
            used = [k for k in folds if k != left]
            docs, hits = (sum(F.col(f"{x}{k}") for k in used) for x in ("n", f"p{i}_"))
            total, positives = (sum(totals[f"{x}{k}"] or 0.0 for k in used) for x in ("n", f"p{i}_"))
            scores.append(_chi2(docs, hits, F.lit(max(total, 1.0)), F.lit(positives)).alias(f"c{i}_{left}"))
    scored = words.select("word", *scores)
    marks = scored.columns[1:]
    scored = scored.filter(F.greatest(*marks) >= LEAST_CHI2)
    return scored.orderBy(F.greatest(*marks).desc(), "word").limit(len(marks) * FEATURES).toPandas()


def _fit_link(category: str, vocabulary: list[str], bags: list[set[str]], before: np.ndarray, target: np.ndarray) -> Link:
    number = {w: i for i, w in enumerate(vocabulary)}
    rows = Rows([np.array(sorted(number[w] for w in bag if w in number), np.int64) for bag in bags])
    weights, dense, bias = fit(rows, before, target, len(vocabulary), PENALTY)
    return Link(category, dict(zip(vocabulary, weights.tolist())), dense[:MEASURES], dense[MEASURES:], bias)


def _apply(link: Link, bags: list[set[str]], before: np.ndarray) -> np.ndarray:
    keys, get = link.words.keys(), link.words.__getitem__
    # In sorted order: a set's order differs between workers, and so would the last bits of the sum.
    sums = np.array([sum(map(get, sorted(keys & bag))) for bag in bags])
    return sigmoid(sums + before[:, :MEASURES] @ link.measures + before[:, MEASURES:] @ link.earlier + link.bias)


def learn(labelled: DataFrame, categories: list[str], doc_id: str = "doc_id", text: str = "text") -> list[Link]:
    """Fit the chain on a sample of about ``TRAIN_DOCUMENTS`` rows of ``labelled``."""
    rows = named(labelled, doc_id, text, *categories)
    total = rows.count()
    unit = F.pmod(F.xxhash64(rows[doc_id], F.lit(5)), F.lit(1 << 40)) / float(1 << 40)
    sample = rows.filter(unit < min(1.0, TRAIN_DOCUMENTS / max(total, 1)))
    fold = F.pmod(F.coalesce(F.xxhash64(text, F.lit(29)), F.lit(0)), F.lit(FOLDS)).cast("int")  # copies share a fold
    targets = [F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c) for c in categories]
    sample = sample.select(text, fold.alias("fold"), *targets)

    def bags(only: frozenset[str] | None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(0).to_pylist()
                words = [_words(t) for t in texts]
                measures = pa.array([_measures(t, w) for t, w in zip(texts, words)], pa.list_(pa.float64()))
                words = [sorted(set(w) if only is None else only.intersection(w)) for w in words]
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.string())), measures, *batch.columns[1:]], names)

        names = ["words", "measures", "fold", *categories]
        return sample.mapInArrow(run, "words array<string>, measures array<double>, fold int, " + ", ".join(f"`{c}` int" for c in categories))

    telling = _telling(bags(None), categories)
    kept = bags(frozenset(telling.word)).toPandas()  # a few words of each sampled document
    kept["words"], kept["measures"] = [tuple(w) for w in kept.words], [tuple(m) for m in kept.measures]
    kept = kept.sort_values(["words", "measures", "fold", *categories], kind="stable").reset_index(drop=True)
    sets = [set(w) for w in kept.words]
    folds = kept.fold.to_numpy()
    before = np.array(kept.measures.tolist(), float).reshape(len(sets), MEASURES)
    chain: list[Link] = []
    for i, category in enumerate(categories):

        def vocabulary(left, i=i) -> list[str]:
            mark = telling[f"c{i}_{left}"]
            found = telling[mark >= LEAST_CHI2].sort_values([f"c{i}_{left}", "word"], ascending=[False, True])
            return found.word.head(FEATURES).tolist()

        target = kept[category].to_numpy(float)
        chain.append(_fit_link(category, vocabulary("all"), sets, before, target))
        unseen = np.zeros(len(sets))
        for k in range(FOLDS):
            train, test = np.flatnonzero(folds != k), np.flatnonzero(folds == k)
            link = _fit_link(category, vocabulary(k), [sets[j] for j in train], before[train], target[train])
            unseen[test] = _apply(link, [sets[j] for j in test], before[test])
        before = np.column_stack([before, _logit(unseen)])
    return chain


def score(df: DataFrame, chain: list[Link], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the probability of every category, ``p_<category>``, for every row."""
    shared = df.sparkSession.sparkContext.broadcast(chain)  # at most FEATURES words for each category
    names = [f"p_{link.category}" for link in chain]

    @F.arrow_udf("struct<" + ", ".join(f"`{n}`: double" for n in names) + ">")
    def probabilities(column: pa.Array) -> pa.Array:
        links = shared.value
        used = set().union(*(link.words for link in links)) if links else set()
        bags, measures = [], []
        for text in map(_text, column):
            words = _words(text)
            bags.append(used.intersection(words))
            measures.append(_measures(text, words))
        before = np.array(measures, float).reshape(len(bags), MEASURES)
        out = []
        for link in links:
            p = _apply(link, bags, before)
            out.append(pa.array(p))
            before = np.column_stack([before, _logit(p)])
        return pa.StructArray.from_arrays(out, names)

    rows = named(df, doc_id, text)
    return rows.withColumn("__p", probabilities(F.col(text).cast("binary"))).select(doc_id, "__p.*")


def _text(item: pa.Scalar) -> str:
    return str(item.as_buffer() or b"", "utf-8", "replace")
