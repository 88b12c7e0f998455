"""Quality rules whose cutoffs come with a guarantee.

Measures of every text are taken in one pass.  For each stratum and rule, cutoffs are tried from
the most lenient to the strictest on labelled good documents: a cutoff passes if the exact
(Clopper-Pearson) upper bound of its share of falsely rejected good documents stays within the
rule's part of the limit.  The first that fails ends the sequence, which keeps the error of the
whole sequence at that of one test; the error is divided over all strata and rules (Bonferroni).
So with probability ``1 - delta`` no stratum loses more than ``limit`` of its good documents.
``joint_thresholds`` tightens all rules in one sequence, learned from labels that have no part in the
test, and divides the error by the strata alone; it makes the same claim with far fewer labels.  A
rule without a passing cutoff, or a stratum without enough labels, rejects nothing.

Rules: null text has no words; a null stratum is a stratum; a document is a good one if it has
labels and all are 1; repeated rows count each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import words as W
from millrace.llm.store import staged

#: Words of a window whose repetition counts.
WINDOW = 8
#: Share of a stratum's good documents that all rules together may reject, and the error of that claim.
LIMIT = 0.02
DELTA = 0.05
#: Thresholds are broadcast up to this many strata, else joined.
BROADCAST_STRATA = 10_000

_SYMBOLS = W._separators(b"#*$%&|<>")
_UPPER = W._separators(bytes(range(65, 91)))
_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _own(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Keys that differ between texts."""
    return W.mix(keys ^ W.mix(text.astype(np.uint64) + np.uint64(1)))


def measure(found: W.Words) -> list[np.ndarray]:
    """``_MEASURES`` of every text of a block."""
    data, offsets, n = found.data, found.offsets, len(found.first) - 1
    text = found.text
    chars = _per_text(~W.BLANKS[data] & ((data & 0xC0) != 0x80), offsets)
    newline = np.zeros(256, bool)
    newline[10] = True
    lines = W.find(data, offsets, newline)
    wordy = np.searchsorted(found.starts, lines.ends) > np.searchsorted(found.starts, lines.starts)
    line_text = lines.text[wordy]
    keys = _own(lines.hashes()[wordy], line_text)
    distinct = np.bincount(line_text[np.unique(keys, return_index=True)[1]], minlength=n)
    grams = W.ngrams(found.hashes(), WINDOW)
    at = np.flatnonzero(found.room()[: len(grams)] >= WINDOW)
    codes = pd.factorize(_own(grams[at], text[at]))[0]
    again = at[np.bincount(codes)[codes] > 1] if len(at) else at
    cover = np.zeros(len(text) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    covered = np.bincount(text[np.cumsum(cover[:-1]) > 0], minlength=n)
    return [
        found.counts,
        chars,
        _per_text(_SYMBOLS[data], offsets),
        np.bincount(line_text, minlength=n) - distinct,
        covered,
        _per_text(_UPPER[data], offsets),
    ]


def measures(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` without its text, with ``_MEASURES`` (long) appended; same-named columns are replaced."""
    kept = [c for c in df.columns if c != text and c not in _MEASURES]
    rows = df.select(*kept, df[text].alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in kept)])
    schema = ", ".join([schema, *(f"{m} bigint" for m in _MEASURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(kept))
            parts = [measure(found) for _, _, found in W.blocks(column)]
            values = [np.concatenate(x).astype(np.int64) for x in zip(*parts)] or [np.zeros(0, np.int64)] * len(_MEASURES)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), *map(pa.array, values)], [*kept, *_MEASURES]
            )

    return rows.mapInArrow(run, schema)


#: Badness of a text by rule, and the cutoffs tried, from lenient to strict.
def rules() -> dict[str, tuple[Column, list[float]]]:
    per_word = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    per_char = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    steps = [round(2 ** (-i / 4), 6) for i in range(40)]
    return {
        "symbols": (F.col("n_symbols") / per_word, [4 * s for s in steps]),
        "dup_lines": (F.col("n_dup_lines") / per_word, steps),
        "repeats": (F.col("n_repeat_words") / per_word, steps),
        "capitals": (F.col("n_upper") / per_char, steps),
        "long_words": (F.col("word_chars") / per_word, [64 * s for s in steps[:20]]),
    }


#: Labels that the joint sequence is learned from: a share of all, and at most so many.
LEARN_SHARE = 0.25
LEARN_ROWS = 20_000


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial count, exact to rounding."""
    if k >= n or p <= 0:
        return 1.0
    if p >= 1 or k < 0:
        return 0.0
    if k >= n * p:  # sum the upper tail, whose terms fall from its first
        return 1.0 - _falling(n - k - 1, n, 1 - p)
    return _falling(k, n, p)


def _falling(k: int, n: int, p: float) -> float:
    """Sum of the terms k, k-1, ..., 0, which fall since k is below the mean."""
    if k < 0:
        return 0.0
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    term = total = 1.0
    for j in range(k, 0, -1):
        term *= j / (n - j + 1) * (1 - p) / p
        total += term
        if term < total * 1e-17:
            break
    return min(1.0, math.exp(log) * total)


def upper_bound(k: int, n: int, delta: float) -> float:
    """The exact upper confidence bound of a share of which ``k`` of ``n`` were seen."""
    if k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if binomial_cdf(k, n, mid) > delta else (low, mid)
    return high


def strictest(above: list[int], n: int, limit: float, delta: float) -> int:
    """How many cutoffs, from the lenient end, reject provably few; ``above[i]`` of ``n`` exceed cutoff i."""
    passed = 0
    for k in above:
        if binomial_cdf(k, n, limit) > delta:  # the same as upper_bound(k, n, delta) > limit
            break
        passed += 1
    return passed


def thresholds(
    measured: DataFrame, labels: DataFrame, strata: list[str], key: str = "doc_id", label: str = "quality",
    limit: float = LIMIT, delta: float = DELTA,
) -> DataFrame:
    """``strata..., rule, cutoff, n_good, n_rejected, bound``: the cutoffs that passed."""
    tried = rules()
    good = (
        labels.filter(labels[key].isNotNull())
        .groupBy(labels[key].alias("__key"))
        .agg(F.min(F.coalesce(labels[label], F.lit(0))).alias("__good"))
        .filter("__good = 1")
        .select("__key")
    )
    names = [f"__s{i}" for i in range(len(strata))]
    values = [
        F.struct(F.lit(rule).alias("rule"), sum((value > c).cast("int") for c in cutoffs).alias("level"))
        for rule, (value, cutoffs) in tried.items()
    ]
    rows = measured.join(good, measured[key] == good["__key"]).select(
        *[measured[c].alias(n) for c, n in zip(strata, names)], F.inline(F.array(*values))
    )
    # At most one row for each level of each rule and stratum.
    counts = rows.groupBy(*names, "rule", "level").count()
    grouped = counts.groupBy(*names, "rule").agg(F.map_from_entries(F.collect_list(F.struct("level", "count"))).alias("at"))
    grouped = staged(grouped, "holdout-counts")
    tests = max(1, grouped.count())
    per_rule, level = limit / len(tried), delta / tests
    schema = "cutoff double, n_good bigint, n_rejected bigint, bound double"

    @F.udf(schema)
    def choose(rule: str, at: dict[int, int]):
        cutoffs = CUTOFFS[rule]
        n = sum(at.values())
        # A row exceeds its ``level`` strictest cutoffs, the last ones.
        above = [sum(c for lv, c in at.items() if lv >= len(cutoffs) - i) for i in range(len(cutoffs))]
        passed = strictest(above, n, per_rule, level)
        if not passed:
            return None
        k = above[passed - 1]
        return float(cutoffs[passed - 1]), n, k, upper_bound(k, n, level)

    CUTOFFS = {rule: cutoffs for rule, (_, cutoffs) in tried.items()}
    chosen = grouped.select(*names, "rule", choose("rule", "at").alias("found")).filter("found is not null")
    return chosen.select(*[F.col(n).alias(c) for c, n in zip(strata, names)], "rule", "found.*")


def tightenings(levels: np.ndarray, good: np.ndarray, steps: list[int], most: float) -> list[list[int]]:
    """A sequence of settings of all rules, ever stricter: ``settings[t][r]`` cutoffs of rule r are in force at step t.

    ``levels`` has for each row and rule the first cutoff that the row exceeds, ``steps`` the number
    of cutoffs of each rule.  The next step tightens the rule that rejects most bad rows for each
    good one, until more than the share ``most`` of the good rows is rejected or no bad row is left.
    """
    now, out = [0] * len(steps), []
    hit = np.zeros(len(good), bool)
    while True:
        best = None
        for r in range(len(steps)):
            open_bad = levels[~hit & ~good, r]
            next_bad = open_bad[open_bad < steps[r]]
            if len(next_bad):
                to = int(next_bad.min()) + 1
                fresh = ~hit & (levels[:, r] < to)
                price = (np.count_nonzero(fresh & ~good) / (np.count_nonzero(fresh & good) + 0.5), -r)
                if best is None or price > best[0]:
                    best = price, r, to, fresh
        if best is None:
            return out
        _, r, to, fresh = best
        hit |= fresh
        if np.count_nonzero(hit & good) > most * max(1, np.count_nonzero(good)):
            return out
        now = [*now[:r], to, *now[r + 1 :]]
        out.append(now)


def joint_thresholds(
    measured: DataFrame, labels: DataFrame, strata: list[str], key: str = "doc_id", label: str = "quality",
    limit: float = LIMIT, delta: float = DELTA,
) -> DataFrame:
    """As ``thresholds``, for all rules at once: ``limit`` holds for what any of them rejects.

    A part of the labels, ``LEARN_ROWS`` at most, gives the sequence in which the rules are
    tightened; the others, which had no say in it, decide for each stratum how far to go, by exact
    bounds in a fixed sequence.  The error ``delta`` is divided by the strata only, so a stratum
    needs far fewer labels than if each rule were judged by itself.
    """
    tried = rules()
    known = (
        labels.filter(labels[key].isNotNull() & labels[label].isNotNull())
        .groupBy(labels[key].alias("__key"))
        .agg((F.min(label) == 1).alias("__good"))
        .withColumn("__unit", F.pmod(F.xxhash64("__key", F.lit(41)), F.lit(1 << 30)) / float(1 << 30))
    )
    names = [f"__s{i}" for i in range(len(strata))]
    # The first cutoff that a row exceeds; the number of cutoffs if none.
    first = [
        (F.lit(len(cutoffs)) - sum((value > c).cast("int") for c in cutoffs)).alias(f"__r{i}")
        for i, (value, cutoffs) in enumerate(tried.values())
    ]
    rows = measured.join(known, measured[key] == known["__key"]).select(
        *[measured[c].alias(n) for c, n in zip(strata, names)], "__good", "__unit", "__key", *first
    )
    rows = staged(rows, "labelled-levels")
    levels = [f"__r{i}" for i in range(len(tried))]
    steps = [len(cutoffs) for _, cutoffs in tried.values()]
    total = rows.count()
    share = min(LEARN_SHARE, LEARN_ROWS / max(total, 1))
    sample = rows.filter(F.col("__unit") < share).select("__good", *levels).toPandas()  # LEARN_ROWS, about
    path = tightenings(sample[levels].to_numpy(int), sample["__good"].to_numpy(bool), steps, 2 * limit)
    kinds = [measured.schema[c].dataType.simpleString() for c in strata]
    schema = ", ".join([*(f"`{c}` {k}" for c, k in zip(strata, kinds)), "rule string, cutoff double, n_good bigint, n_rejected bigint, bound double"])
    if not path:
        return measured.sparkSession.createDataFrame([], schema)
    # The first step of the path at which a row's level of a rule is rejected.
    never = len(path)
    reached = [
        F.element_at(F.array(*[F.lit(next((t for t, s in enumerate(path) if s[r] > i), never)) for i in range(steps[r] + 1)]), F.col(f"__r{r}") + 1)
        for r in range(len(steps))
    ]
    held = rows.filter((F.col("__unit") >= share) & F.col("__good")).groupBy(*names, F.least(*reached).alias("step")).count()
    # At most one entry for each step of the path.
    grouped = staged(held.groupBy(*names).agg(F.map_from_entries(F.collect_list(F.struct("step", "count"))).alias("at")), "holdout-steps")
    level = delta / max(1, grouped.count())
    cuts = [cutoffs for _, cutoffs in tried.values()]

    @F.udf("array<struct<rule: string, cutoff: double, n_good: bigint, n_rejected: bigint, bound: double>>")
    def choose(at: dict[int, int]):
        n = sum(at.values())
        above = np.cumsum([at.get(t, 0) for t in range(len(path))]).tolist()
        passed = strictest(above, n, limit, level)
        if not passed:
            return []
        k = above[passed - 1]
        bound = upper_bound(k, n, level)
        return [(rule, float(cuts[r][s - 1]), n, k, bound) for r, (rule, s) in enumerate(zip(names_of_rules, path[passed - 1])) if s]

    names_of_rules = list(tried)
    return grouped.select(*[F.col(n).alias(c) for c, n in zip(strata, names)], F.inline(choose("at")))


def verdicts(measured: DataFrame, cutoffs: DataFrame, strata: list[str]) -> DataFrame:
    """``measured`` with ``rejected_by array<string>``: the rules whose cutoff the row exceeds."""
    names = [f"__s{i}" for i in range(len(strata))]
    table = cutoffs.groupBy(*[F.col(c).alias(n) for c, n in zip(strata, names)]).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("__cutoffs")  # one entry for each rule
    )
    table = staged(table, "thresholds")
    if table.count() <= BROADCAST_STRATA:
        table = F.broadcast(table)
    match = F.lit(True)
    for c, n in zip(strata, names):
        match &= F.col(c).eqNullSafe(F.col(n))
    hit = [F.when(value > F.col("__cutoffs")[rule], F.lit(rule)) for rule, (value, _) in rules().items()]
    return (
        measured.join(table, match, "left")
        .withColumn("rejected_by", F.array_compact(F.array(*hit)))
        .drop("__cutoffs", *names)
    )
