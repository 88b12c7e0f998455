"""Language of texts and of the spans within them.

Per-word scores are log-likelihoods of hashed character n-grams, learned from labelled texts.
The script of a word narrows the languages that may have written it; a Viterbi pass over the
words with a price for every switch labels spans; the language with most letters is the text's.

Rules: null text, and text without a letter, is ``und`` with score 0; a word in a script that no
learned language uses says nothing; a text of only such words gets the most frequent language;
ties go to the more frequent language, then by name; without any labelled text all is ``und``.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.memory import kept, lean, lean_column
from millrace.llm.store import small_batches
from millrace.llm.words import mix

#: Labelled texts of a language that are learned from, on average; a hash of the text picks them.
TRAIN_TEXTS = 4000
#: Languages that can be learned; labels with more are refused, none is left out.
MAX_LANGUAGES = 256
#: Buckets of hashed n-grams, and their lengths with the word's edges.
BUCKETS = 1 << 16
SIZES = (1, 2, 3, 4)
#: A language has a script if this share of its training words is written in it.
SCRIPT_SHARE = 0.01
#: How far one word can lower a language, and the price of a switch between words.
WORD_FLOOR = 6.0
SWITCH = 9.0
#: Characters of text labelled at once.
BLOCK_CHARS = 4_000_000
#: Words a worker remembers.
MEMO = 250_000

UNDETERMINED = "und"

# Where the letters of scripts begin (Unicode blocks, roughly); a script ends where the next begins.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"),
    (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x1900, "Other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"), (0x3040, "Kana"), (0x3100, "Other"),
    (0x3400, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"), (0xF900, "Han"),
    (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFE70, "Arabic"),
    (0xFF00, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Other"), (0x20000, "Han"), (0x32000, "Other"),
)
_BEGINS = [b for b, _ in SCRIPTS]

def _marks() -> str:
    """Combining marks, which belong to the word they stand in, as ranges of a character class."""
    found = [c for c in (*range(0x300, 0x20000), *range(0xE0100, 0xE01F0)) if unicodedata.category(chr(c))[0] == "M"]
    begins = [c for c, before in zip(found, [0, *found]) if c != before + 1]
    ends = [c for c, behind in zip(found, [*found[1:], 0]) if c != behind - 1]
    return "".join(f"{chr(b)}-{chr(e)}" for b, e in zip(begins, ends))


_WORD = re.compile(rf"[^\W\d_]+(?:[{_marks()}]+[^\W\d_]*)*")


def script_of(word: str) -> str:
    """The script of the first letter; empty if there is none."""
    for c in word:
        if c.isalpha():
            return SCRIPTS[bisect_right(_BEGINS, ord(c)) - 1][1]
    return ""


def _grams(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(word, bucket)`` of every n-gram, one pair of arrays for each length."""
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths  # after the blank that leads each word
    owner = np.repeat(np.arange(len(words)), lengths + 1)
    place = np.arange(len(owner))  # a word's leading blank and its letters
    stop = np.repeat(starts + lengths + 1, lengths + 1)
    for size in SIZES:
        total = np.full(len(owner), size, np.uint64)
        inside = place + size <= stop
        if size == 1:
            inside &= place != stop - 2 - np.repeat(lengths, lengths + 1)  # not the blank alone
        at = place[inside]
        total = total[inside]
        for j in range(size):
            total = mix(total * np.uint64(0x100000001B3) + codes[at + j])
        yield owner[inside], (total % np.uint64(BUCKETS)).astype(np.int64)


def _lower_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Model:
    """Languages (most frequent first), their n-gram scores and the scripts they use."""

    def __init__(self, languages: list[str], scores: np.ndarray, scripts: dict[str, np.ndarray]):
        self.languages = languages
        self.scores = scores  # buckets x languages
        self.scripts = scripts  # script: which languages use it

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of words, 0 for the best language and down to ``-WORD_FLOOR``; letters of each word."""
        scores = np.zeros((len(words), len(self.languages)), np.float32)
        for owner, bucket in _grams(words):
            begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else owner
            if len(owner):
                scores[owner[begins]] += np.add.reduceat(self.scores[bucket], begins, axis=0)
        letters = np.zeros(len(words), np.int64)
        for i, word in enumerate(words):
            script = script_of(word)
            users = self.scripts.get(script)
            if users is None:
                scores[i] = 0
            else:
                scores[i, ~users] = -np.inf
            letters[i] = len(word) if script else 0
        scores -= scores.max(axis=1, keepdims=True)
        return np.maximum(scores / len(SIZES), -WORD_FLOOR), letters


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model of the languages of the rows whose text and language are not null."""
    small_batches(labelled.sparkSession)
    rows = labelled.select(labelled[text].alias("text"), labelled[lang].alias("lang")).dropna()
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = [r.lang for r in sizes]
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), {})
    number = {lang: i for i, lang in enumerate(languages)}
    share = F.create_map(*[x for r in sizes for x in (F.lit(r.lang), F.lit(min(1.0, TRAIN_TEXTS / r["count"])))])
    unit = F.pmod(F.xxhash64("text", F.lit(17)), F.lit(1 << 40)) / float(1 << 40)
    sample = rows.filter(unit < F.coalesce(share[F.col("lang")], F.lit(0.0)))

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(languages), BUCKETS), np.int64)
        used: dict[tuple[int, str], int] = {}
        for batch in batches:
            for value, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                words, k = _lower_words(value.as_py()), number[lang]
                if words:
                    for _, bucket in _grams(words):
                        sums[k] += np.bincount(bucket, minlength=BUCKETS)
                    for word in words:
                        key = k, script_of(word)
                        used[key] = used.get(key, 0) + 1
        k, bucket = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(k.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.nulls(len(k), pa.string()), pa.array(sums[k, bucket])],
            ["k", "bucket", "script", "n"],
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in used], pa.int32()), pa.nulls(len(used), pa.int32()), pa.array([s for _, s in used], pa.string()), pa.array(list(used.values()), pa.int64())],
            ["k", "bucket", "script", "n"],
        )

    counted = sample.mapInArrow(count, "k int, bucket int, script string, n bigint")
    counted = counted.groupBy("k", "bucket", "script").agg(F.sum("n").alias("n"))
    # At most MAX_LANGUAGES * (BUCKETS + scripts) rows.
    found = counted.toPandas()
    sums = np.zeros((BUCKETS, len(languages)))
    grams = found[found.script.isna()]
    sums[grams.bucket.astype(int), grams.k] = grams.n
    smooth = sums + 0.5
    scores = np.log(smooth / smooth.sum(axis=0)).astype(np.float32)
    rest = found[found.script.notna() & (found.script != "")]
    total = rest.groupby("k").n.sum()
    scripts: dict[str, np.ndarray] = {}
    for k, script, n in zip(rest.k, rest.script, rest.n):
        if n >= SCRIPT_SHARE * total[k]:
            scripts.setdefault(script, np.zeros(len(languages), bool))[k] = True
    return Model(languages, scores, scripts)


def viterbi(scores: np.ndarray, word: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """The label of every word of many texts at once.

    ``word`` holds rows of ``scores``; text i has ``word[first[i]:first[i+1]]``.  Texts are walked
    in step, longest first, so that those still running are a prefix.
    """
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    lengths, begin = lengths[order], first[:-1][order]
    labels = np.zeros(len(word), np.int16)
    count, width = len(lengths), scores.shape[1]
    if not len(word) or width == 1:
        return labels
    steps = int(lengths[0])
    running = np.searchsorted(-lengths, -np.arange(steps), "left")  # texts longer than t
    best = np.zeros((count, width), np.float32)
    own = np.arange(width, dtype=np.int16)
    back = []
    for t in range(steps):
        n = running[t]
        now = best[:n]
        if t:
            top = now.argmax(axis=1)
            jump = now[np.arange(n), top][:, None] - np.float32(switch)
            stay = now >= jump
            back.append(np.where(stay, own, top[:, None].astype(np.int16)))
            now = np.where(stay, now, jump)
        best[:n] = now + scores[word[begin[:n] + t]]
    state = best.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        n = running[t]
        labels[begin[:n] + t] = state[:n]
        if t:
            state[:n] = back[t - 1][np.arange(n), state[:n]]
    return labels


class Labeller:
    """Labels blocks of texts; remembers the scores of words."""

    def __init__(self, model: Model):
        self.model = model
        self.number: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)), np.float32)
        self.letters = np.zeros(0, np.int64)

    def label(self, texts: list[str]) -> tuple[list[str], list[float], list[list[dict]]]:
        number = self.number
        if not self.model.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts), [[] for _ in texts]
        if len(number) > MEMO:
            number.clear()
            self.scores, self.letters = self.scores[:0], self.letters[:0]
        rows, new = [], []
        for text in texts:
            words = _lower_words(text)
            try:
                rows.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
            except KeyError:
                for word in words:
                    if word not in number:
                        number[word] = len(number)
                        new.append(word)
                rows.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
        if new:
            scores, letters = self.model.words(new)
            self.scores = np.concatenate([self.scores, scores])
            self.letters = np.concatenate([self.letters, letters])
        word = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        counts = np.array([len(r) for r in rows], np.int64)
        first = np.concatenate([[0], np.cumsum(counts)])
        labels = viterbi(self.scores, word, first, SWITCH)
        languages, width = self.model.languages, len(self.model.languages)
        owner = np.repeat(np.arange(len(texts)), counts)
        letters = self.letters[word]
        sums = np.bincount(owner * width + labels, letters, len(texts) * width).reshape(-1, width)
        top = sums.argmax(axis=1)
        total = sums.sum(axis=1)
        score = sums[np.arange(len(texts)), top] / np.maximum(total, 1)
        names = [languages[k] if t else UNDETERMINED for k, t in zip(top.tolist(), total.tolist())]
        cuts = np.flatnonzero((np.diff(labels) != 0) | (np.diff(owner) != 0)) + 1
        begins = np.concatenate([[0], cuts]).astype(np.int64) if len(word) else cuts
        ends = np.concatenate([cuts, [len(word)]]).astype(np.int64) if len(word) else cuts
        spans: list[list[dict]] = [[] for _ in texts]
        for i, b, e, k in zip(owner[begins].tolist(), (begins - first[owner[begins]]).tolist(), (ends - begins).tolist(), labels[begins].tolist()):
            spans[i].append({"first_word": b, "n_words": e, "lang": languages[k]})
        return names, np.where(total > 0, score, 0.0).tolist(), spans


SPANS = "array<struct<first_word: bigint, n_words: bigint, lang: string>>"


def identify(df: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """Add ``out struct<lang_pred, score, spans>``; ``score`` is the share of the letters in its spans.

    A column of the name ``out`` is replaced; other columns pass.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # MAX_LANGUAGES * BUCKETS floats at most
    small_batches(df.sparkSession)
    key = uuid.uuid4().hex
    kind = pa.struct(
        [
            ("lang_pred", pa.string()),
            ("score", pa.float64()),
            ("spans", pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("lang", pa.string())]))),
        ]
    )

    @F.arrow_udf(f"struct<lang_pred: string, score: double, spans: {SPANS}>")
    @lean_column
    def label(column: pa.Array) -> pa.Array:
        labeller = kept((Labeller, key), lambda: Labeller(shared.value))
        out: list[pa.Array] = []
        block: list[str] = []
        held = 0

        def flush():
            names, scores, spans = labeller.label(block)
            out.append(
                pa.StructArray.from_arrays(
                    [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, kind.field("spans").type)],
                    fields=list(kind),
                )
            )
            block.clear()

        for item in column:
            block.append(str(item.as_buffer() or b"", "utf-8", "replace"))
            held += len(block[-1])
            if held >= BLOCK_CHARS:
                flush()
                held = 0
        if block or not out:
            flush()
        return pa.concat_arrays(out)

    return df.withColumn(out, label(df[text].cast("binary")))
