"""What the work on a batch has freed does not stay with the worker."""

from __future__ import annotations

import gc
import re
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from millrace.llm import bpe, language, memory
from millrace.llm import words as W
from millrace.llm.memory import kept, lean, lean_column


def held() -> int:
    """MB of this process without mapped files."""
    return int(re.search(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) // 1024


def littered() -> None:
    """Frees all but the last of many arrays that the C library keeps together."""
    parts = [np.ones(12_000) for _ in range(2000)]  # 190 MB, each too small to be mapped by itself
    global last
    last = parts[-1]


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="no /proc")
def test_freed_memory_is_given_back():
    batch = pa.RecordBatch.from_pydict({"x": ["a"]})

    def run(batches):
        for b in batches:
            littered()
            yield b

    def column(x):
        littered()
        return x

    before = held()
    assert list(lean(run)(iter([batch, batch]))) == [batch, batch]
    assert held() - before < 60
    assert lean_column(column)(batch.column(0)) == batch.column(0)
    assert held() - before < 60


def test_workers_forget_what_earlier_stages_kept(spark):
    texts = spark.createDataFrame([(i, f"some text {i}") for i in range(8)], "doc_id long, text string")
    model = language.Model(["a", "b"], np.zeros((language.BUCKETS, 2), np.float32), {})

    @lean
    def left_over(batches):
        for _ in batches:
            found = [type(o).__name__ for o in gc.get_objects() if isinstance(o, (bpe.Encoder, language.Labeller))]
            yield pa.RecordBatch.from_pydict({"found": found})

    for stage in (
        bpe.round_trip(texts, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN),
        language.identify(texts, model),
    ):
        stage.collect()
        assert not texts.mapInArrow(left_over, "found string").collect()


def test_what_is_kept_lasts_while_stages_use_it(monkeypatch):
    at = [1]
    monkeypatch.setattr(memory, "_stage", lambda: at[0])
    monkeypatch.setattr(memory, "_KEPT", {})
    made = []

    def use(key):
        return kept(key, lambda: made.append(key) or object())

    first, other = use("a"), use("b")  # two of one stage, by turns
    memory.give_back()
    assert use("a") is first and use("b") is other and made == ["a", "b"]
    at[0] = 2
    assert use("a") is first  # the next stage uses it, too
    memory.give_back()
    assert list(memory._KEPT) == ["a"]
    at[0] = 3
    use("c")
    assert list(memory._KEPT) == ["c"] and made == ["a", "b", "c"]


def test_word_hashes_are_those_of_the_bytes():
    texts = ["one two  one", "", None, "\xffä two", "x"]
    (_, _, found), *more = W.blocks(pa.array(texts))
    words = [w.encode() for t in texts for w in (t or "").split()]
    assert not more and [found.word(i) for i in range(len(words))] == words
    for seed in (0, 1):
        base = W._BASES[seed]
        want = [
            sum((c + 1) * pow(base, i, 1 << 64) for i, c in enumerate(w)) + len(w) * W._STEPS[seed] for w in words
        ]
        assert found.hashes(seed).tolist() == W.mix(np.array([v % (1 << 64) for v in want], np.uint64)).tolist()
