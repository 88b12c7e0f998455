"""Byte-level BPE against the tiktoken library."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from cases import empty, odd

from millrace.llm import bpe

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    with open(VOCABULARY) as f:
        return bpe.parse_ranks(f.read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    pick = random.Random(1)
    made = ["".join(pick.choice(" \n\tab's1é. \x1cćñ日") for _ in range(pick.randrange(40))) for _ in range(1500)]
    made += ["".join(pick.choice("theandi ") for _ in range(pick.randrange(300))) for _ in range(200)]
    fixed = ["", " ", "\n", " a", "a ", "x  y\n\n z ", "it's we'll\tx\x1cy \x85z", "a\0b c", "<|endoftext|> x", "\r\n\r\nA b", "a\n'b 's"]
    return made + fixed + ["a" * 20_000, "ab" * 10_000, "á" * 3000, "x" * 1001 + " " * 50 + "y"]


def test_encodes_like_the_library(ranks, library):
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    for _ in range(2):  # with and without a memo
        for text, ids in zip(texts(), encoder.encode(texts())):
            assert np.frombuffer(ids, np.int32).tolist() == library.encode_ordinary(text), text[:50]


def test_without_cutting_at_spaces(ranks, library):
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN, spaced=False)
    for text, ids in zip(texts(), encoder.encode(texts())):
        assert np.frombuffer(ids, np.int32).tolist() == library.encode_ordinary(text), text[:50]


def test_small_memo_and_queue(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 10)
    monkeypatch.setattr(bpe, "QUEUE_BYTES", 20)
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    for text in texts()[::9]:
        assert np.frombuffer(encoder.encode([text])[0], np.int32).tolist() == library.encode_ordinary(text)


def test_queue_pops_lowest_rank_in_order():
    queue = bpe.RankQueue(70_000)
    queue.push(np.array([300, 5, 300, 65_000]), np.array([9, 1, 4, 2]))
    queue.push(np.array([300, 5]), np.array([3, 0]))
    popped = []
    while True:
        rank, at = queue.pop()
        if rank < 0:
            break
        popped.append((rank, at.tolist()))
    assert popped == [(5, [0, 1]), (300, [3, 4, 9]), (65_000, [2])]


def test_random_vocabularies():
    """Ranks in any order, also with joins that make pairs of a lower rank."""
    pick = random.Random(4)
    for seed in range(30):
        tokens = {bytes([b]) for b in range(256)}
        pool = [b"a", b"b", b"c"]
        for _ in range(40):
            token = pick.choice(pool) + pick.choice(pool)
            pool.append(token)
            tokens.add(token)
        order = sorted(tokens)
        pick.shuffle(order)
        ranks = {t: i for i, t in enumerate(order)}
        table = bpe.PairTable(ranks)
        pieces = ["".join(pick.choice("abc") for _ in range(pick.randrange(1, 60))).encode() for _ in range(60)]
        for piece, ids in zip(pieces, bpe.merge_all(pieces, table)):
            parts = [piece[i : i + 1] for i in range(len(piece))]
            while True:
                found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
                if not found:
                    break
                _, i = min(found)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert np.frombuffer(ids, np.int32).tolist() == [ranks[p] for p in parts], (seed, piece)


def test_missing_byte_is_refused():
    with pytest.raises(ValueError, match="no rank"):
        bpe.PairTable({b"a": 0})


def test_round_trip_of_odd_documents(spark, library):
    docs = odd(spark)
    done = bpe.decode(bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN), VOCABULARY)
    assert set(docs.columns) <= set(done.columns)
    rows = done.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert list(r.ids) == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_empty_table(spark):
    assert bpe.decode(bpe.encode(empty(spark), VOCABULARY, public_tokenizers.PATTERN), VOCABULARY).collect() == []


def test_encoded_once(spark):
    done = bpe.decode(bpe.encode(odd(spark), VOCABULARY, public_tokenizers.PATTERN), VOCABULARY).select("ids", "decoded")
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert plan.count("encoded(") == 1


def test_files_of_one_name_are_told_apart(spark, tmp_path, ranks):
    """The content of a vocabulary counts, not its file's name."""
    import base64

    docs = spark.createDataFrame([("the the",)], "text string")
    found = []
    for folder, most in (("a", 300), ("b", 60_000)):
        (tmp_path / folder).mkdir()
        path = tmp_path / folder / "ranks"
        path.write_text("".join(f"{base64.b64encode(t).decode()} {r}\n" for t, r in ranks.items() if len(t) == 1 or r < most))
        done = bpe.decode(bpe.encode(docs, str(path), public_tokenizers.PATTERN), str(path)).first()
        assert bytes(done.decoded) == b"the the"
        found.append(len(done.ids))
    assert found[0] > found[1] == 2


def test_unknown_ids_are_an_error(spark):
    with pytest.raises(Exception, match="an id without a token"):
        bpe.decode(spark.createDataFrame([([1, 60_000],)], "ids array<int>"), VOCABULARY).collect()


def test_one_worker_encodes_and_decodes(spark):
    """The same columns as by two functions, in one evaluation by Python."""
    docs = odd(spark)
    apart = bpe.decode(bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN), VOCABULARY)
    both = bpe.round_trip(docs, VOCABULARY, public_tokenizers.PATTERN)
    assert both.schema.simpleString() == apart.schema.simpleString()
    assert sorted(map(repr, both.collect())) == sorted(map(repr, apart.collect()))
    plan = both.select("ids", "decoded")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert bpe.round_trip(empty(spark), VOCABULARY, public_tokenizers.PATTERN).collect() == []
