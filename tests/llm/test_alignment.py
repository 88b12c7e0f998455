from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from cases import empty, odd, prose
from tokenizers import Tokenizer

from millrace.llm import alignment

A, B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


class Plain:
    """The contract, token by token, with the libraries themselves."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.of_char = alignment._byte_of_char()

    def tokens(self, text):
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        spelled_a = [bytes(self.of_char[c] for c in self.a.id_to_token(i)) for i in a]
        spelled_b = []
        for i in b:
            piece = self.b.id_to_piece(i)
            byte = self.b.is_byte(i)
            spelled_b.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode())
        return a, spelled_a, b, spelled_b

    def document(self, text):
        """``(n_a, n_b, groups, links)``."""
        if not text:
            return 0, 0, [], []
        a, spelled_a, b, spelled_b = self.tokens(text)
        whole = (" " + text).encode()
        if b"".join(spelled_a) != whole or b"".join(spelled_b) != whole:
            return 0, 0, [], []

        def ranges(spelled):
            end, out = 0, []
            for s in spelled:
                out.append((end, end + len(s)))
                end += len(s)
            return out

        ra, rb = ranges(spelled_a), ranges(spelled_b)
        ends = sorted({e for _, e in ra} & {e for _, e in rb})
        groups, begin = [], 0
        for end in ends:
            groups.append(
                (
                    [i for i, r in zip(a, ra) if begin <= r[0] < end],
                    [i for i, r in zip(b, rb) if begin <= r[0] < end],
                )
            )
            begin = end
        links = [(i, j) for i, r in zip(a, ra) for j, s in zip(b, rb) if r[0] < s[1] and s[0] < r[1]]
        return len(a), len(b), groups, links


@pytest.fixture(scope="module")
def plain():
    return Plain()


TEXTS = [
    "The cat sat on the mat.\n\nThe cat again;  two blanks",
    "日本語 und Österreich, naïve café 🙂🙂 <|endoftext|> </s>",
    "▁ a text that side B rewrites",
    "tabs\tand\r\nline ends \x00 and 0x0A <0x0A>",
    "é combining, ﬁ ligature, 123456 7,89",
    "   leading and trailing   ",
    "The cat sat on the mat.\n\nThe cat again;  two blanks",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaab",
    "",
    None,
]


def expected(plain, rows):
    """By the contract: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest`` of ``(doc_id, text)`` rows."""
    found = [(doc, *plain.document(text)) for doc, text in rows]
    counts = Counter(pair for *_, links in found for pair in links)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for doc, n_a, n_b, groups, links in found:
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append(
            (
                doc, n_a, n_b, len(groups), len(links),
                sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links),
                hashlib.sha256(shown.encode()).hexdigest() if n_a else "",
            )
        )
    return sorted(out, key=str)


def results(spark, df, frequent):
    aligned = alignment.align(df, A, B, digest=True)
    found = alignment.scored(aligned, alignment.frequencies(aligned), frequent)
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r[c] for c in columns) for r in found.collect()), key=str)


@pytest.mark.parametrize("frequent", [0, 20, 400_000])
def test_results_follow_the_contract(spark, plain, frequent):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert results(spark, df, frequent) == expected(plain, rows)


def test_odd_and_empty_tables(spark, plain):
    df = odd(spark)
    # Brute force takes the square of the tokens; the long ones are tested below.
    short = df.filter("text is null or length(text) < 5000")
    rows = [(r.doc_id, r.text) for r in short.collect()]
    assert results(spark, short, 20) == expected(plain, rows)
    assert alignment.align(df, A, B).count() == df.count()
    assert results(spark, empty(spark), 20) == []


def test_groups_as_lists(spark, plain):
    texts = [t for t in TEXTS if t]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in alignment.align(df, A, B).collect():
        n_a, n_b, groups, links = plain.document(texts[row.doc_id])
        assert [(list(g.a), list(g.b)) for g in row.groups] == groups
        assert Counter({(x.a, x.b): x.n for x in row.links}) == Counter(links)
        assert (row.n_a, row.n_b, row.n_links) == (n_a, n_b, len(links))


def test_long_texts_keep_their_tokens(spark, plain):
    texts = [prose(1, 40_000, 5000), "x" * 100_000, "é" * 50_000, " " * 30_000 + "a"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in alignment.align(df, A, B).collect():
        a, spelled_a, b, spelled_b = plain.tokens(texts[row.doc_id])
        assert b"".join(spelled_b) == (" " + texts[row.doc_id]).encode()
        assert [i for g in row.groups for i in g.a] == a
        assert [i for g in row.groups for i in g.b] == b
        # Two cuts of one stretch overlap in as many pairs as there are pieces, less the common ends.
        assert row.n_links == len(a) + len(b) - row.n_groups


def test_ranks_stand_for_the_merges(plain):
    """The quick way is taken, and every token is made by its own merges alone."""
    with open(A, "rb") as file:
        side = alignment._byte_level(file.read())
    assert len(side) == 50_257
    tokens = [side.data[b:e].tobytes() for b, e in zip(side.offsets, side.offsets[1:])]
    assert [plain.a.token_to_id(plain.a.id_to_token(i)) for i in range(0, 50_257, 97)] == list(range(0, 50_257, 97))
    words = [t.decode() for t in tokens[:50_256] if t.isascii() and (t[:1] == b" " and t[1:].isalpha() or t.isalpha())]
    found = plain.a.encode_batch(words, add_special_tokens=False)
    assert len(words) > 30_000 and all(len(e.ids) == 1 for e in found)


def test_other_vocabularies_go_through_the_library(tmp_path):
    with open(A, encoding="utf-8") as file:
        content = file.read()
    import json

    config = json.loads(content)
    config["model"]["merges"][100], config["model"]["merges"][101] = config["model"]["merges"][101], config["model"]["merges"][100]
    changed = json.dumps(config)
    library = Tokenizer.from_str(changed)
    library.encode_special_tokens = True
    side = alignment._byte_level(changed.encode())
    assert [list(x) for x in side.encode(["some text with an <|endoftext|>"])] == [
        library.encode(" some text with an <|endoftext|>", add_special_tokens=False).ids
    ]


def test_files_of_another_kind_are_refused(spark):
    with pytest.raises(ValueError):
        alignment.align(spark.createDataFrame([(1, "a")], "doc_id long, text string"), "/tmp/a.txt", B)
