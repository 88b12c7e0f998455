"""Small tables that every operator must take: nulls, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import random

CLASHING = "id long, key string, size int, digest string, shard int, ids string, language string, n_words int, found int"


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    pick = random.Random(seed)
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(n))


def odd(spark):
    """Documents with everything unusual; ``doc_id, text, lang, source`` and columns of clashing names."""
    long = prose(1, 30_000, 5_000)
    texts = [
        (1, prose(2, 120), "en", "a"),
        (2, prose(2, 120), "en", "a"),  # a copy
        (2, prose(2, 120), "en", "a"),  # a repeated row
        (3, None, "en", None),
        (4, "", None, "b"),
        (5, " \n\t ", "de", "b"),
        (6, "...!!! 123 456", "de", "b"),
        (7, long, "en", "a"),
        (8, "x" * 50_000, "fr", "c"),
        (9, "日本語のテキスト と English words", "ja", "c"),
        (10, "one", "en", "c"),
        (10, "another text of the same id", "en", "c"),
        (None, prose(2, 120), "en", "c"),
        (None, None, None, None),
    ]
    rows = [(*t, 7, "k", 7, "d", 7, "i", "l", 7, 7) for t in texts]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {CLASHING}")


def empty(spark):
    return odd(spark).limit(0)
