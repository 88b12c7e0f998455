"""The pipeline against a plain version of every stage, and the driver contract."""

from __future__ import annotations

import hashlib
import random
import subprocess
import sys

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from cases import empty, odd
from pyspark.sql import functions as F
from test_decontaminate import distance, words
from test_jaccard import changed
from test_jaccard import plain as classes
from test_substrings import WORD, covered

from millrace.llm import bpe, decontaminate

LETTERS = "bcdfghjklmnpqrstvwxz"


def prose(seed, n, start="a"):
    """Made-up words of one letter's language."""
    pick = random.Random(seed)
    return " ".join(start + "".join(pick.choice(LETTERS) for _ in range(3)) + start for _ in range(n))


def documents():
    rows = []
    for i in range(60):
        rows.append((i, prose(i, 80 + i, "ae"[i % 2]), ("en", "fr")[i % 2]))
    rows += [(100 + i, rows[i][1], "en") for i in (0, 2, 4)]  # copies
    rows += [(200 + i, changed(rows[i][1], i, 1), None) for i in (6, 8, 10)]  # near copies
    passage = prose(999, 70)
    rows += [(300 + i, prose(300 + i, 40) + "\n" + passage + "\n" + prose(400 + i, 40), "en") for i in range(5)]
    item = prose(777, 30)
    rows += [(400, prose(41, 30) + " " + item + " " + prose(42, 30), "en"), (401, prose(43, 30) + " " + changed(item, 1, 3) + " x.", "en")]
    rows += [(500, "123 ... 456", "en"), (501, None, "en"), (502, "", None), (503, passage, "en")]
    return [(i, t, lang, "src", len(t or "")) for i, t, lang in rows], [(1, item), (2, prose(5, 20, "e"))]


def cut(text, flags):
    places = [m.start() for m in WORD.finditer(text)] + [len(text)]
    return text[: places[0]] + "".join(text[a:b] for a, b, f in zip(places, places[1:], flags) if not f)


def plain_pipeline(docs, bench):
    rows = [(i, t) for i, t, *_ in docs if t and any(c.isalpha() for c in t)]
    found = classes(rows)
    rows = [(i, t) for i, t in rows if found[i][0] == i]
    flags = covered(rows, 50)
    rows = [(i, cut(t, flags[i, t])) for i, t in rows if not all(flags[i, t])]
    items = [words(t) for _, t in bench]
    rows = [(i, t) for i, t in rows if not any(distance(w, words(t)) <= decontaminate.budget(len(w)) for w in items)]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken")) as f:
        ranks = bpe.parse_ranks(f.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for i, t in rows:
        ids = library.encode_ordinary(t)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        out.append((i, len(ids), digest, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_pipeline_equals_the_plain_stages(spark, tmp_path):
    docs, bench = documents()
    spark.createDataFrame(docs, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = plain_pipeline(docs, bench)
    assert sorted(tuple(r) for r in got.collect()) == want
    kept = {r[0] for r in want}
    assert set(range(60)) - {5} <= kept and not kept & {100, 102, 104, 206, 208, 210, 400, 401, 500, 501, 502, 503}


def test_stages_take_odd_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for df in (odd(spark), empty(spark)):
        docs = df.withColumn("n_chars", F.length("text").cast("long"))
        columns = docs.columns  # some have the names of columns that the stages use
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name != "tokens":
                assert out.columns == columns and out.schema == docs.schema, name
            docs = spark.createDataFrame(out.collect(), out.schema)
    assert docs.count() == 0


def test_contract():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(n.split("_")[0] for n in names) == sorted([*(f"op{i}" for i in range(1, 14)), "pipeline"])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "repeated_passages", "decontamination", "tokens"]


@pytest.mark.parametrize("gone", ["millrace.llm", "millrace.llm.queries", "corpus_pipeline"])
def test_the_rest_stands_without_this_package(gone):
    code = f"""
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == {gone!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert "page_ingestion" in e.queries() and "pipeline" not in e.queries() and "op3_bpe" not in e.queries()
assert set(e.oracle_sql()) <= set(e.queries())
"""
    root = corpus_pipeline.__file__.rsplit("/", 1)[0]
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-800:]
