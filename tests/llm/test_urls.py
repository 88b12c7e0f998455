from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import urls

RULES = urls.rules_of(["allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/"])
URLS = [
    "https://a.example.org/es/1", "http://example.org/en/12", "https://xexample.org/es/", "HTTP://A.B.COM/de/x?q=/fr/", "https://a.com/fr/#x",
    "https://a.com", "https://org/x", "https://a.org?x=/", "https://a.org#/", "no scheme/here", "", None, "://", "https://Ä.org/é",
    "https://a.com/de/\n2", "mailto://x@y.com:80/de/", "https://a://b.org/c", "https://" + "a." * 3000 + "org/" + "x" * 20_000,
    "https://a.example.org/es/1",
]


def plain(url):
    """Host, path, rule and ruling by the contract."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


def table(spark):
    rows = [(i, u, "h", 1.0) for i, u in enumerate(URLS)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, p_block double")


def test_hosts_paths_and_rules(spark):
    for r in urls.ruled(urls.parts(table(spark)), RULES).collect():
        assert (r.host, r.path, r.rule, r.ruling) == plain(r.url), r.url


def test_the_rule_decides_where_one_fits(spark):
    rows = urls.judge(table(spark), RULES).collect()
    assert sorted(r.page_id for r in rows) == list(range(len(URLS)))
    for r in rows:
        host, path, rule, ruling = plain(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == ruling if ruling else r.verdict == ("block" if r.p_block > 0.5 else "allow")
        assert 0 <= r.p_block <= 1


def test_features_of_the_text(spark):
    text = "https://ab.example.com/x/1?a=1&b=2#t"
    df = urls.parts(spark.createDataFrame([(text,), (None,)], "url string"))
    rows = [r.asDict() for r in df.select(*[c.alias(k) for k, c in urls.lexical().items()]).collect()]
    share = [text.count(c) / len(text) for c in set(text)]
    assert rows[0]["entropy"] == pytest.approx(-sum(p * math.log2(p) for p in share))
    del rows[0]["entropy"], rows[0]["host_entropy"]
    assert rows[0] == {
        "url_length": len(text), "host_length": 14, "path_length": 4, "query_length": 7, "host_names": 3, "depth": 2, "digit_ratio": 3 / len(text),
        "host_digits": 0, "hyphens": 0, "parameters": 2, "fragment": 1, "secure": 1,
    }
    assert rows[1]["entropy"] == rows[1]["url_length"] == rows[1]["depth"] == 0


def made(spark, begin, end):
    """URLs of spam and other sites: the sites of one kind share endings, lengths and digits."""
    i = F.col("id")
    spam = i % 3 == 0
    good = F.concat(F.lit("https://site"), (i % 17).cast("string"), F.lit(".example.net/news/"), F.element_at(F.split(F.lit("a,b,c"), ","), (i % 3 + 1).cast("int")))
    bad = F.concat(F.lit("http://w"), i.cast("string"), F.lit(".cheap.example.biz/"), i.cast("string"), F.lit("/x.php?id="), i.cast("string"))
    return spark.range(begin, end).select(F.when(spam, bad).otherwise(good).alias("url"), spam.cast("int").alias("label"))


def test_held_out_urls_are_told_apart(spark):
    model = urls.learn(made(spark, 0, 600))
    found = urls.score(urls.parts(made(spark, 1000, 1400)), model).selectExpr("label", "p_block > 0.5 as blocked").collect()
    assert sum(r.label == r.blocked for r in found) >= 0.98 * len(found) > 0


def test_shares_leave_out_the_own_fold(spark):
    """A suffix whose only URLs are of one fold has the common rate in training, so its label does not leak."""
    rows = [(f"https://only{i}.example.biz/a", i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "url string, label int")
    model = urls.learn(df)
    found = urls.score(urls.parts(df), model).agg(F.avg(((F.col("p_block") > 0.5).cast("int") == F.col("label")).cast("double"))).first()[0]
    assert found < 0.8  # nothing in these URLs tells the label


def test_few_or_no_labels(spark):
    df = urls.parts(table(spark))
    none = spark.createDataFrame([], "url string, label int")
    one = spark.createDataFrame([("https://a.b/c", 1), (None, 0), ("https://a.b/d", None)], "url string, label int")
    assert {r.p_block for r in urls.score(df, urls.learn(none)).collect()} == {0.0}
    assert {r.p_block for r in urls.score(df, urls.learn(one)).collect()} == {1.0}
    assert urls.judge(table(spark).limit(0), RULES).count() == 0
    both = spark.createDataFrame([("https://a.b/c", 1), ("https://a.b/c", 0), ("https://a.b/d", 0)], "url string, label int")
    assert urls.score(df, urls.learn(both)).count() == len(URLS)


def test_bad_rules_are_refused(spark):
    for line in ("deny a.b/", "allow /x"):
        with pytest.raises(ValueError):
            urls.rules_of([line])
    with pytest.raises(ValueError):
        urls.ruled(urls.parts(table(spark)), [urls.Rule("allow", f"h{i}", "/") for i in range(urls.MOST_RULES + 1)])
