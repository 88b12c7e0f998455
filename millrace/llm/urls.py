"""URL filters: rules by host and path, and boosted trees on lexical features for the rest.

The trees are Spark's gradient-boosted trees.  Features of a URL are lengths, depth, shares of
digits, entropy, counts of parameters and marks, and how often labelled URLs with the same suffix
are blocked: of the host's last one, two and three names, of the last two with the first folder, and
of the file name's suffix.  These statistics are taken over all labelled URLs; those used in training
leave out the URL's own fold, so a suffix does not tell the label of the URL it was counted from.

Rules of reading: the host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
lower case; the path goes on to ``?``, ``#`` or the end.  A null URL, or one without ``://``, has an empty
host and path and fits no rule.  Repeated URLs count as often as they occur in the statistics and once in
the training sample.  Further columns pass, but for those named as a result, which are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.store import staged

ALLOW, BLOCK = "allow", "block"
#: Rules are a list within a plan; longer lists are refused.
MOST_RULES = 1000
#: Labelled URLs that the trees are fitted on, about, at most; chosen by hash.
SAMPLE = 100_000
FOLDS = 5
#: A suffix counts once it has so many labelled URLs, and is drawn to the common rate as by so many more.
LEAST_LABELLED = 2
PRIOR = 5.0
#: Partitions of the sample.
TRAINERS = 4
#: Trees, and levels of each.
TREES, DEPTH = 20, 4
#: Rows of the sample in each leaf.
LEAST_ROWS = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rules_of(lines: Sequence[str]) -> list[Rule]:
    """Rules from lines like ``block com/de/``."""
    out = []
    for line in lines:
        verdict, place = line.split()
        host, slash, path = place.partition("/")
        if verdict not in (ALLOW, BLOCK) or not host:
            raise ValueError(f"not a rule: {line}")
        out.append(Rule(verdict, host.lower(), slash + path))
    return out


def parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substr(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    return df.withColumns(
        {
            "host": F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER),
            "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
        }
    )


def ruled(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``rule`` and ``ruling`` from ``host`` and ``path``: the longest rule that fits, of equally long ones that of the longer host."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    found = F.lit(None).cast("struct<rule: string, ruling: string>")
    for rule in sorted(set(rules), key=lambda r: (len(r.name), len(r.host), r.name, r.verdict)):
        fits = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        fits &= F.col("path").startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("ruling"))).otherwise(found)
    return df.withColumn("_found", found).withColumns({"rule": F.col("_found.rule"), "ruling": F.col("_found.ruling")}).drop("_found")


# -- features --------------------------------------------------------------------------------


def _count(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("double")


def _entropy(text: Column) -> Column:
    """Bits per character."""
    chars = F.split(text, "")
    size = F.length(text).cast("double")
    share = F.transform(F.array_distinct(chars), lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / size)
    bits = F.aggregate(share, F.lit(0.0), lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return F.when(size > 0, bits).otherwise(0.0)


def lexical(url: str = "url") -> dict[str, Column]:
    """Features of the URL's text alone; it needs ``host`` and ``path``."""
    text, host, path = F.coalesce(F.col(url), F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    size = F.length(text).cast("double")
    return {
        "url_length": size,
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "query_length": F.length(query).cast("double"),
        "host_names": _count(host, r"\.") + 1,
        "depth": F.size(F.filter(F.split(path, "/"), lambda s: s != "")).cast("double"),
        "digit_ratio": F.when(size > 0, _count(text, "[0-9]") / size).otherwise(0.0),
        "host_digits": _count(host, "[0-9]"),
        "hyphens": _count(host, "-"),
        "entropy": _entropy(text),
        "host_entropy": _entropy(host),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda s: s != "")).cast("double"),
        "fragment": F.when(F.contains(text, F.lit("#")), 1.0).otherwise(0.0),
        "secure": F.when(text.startswith("https:"), 1.0).otherwise(0.0),
    }


def suffixes() -> dict[str, Column]:
    """The suffixes whose share of blocked URLs is a feature; it needs ``host`` and ``path``."""
    host, path = F.col("host"), F.col("path")
    domain = F.substring_index(host, ".", -2)
    return {
        "top": F.substring_index(host, ".", -1),
        "domain": domain,
        "site": F.substring_index(host, ".", -3),
        "folder": F.concat_ws("/", domain, F.get(F.split(path, "/"), F.lit(1))),
        "file": F.regexp_extract(path, r"\.[A-Za-z0-9]+$", 0),
    }


def _keyed(df: DataFrame, url: str) -> DataFrame:
    """Add the lexical features as ``_features`` and the suffixes."""
    names = suffixes()
    return df.withColumns({"_features": F.array(*lexical(url).values()), **{f"_{k}": F.coalesce(c, F.lit("")) for k, c in names.items()}})


@dataclass
class Filter:
    """Blocked shares by suffix, and the trees; ``trees`` is None where the labels say nothing."""

    shares: dict[str, DataFrame]
    rate: float
    trees: object


def _share(blocked: Column, labelled: Column, rate: float) -> Column:
    """The smoothed share; the common one where too few are labelled."""
    few = F.coalesce(labelled, F.lit(0)) < LEAST_LABELLED
    return F.when(few, F.lit(rate)).otherwise((blocked + PRIOR * rate) / (labelled + PRIOR))


def learn(labelled: DataFrame, url: str = "url", label: str = "label", sample: int = SAMPLE) -> Filter:
    """A filter from URLs with label 1 (block) or 0; rows without either are left out.

    The suffix statistics count all of them; the trees are fitted on about ``sample`` different URLs.
    """
    rows = parts(labelled.select(labelled[url].alias("url"), labelled[label].cast("double").alias("label")))
    rows = rows.filter(F.col("url").isNotNull() & F.col("label").isNotNull())
    rows = rows.withColumn("_fold", F.pmod(F.xxhash64("url"), F.lit(FOLDS)))
    # One row for each URL; copies are counted before they are moved.
    rows = staged(rows.groupBy("url", "host", "path", "_fold").agg(F.sum("label").alias("blocked"), F.count("*").alias("n")), "labelled-urls")
    total = rows.agg(F.sum("blocked").alias("blocked"), F.sum("n").alias("n"), F.count("*").alias("urls")).first()
    if not total.n:
        return Filter({}, 0.0, None)
    rate = total.blocked / total.n
    if rate in (0.0, 1.0):
        return Filter({}, rate, None)
    chosen = F.pmod(F.xxhash64("url", F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample / total.urls))
    train = _keyed(rows.filter(chosen), "url").withColumn("label", (F.col("blocked") * 2 > F.col("n")).cast("double"))
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.coalesce(c, F.lit("")).alias("suffix")) for k, c in suffixes().items()]))
    by_fold = rows.select("_fold", "blocked", "n", kinds.alias("of")).groupBy("of.kind", "of.suffix", "_fold")
    folds = F.map_from_entries(F.collect_list(F.struct("_fold", F.struct("blocked", "n"))))  # FOLDS entries
    counted = (
        by_fold.agg(F.sum("blocked").alias("blocked"), F.sum("n").alias("n"))
        .groupBy("kind", "suffix")
        .agg(folds.alias("folds"), F.sum("blocked").alias("b"), F.sum("n").alias("n"))
        .filter(F.col("n") >= LEAST_LABELLED)
    )
    counted = staged(counted, "suffixes", "kind")
    shares = {}
    for name in suffixes():
        mine = counted.filter(F.col("kind") == name).withColumnRenamed("suffix", f"_{name}")
        shares[name] = mine.select(f"_{name}", _share(F.col("b"), F.col("n"), rate).alias(f"_{name}_share"))
        own = F.col("folds")[F.col("_fold")]
        others = _share(F.col("b") - F.coalesce(own["blocked"], F.lit(0.0)), F.col("_n") - F.coalesce(own["n"], F.lit(0)), rate)
        mine = mine.select(f"_{name}", "folds", "b", F.col("n").alias("_n"))
        train = train.join(mine, f"_{name}", "left").withColumn(f"_{name}_share", others).drop("folds", "b", "_n")
    sampled = staged(_vectors(train).select("url", "vector", "label"), "url-sample")
    if sampled.select("label").distinct().count() < 2:
        return Filter({}, rate, None)
    # A few sorted partitions: the trees take a job for each level, and the order of their sums is fixed.
    sampled = sampled.repartitionByRange(TRAINERS, "url").sortWithinPartitions("url")
    trees = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, minInstancesPerNode=LEAST_ROWS, seed=1).fit(sampled)
    return Filter(shares, rate, trees)


def _vectors(df: DataFrame) -> DataFrame:
    """``vector``, of the lexical features and the suffixes' shares."""
    shares = F.array(*[f"_{n}_share" for n in suffixes()])
    return df.withColumn("vector", array_to_vector(F.concat("_features", shares)))


def score(df: DataFrame, model: Filter, url: str = "url") -> DataFrame:
    """Add ``p_block``, the probability that a URL is to be blocked; ``df`` has ``host`` and ``path`` by ``parts``.

    Without labels it is 0, with labels of one kind that kind's.
    """
    if model.trees is None:
        return df.withColumn("p_block", F.lit(float(model.rate)))
    out = _keyed(df, url)
    for name, share in model.shares.items():
        out = out.join(share, f"_{name}", "left")
        out = out.withColumn(f"_{name}_share", F.coalesce(f"_{name}_share", F.lit(model.rate)))
    out = _vectors(out)
    kept = [c for c in df.columns if c != "p_block"]
    trees = model.trees.setPredictionCol("_kind").setRawPredictionCol("_raw").setProbabilityCol("_odds")
    return trees.transform(out).select(*kept, vector_to_array("_odds")[1].alias("p_block"))


def judge(df: DataFrame, rules: Sequence[Rule], url: str = "url", sample: int = SAMPLE) -> DataFrame:
    """Add ``host, path, rule, verdict, p_block``: the rule's verdict where one fits, else that of trees taught by the URLs that rules decide."""
    read = ruled(parts(df, url), rules)
    taught = read.filter("ruling is not null").select(F.col(url).alias("url"), (F.col("ruling") == BLOCK).cast("double").alias("label"))
    model = learn(taught, sample=sample)
    by_trees = F.when(F.col("p_block") > 0.5, BLOCK).otherwise(ALLOW)
    return score(read, model, url).withColumn("verdict", F.coalesce("ruling", by_trees)).drop("ruling")
