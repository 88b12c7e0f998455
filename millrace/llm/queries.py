"""The registered queries of this package, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    alignment, audit, bpe, decontaminate, fixity, jaccard, language, licenses, quality, sharding, substrings, toxicity, urls,
)
from millrace.llm.store import staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_register
def op3_bpe(spark, folder):
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_digests(bpe.decode(bpe.encode(docs, vocabulary, public_tokenizers.PATTERN), vocabulary))


def token_digests(df: DataFrame) -> DataFrame:
    """``ids`` and ``decoded`` as counts and digests."""
    return df.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_register
def op9_sharding(spark, folder):
    placed = sharding.shard_by_bytes(table(spark, folder, "documents"), 8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_register
def op4_language(spark, folder):
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    docs = table(spark, folder, "documents").withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    model = language.learn(docs.filter(~F.col("held_out")))
    found = language.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "language.lang_pred", "language.score", F.size("language.spans").alias("n_spans"))


@_register
def op8_quality(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    measured = staged(quality.measures(docs), "measures")
    cutoffs = quality.joint_thresholds(measured, table(spark, folder, "labels"), ["lang"])
    judged = quality.verdicts(measured, cutoffs, ["lang"])
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.size("rejected_by") == 0)).alias("kept"),
        "rejected_by",
    )


@_register
def op1_toxicity(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(
        F.max(1 - F.col("quality")).alias("junk"), F.max("toxic").alias("toxic")
    )
    chain = toxicity.learn(docs.join(labels, "doc_id"), ["junk", "toxic"])
    return toxicity.score(docs, chain).withColumn("is_toxic", F.col("p_toxic") >= 0.5)


@_register
def op6_licenses(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.learn(docs))


@_register
def op5_decontamination(spark, folder):
    return decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def damaged(pages: DataFrame) -> DataFrame:
    """A replica of ``pages`` with a byte changed, the end cut off or the record lost here and there."""
    at = F.col("page_id")
    html = (
        F.when(at % 97 == 13, F.concat(F.lit("?"), F.substr("html", F.lit(2))))
        .when(at % 89 == 7, F.substr("html", F.lit(1), F.length("html") - 5))
        .otherwise(F.col("html"))
    )
    return pages.filter("page_id % 83 <> 5").withColumn("html", html)


@_register
def op7_fixity(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return fixity.audit(pages, damaged(pages))


ORACLES["op7_fixity"] = """
with page as (
  select page_id, url, html, false as replica from pages
  union all
  select page_id, url, case when page_id % 97 = 13 then '?' || substr(html, 2)
                            when page_id % 89 = 7 then substr(html, 1, length(html) - 5) else html end, true
  from pages where page_id % 83 <> 5
), record as (
  select page_id, replica, page_id // 1000 as archive,
    'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
    || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(html)
    || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) as body
  from page
), leaf as (
  select page_id, replica, archive, sha256(body) as digest,
    cast(coalesce(sum(strlen(body)) over (partition by replica, archive order by page_id
      rows between unbounded preceding and 1 preceding), 0) as bigint) as at
  from record
)
select a.archive, a.page_id, cast(1 as integer) as nth,
  case when b.page_id is null then 'missing' when a.digest <> b.digest then 'corrupt' else 'moved' end as verdict,
  a.at as "offset", b.at as replica_offset, a.digest, b.digest as replica_digest
from (from leaf where not replica) a left join (from leaf where replica) b using (page_id)
where b.page_id is null or a.digest <> b.digest or a.at <> b.at
"""


@_register
def op2_jaccard(spark, folder):
    return jaccard.similar(table(spark, folder, "documents"))


@_register
def op10_substrings(spark, folder):
    return substrings.kept_words(table(spark, folder, "documents"))


ORACLES["op2_jaccard"] = r"""
with recursive doc as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), gram as (
  select distinct doc_id, unnest(case when len(words) between 1 and 4 then [array_to_string(words, ' ')]
    else [array_to_string(words[i:i + 4], ' ') for i in range(1, len(words) - 3)] end) as gram
  from doc
), size as (
  select doc_id, count(*) as n from gram group by doc_id
), shared as (
  select a.doc_id as one, b.doc_id as other, count(*) as common
  from gram a join gram b on a.gram = b.gram and a.doc_id <> b.doc_id group by all
), link as (
  select one, other, common = s.n and common = t.n as same
  from shared join size s on s.doc_id = one join size t on t.doc_id = other
  where common >= 0.8 * (s.n + t.n - common) - 1e-9
), reach(doc_id, root) as (
  select doc_id, doc_id from documents
  union
  select link.other, reach.root from reach join link on link.one = reach.doc_id where reach.root < link.other
), class as (
  select doc_id, min(root) as class_id from reach group by doc_id
), links as (
  select one as doc_id, count(*) as n_links, min(case when same then other end) as copy from link group by one
)
select class.doc_id, class_id, least(class.doc_id, coalesce(copy, class.doc_id)) as copy_id, coalesce(n_links, 0) as n_links
from class left join links on links.doc_id = class.doc_id
"""

ORACLES["op10_substrings"] = r"""
with doc as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), windows as (
  select doc_id, unnest(words) as word, generate_subscripts(words, 1) as pos,
    unnest(list_transform(range(1, len(words) + 1), lambda i: case when i + 49 <= len(words)
      then md5(array_to_string(words[i:i + 49], ' ')) end)) as window_hash
  from doc
), least as (
  select window_hash, min(doc_id) as first_doc from windows where window_hash is not null group by window_hash
), covered as (
  select w.doc_id, w.word, w.pos,
    coalesce(bool_or(l.first_doc < w.doc_id) over (partition by w.doc_id order by w.pos rows between 49 preceding and current row), false) as gone
  from windows w left join least l using (window_hash)
), kept as (
  select doc_id, count(*) as n_words, count(*) filter (where gone) as n_removed,
    coalesce(string_agg(word, ' ' order by pos) filter (where not gone), '') as kept
  from covered group by doc_id
)
select doc.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from doc left join kept on kept.doc_id = doc.doc_id
"""


#: Rules of the query on pages (fixed values).
URL_RULES = ["allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/"]


@_register
def op11_urls(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = urls.judge(pages, urls.rules_of(URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict", "p_block")


@_register
def op12_alignment(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    files = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    aligned = staged(alignment.align(docs, *files, digest=True), "aligned")
    return alignment.scored(aligned, staged(alignment.frequencies(aligned), "pair-counts"))


@_register
def op13_filters(spark, folder):
    counts = audit.masks(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return audit.interactions(counts, "ABCDE")


ORACLES["op13_filters"] = r"""
with doc as (
  select doc_id, coalesce(text, '') as body, coalesce(lang, '') as part,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words
  from documents
), label as (
  select doc_id, max(cast(quality = 1 as int)) as good, max(cast(toxic = 1 as int)) as toxic from labels group by doc_id
), failing as (
  select doc.doc_id, part, coalesce(good, 0) as good, coalesce(label.toxic, 0) as toxic,
    map {
      'A': len(words) < 200,
      'B': 100 * len(list_distinct(words)) < 50 * len(words),
      'C': 100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 3 * length(body),
      'D': regexp_matches(body, '[#$%&*|]'),
      'E': coalesce(doc.doc_id > min(doc.doc_id) over (partition by body), false)
    } as fails
  from doc left join label on label.doc_id = doc.doc_id
), letter(f) as (values ('A'), ('B'), ('C'), ('D'), ('E')
), orders as (
  select a.f || b.f || c.f || d.f || e.f as filter_order
  from letter a, letter b, letter c, letter d, letter e
  where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), place as (
  select filter_order, cast(step as int) as step, filter_order[step] as f, filter_order[:step - 1] as earlier
  from orders, range(1, 6) as r(step)
), kind as (
  select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from failing group by all
), at_step as (
  select part, filter_order, step, f, n, good, toxic, fails[f] as failing,
    len(list_filter(string_split(earlier, ''), lambda l: l <> '' and fails[l])) > 0 as gone,
    len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda l: fails[l])) as n_fails
  from kind, place
), summed as (
  select part, filter_order, step, f,
    sum(case when not gone and not failing then n else 0 end) as kept,
    sum(case when not gone and failing then n else 0 end) as removed,
    sum(case when gone and failing then n else 0 end) as redundant,
    sum(case when failing and n_fails = 1 then n else 0 end) as unique_fails,
    sum(case when not gone and failing then good else 0 end) as good_lost,
    sum(case when not gone and failing then toxic else 0 end) as toxic_lost
  from at_step group by all
)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
  cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, f) as bigint) as shapley
from summed
"""
