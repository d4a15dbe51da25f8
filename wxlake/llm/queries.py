"""Registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from wxlake.llm import (
    article_text, jaccard, line_dedup, manifest, packing, pieces, quality, secret_scan, substrings, token_counts, top_k, url_filter,
    vector_codes,
)
from wxlake.llm.common import table
from wxlake.llm.manifest_sql import PROVE
from wxlake.llm.vector_codes_sql import CODES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, twin: str | None = None):
    def register(build):
        QUERIES[name] = build
        if twin is not None:
            ORACLES[name] = twin
        return build

    return register


@query("op1_token_counts")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    lengths = token_counts.token_lengths(table(spark, sf, "documents"))
    return token_counts.suffix_sums(token_counts.length_histogram(lengths))


URL_RULES = (
    url_filter.Rule("block", "net/"), url_filter.Rule("allow", "example.net/en/"),
    url_filter.Rule("block", "example.com/de/"), url_filter.Rule("allow", "org/fr/"),
)
#: Pages with less HTML are thin; their keys are the list.
THIN_CHARS = 1200


@query("op2_url_filter", f"""
with split as (
    select page_id, url, html,
           coalesce(translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
           coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') as path
    from pages),
thin as (select distinct host || path as k from split where host <> '' and length(html) < {THIN_CHARS}),
ruled as (
    select page_id, host, path,
           (host <> '' and host || path in (select k from thin)) as listed,
           case when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
                when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
                when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
                when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule
    from split)
select page_id, host, path, rule, listed,
       case when rule in ('example.net/en/', 'org/fr/') then 'allow' when rule is not null then 'block'
            when listed then 'block' else 'allow' end as verdict
from ruled""")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    thin = F.length("html") < THIN_CHARS
    return url_filter.judge(table(spark, sf, "pages"), URL_RULES, thin)


@query("op3_quality_rules", """
with words as (
    select doc_id, source, coalesce(text, '') as t,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l
    from documents),
places as (select doc_id, w, unnest(range(1, len(w) + 1)) as i from words),
windows as (select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as n
            from places where i + 2 <= len(w)),
covered as (select doc_id, count(distinct p) as n_repeat_words
            from (select doc_id, unnest([i, i + 1, i + 2]) as p from windows where n > 1) group by doc_id),
measured as (
    select words.doc_id, source, len(w)::bigint as n_words,
           coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
           len(l)::bigint as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
           coalesce(n_repeat_words, 0)::bigint as n_repeat_words
    from words left join covered using (doc_id)),
ruled as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
           100 * n_symbols > 10 * n_words as f1, 100 * n_dup_lines > 50 * n_lines as f2,
           word_chars < 2 * n_words or word_chars > 20 * n_words as f3
    from measured),
hosts as (select source, count(*) as n, [count(*) filter (f1), count(*) filter (f2), count(*) filter (f3)] as f
          from ruled group by source),
rates as (select source, n, r, f[r] as failed, floor(f[r] * 1000000 / n)::double as rate from hosts, (select unnest([1, 2, 3]) as r)),
moments as (select r, sum(rate) / count(*) / 1e6 as m, sum(rate * rate) / count(*) / 1e12 as s from rates group by r),
priors as (select r, m, least(greatest(m * (1 - m) / greatest(s - m * m, 1e-12) - 1, 1.0), 10000.0) as k from moments),
binds as (select source, r, (failed + m * k) / (n + k) > 0.02 as b from rates join priors using (r)),
verdicts as (select source, bool_or(b) filter (r = 1) as b1, bool_or(b) filter (r = 2) as b2, bool_or(b) filter (r = 3) as b3
             from binds group by source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not ((f1 and b1) or (f2 and b2) or (f3 and b3)) as kept
from ruled join verdicts on ruled.source is not distinct from verdicts.source""")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.judge(table(spark, sf, "documents"), carry=["doc_id"])
    return judged.select(
        "row.doc_id", "quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_dup_lines",
        "quality.n_repeat_words", "base_failed", "kept")


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


@query("op5_sentencepiece")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.encode_and_decode(table(spark, sf, "documents"))


@query("op6_substring_dedup")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    kept = substrings.without_repeats(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_secret_scan")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf, "documents"))


@query("op8_line_dedup", f"""
with docs as (select doc_id, source, text, case when text is not null then string_split(text, chr(10)) end as lines from documents),
pages as (select source, count(*) as pages from docs group by source),
found as (select source, line, count(*) as n
          from (select source, unnest(list_distinct(lines)) as line from docs) where line <> '' group by source, line),
common as (select found.source, list(line) as lines from found join pages on found.source is not distinct from pages.source
           where n >= {line_dedup.LEAST_PAGES} and n > {line_dedup.RATIO}::double * pages group by found.source),
kept as (select doc_id, text, docs.lines as own,
                list_filter(docs.lines, lambda x: not list_contains(coalesce(common.lines, []), x)) as k
         from docs left join common on docs.source is not distinct from common.source)
select doc_id, coalesce(len(own), 0)::bigint as n_lines, coalesce(len(own) - len(k), 0)::bigint as n_dropped,
       sha256(array_to_string(k, chr(10))) as kept_sha256
from kept""")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    marked = line_dedup.mark_lines(table(spark, sf, "documents").select("doc_id", "text", "source"))
    return marked.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op9_ngram_jaccard_join")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.join(table(spark, sf, "documents"))


@query("op10_exact_top_k", """
with usable as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
    where embedding is not null and vec_id is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
queries as (select vec_id as query_id, v as q from usable where vec_id % 50 = 0),
scored as (select query_id, vec_id, list_sum(list_transform(list_zip(q, v), lambda p: p[1] * p[2]))::bigint as score
           from queries join usable on query_id <> vec_id and len(q) = len(v)),
ranked as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5""")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return top_k.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op11_vector_codes", CODES)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf, "embeddings"))


@query("op12_merkle_manifest", PROVE)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.prove(table(spark, sf, "documents"), manifest.lower_case_tampering())


@query("op13_html_extraction")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return article_text.extract(table(spark, sf, "pages")).select("row.page_id", "row.url", F.col("article").alias("text"), F.length("article").cast("long").alias("n_chars"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
