"""Quality rules by host: failure rates shrunk to a beta prior decide how strictly a host's documents are judged."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxlake.llm.common import materialise, pin, small_side

#: Documents with fewer words, or a larger share of repeated ones, fail whatever their host.
LEAST_WORDS = 50
REPEAT_PERCENT = 50
#: Soft rules, in percent: symbols to words; repeated lines to words' lines is bounded by lines; mean characters of a word.
SYMBOL_PERCENT = 10
DUP_LINE_PERCENT = 50
WORD_CHARS = (2, 20)
#: A rule binds on hosts whose shrunk failure rate is above this.
HOST_LIMIT = 0.02
#: Bounds of the prior's strength, in documents.
PRIOR_STRENGTH = (1.0, 10_000.0)

SYMBOLS = b"#*$%&|<>"
FEATURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
RULES = ("symbols", "dup_lines", "word_chars")


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more in the text, the first included."""
    seen = Counter(zip(words, words[1:], words[2:]))
    if len(seen) == max(0, len(words) - 2):
        return 0
    covered, end = 0, 0
    for i, window in enumerate(zip(words, words[1:], words[2:])):
        if seen[window] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def features_of(text: str) -> tuple[int, int, int, int, int, int]:
    raw = text.encode()
    words = raw.split()
    spaces = len(raw) - sum(map(len, words))
    lines = [line for line in raw.split(b"\n") if line.split(None, 1)]
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return len(words), len(text) - spaces, symbols, len(lines), len(lines) - len(set(lines)), repeated_words(words)


def with_features(docs: DataFrame, carry: list[str] | None = None, host: str = "source", text: str = "text") -> DataFrame:
    """``row``, a struct of the columns to carry (all), ``host`` and ``quality``, the struct FEATURES.

    Null texts are empty and have zeros.

    Words are runs of characters other than space and U+0009 to U+000D. Lines are cut at ``\\n``
    and those without a word don't count.
    """
    pin(docs.sparkSession)
    names = [x.split()[0] for x in FEATURES.split(", ")]

    @F.arrow_udf(f"struct<{FEATURES.replace(' ', ':').replace(',:', ',')}>")
    def features(texts: pa.Array) -> pa.Array:
        rows = [features_of(x) for x in texts.to_pylist()]
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return docs.select(
        F.struct(*[docs[c] for c in carry or docs.columns]).alias("row"), F.col(host).alias("host"),
        features(F.coalesce(F.col(text), F.lit(""))).alias("quality"))


def rule_columns() -> dict:
    """Soft rules: true where a document fails. Empty documents fail none of them."""
    q = F.col
    return {
        "symbols": q("quality.n_symbols") * 100 > q("quality.n_words") * SYMBOL_PERCENT,
        "dup_lines": q("quality.n_dup_lines") * 100 > q("quality.n_lines") * DUP_LINE_PERCENT,
        "word_chars": (q("quality.word_chars") < q("quality.n_words") * WORD_CHARS[0])
        | (q("quality.word_chars") > q("quality.n_words") * WORD_CHARS[1]),
    }


def base_failed():
    q = F.col
    return (q("quality.n_words") < LEAST_WORDS) | (
        q("quality.n_repeat_words") * 100 > q("quality.n_words") * REPEAT_PERCENT)


def host_verdicts(measured: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """``host``, ``n_docs`` and for each soft rule ``rate_<rule>``, shrunk, and ``binds_<rule>``.

    The prior is fitted by moments over the hosts' rates, weighing hosts alike: mean m and variance v give
    the strength m (1 - m) / v - 1, held in PRIOR_STRENGTH; the shrunk rate is
    (failures + m * strength) / (documents + strength). A null host is a host. One row per host; the prior is a scalar subquery.
    """
    counts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.count_if(failed).alias(f"failed_{rule}") for rule, failed in rule_columns().items()])
    # In whole millionths, so that the order of summing cannot matter.
    rate = {r: F.floor(F.col(f"failed_{r}") * 1_000_000 / F.col("n_docs")).cast("double") for r in RULES}
    prior = counts.agg(
        F.count(F.lit(1)).cast("double").alias("hosts"),
        *[F.sum(rate[r]).alias(f"s_{r}") for r in RULES], *[F.sum(rate[r] * rate[r]).alias(f"ss_{r}") for r in RULES])
    low, high = PRIOR_STRENGTH
    out = counts.withColumn("prior", prior.select(F.struct("*")).scalar())
    for r in RULES:
        mean = F.col(f"prior.s_{r}") / F.col("prior.hosts") / 1e6
        variance = F.greatest(F.col(f"prior.ss_{r}") / F.col("prior.hosts") / 1e12 - mean * mean, F.lit(1e-12))
        strength = F.least(F.greatest(mean * (1 - mean) / variance - 1, F.lit(low)), F.lit(high))
        shrunk = (F.col(f"failed_{r}") + mean * strength) / (F.col("n_docs") + strength)
        out = out.withColumn(f"rate_{r}", shrunk).withColumn(f"binds_{r}", F.col(f"rate_{r}") > limit)
    return out.select("host", "n_docs", *[f"rate_{r}" for r in RULES], *[f"binds_{r}" for r in RULES])


def judge(docs: DataFrame, limit: float = HOST_LIMIT, carry: list[str] | None = None, host: str = "source", text: str = "text") -> DataFrame:
    """For each row: ``row``, a struct of the columns to carry (all), ``quality``, ``base_failed`` and ``kept``.

    A document is rejected if it fails a base rule, or a soft rule that binds on its host. One
    that fails no rule is always kept. No documents: no rows.

    Features are written once, and read for the hosts' counts and for the join back; hosts
    are combined before the shuffle and joined as a broadcast of checked size, else by an equi-join that
    adaptive execution splits at hot hosts.
    """
    measured = materialise(with_features(docs, carry, host, text), "quality")
    verdicts = small_side(host_verdicts(measured, limit).withColumnRenamed("host", "of"), "hosts")
    joined = measured.join(verdicts, measured.host.eqNullSafe(F.col("of")), "left")
    soft = F.lit(False)
    for rule, failed in rule_columns().items():
        soft = soft | (failed & F.col(f"binds_{rule}"))
    return joined.select("row", "quality", base_failed().alias("base_failed"), (~base_failed() & ~soft).alias("kept"))


def keep_good(docs: DataFrame, limit: float = HOST_LIMIT, host: str = "source", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps."""
    return judge(docs, limit, None, host, text).where("kept").select("row.*")
