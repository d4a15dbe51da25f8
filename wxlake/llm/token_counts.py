"""Exact length histogram of encoded documents."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wxlake.llm import bpe
from wxlake.llm.common import materialise, pin

#: Lengths in one block of the suffix sums.
BLOCK = 64


def token_lengths(docs: DataFrame, vocabulary: str = bpe.VOCABULARY, text: str = "text") -> DataFrame:
    """``n_tokens`` of each document, one row per row.

    Whole texts. A null text counts as empty, and an empty one has 0 tokens.
    """
    pin(docs.sparkSession)

    def lengths(batches):
        coder = bpe.encoder(vocabulary)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for part in bpe.in_portions(texts):
                found = [len(ids) // 4 for ids in coder.encode(texts[part])]
                yield pa.RecordBatch.from_pydict({"n_tokens": pa.array(found, pa.int64())})

    whole = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    return whole.mapInArrow(lengths, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """Documents by length: one row per distinct length."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame, block: int = BLOCK) -> DataFrame:
    """What a context limit of each occurring length keeps.

    One row per distinct length L: ``n_docs`` of that length, ``docs_up_to`` and
    ``docs_at_least`` L (quantiles), ``tokens_at_least`` (tokens of the documents
    that are at least L long), ``truncated_tokens`` (all tokens if every document
    is cut to L) and ``total_tokens``. Between two neighbouring lengths
    the truncated total is linear, see ``at_limits``. No documents: no rows.

    Sums run within blocks of lengths, then over the blocks, of which there are
    as many as the longest document has blocks, so no task holds all lengths.
    """
    # Written, as it is used twice: the texts are encoded once.
    rows = materialise(histogram, "length-histogram").select(
        "n_tokens", "n_docs",
        F.floor(F.col("n_tokens") / F.lit(block)).alias("block"),
        (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
    )
    later = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    inside = rows.select(
        "*", F.sum("n_docs").over(later).alias("docs_inside"), F.sum("tokens").over(later).alias("tokens_inside"),
    )
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("d").over(whole).alias("all_docs"), F.sum("t").over(whole).alias("all_tokens"),
    )
    at_least = F.col("docs_inside") + F.col("docs_above")
    tokens = F.col("tokens_inside") + F.col("tokens_above")
    return inside.join(blocks, "block").select(
        "n_tokens", "n_docs",
        (F.col("all_docs") - at_least + F.col("n_docs")).alias("docs_up_to"),
        at_least.alias("docs_at_least"),
        tokens.alias("tokens_at_least"),
        (F.col("all_tokens") - tokens + at_least * F.col("n_tokens")).alias("truncated_tokens"),
        F.col("all_tokens").alias("total_tokens"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """Truncated total and number of cut documents of each stated limit, from ``suffix_sums``.

    Limits that no document reaches keep everything.
    """
    each = F.explode(F.array(*[F.lit(x).cast("long") for x in limits])).alias("context")
    # The nearest length at or above the limit answers it; every length sends its figures to
    # the limits at or below it, and the smallest one wins.
    nearest = F.min(F.when(F.col("n_tokens") >= F.col("context"), F.struct(
        "n_tokens", "docs_at_least", "tokens_at_least")))
    over = F.sum(F.when(F.col("n_tokens") > F.col("context"), F.col("n_docs")))
    found = sums.select("*", each).groupBy("context").agg(
        nearest.alias("near"), over.alias("cut"), F.max("total_tokens").alias("total_tokens"))
    lost = F.col("near.tokens_at_least") - F.col("context") * F.col("near.docs_at_least")
    return found.select(
        "context", F.coalesce("cut", F.lit(0)).alias("docs_cut"),
        (F.col("total_tokens") - F.coalesce(lost, F.lit(0))).alias("truncated_tokens"), "total_tokens",
    )


def quantile_length(sums: DataFrame, share: float) -> DataFrame:
    """Smallest length that at least ``share`` of the documents do not exceed, as one row."""
    wanted = F.col("docs_up_to") >= F.lit(share) * (F.col("docs_up_to") + F.col("docs_at_least") - F.col("n_docs"))
    return sums.where(wanted).agg(F.min("n_tokens").alias("n_tokens"))
