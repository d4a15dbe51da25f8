"""Site-relative line frequency: boilerplate lines of a host are dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxlake.llm.common import pin, small_side

#: A line is boilerplate if over RATIO of its host's pages hold it, and at least LEAST_PAGES do. Boilerplate on about a tenth of
#: all pages is above or below a tenth by the chance of the host, so the ratio is half of that.
RATIO = 0.05
LEAST_PAGES = 5


def _digest(line):
    return F.unhex(F.md5(line))


def distinct_pages(docs: DataFrame, host: str = "source") -> DataFrame:
    """``host`` and ``lines``, the digests of the distinct lines, of each distinct text of a host.

    Copies collapse by the digest of the whole text, combined before the shuffle, so a text that many pages
    hold sends one row per task.
    """
    lines = F.filter(F.array_distinct(F.split("text", "\n", -1)), lambda line: line != "")
    return docs.select(F.col(host).alias("host"), _digest(F.col("text")).alias("page"), F.transform(lines, _digest).alias("lines")
                       ).dropDuplicates(["host", "page"]).select("host", "lines")


def boilerplate(docs: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES, host: str = "source", copies: bool = True) -> DataFrame:
    """``host`` and ``lines``, the array of 128-bit digests of its boilerplate lines; hosts without any are absent.

    Lines are cut at ``\\n`` and compared unchanged; empty ones never count. A page counts once
    for a line however often it holds it. A null host is a host of its own; null texts are pages without lines.

    With ``copies``, pages with equal texts count each: if over ``ratio`` of a host's pages are copies of one text, all
    its lines are boilerplate and all copies lose them. Without, a text counts once, in the lines' counts and in the
    host's pages, so copies of a whole text make no boilerplate; near copies, which are different texts, still do.

    Digests are counted, combined before the shuffle, so a line that every page
    holds sends one row per task. On average a page's lines over ``ratio`` bound a host's array, whatever the number of pages.
    """
    if copies:
        lines = docs.select(F.col(host).alias("host"), F.explode(
            F.array_distinct(F.split("text", "\n", -1))).alias("line")).where(F.col("line") != "")
        lines = lines.select("host", _digest(F.col("line")).alias("digest"))
        pages = docs.groupBy(F.col(host).alias("of")).agg(F.count(F.lit(1)).alias("pages"))
    else:
        texts = distinct_pages(docs, host)
        lines = texts.select("host", F.explode("lines").alias("digest"))
        pages = texts.groupBy(F.col("host").alias("of")).agg(F.count(F.lit(1)).alias("pages"))
    counts = lines.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("found"))
    common = counts.where(F.col("found") >= least_pages).join(pages, F.col("host").eqNullSafe(F.col("of")))
    common = common.where(F.col("found") > F.lit(ratio) * F.col("pages"))
    return common.groupBy("host").agg(F.sort_array(F.collect_list("digest")).alias("lines"))


def mark_lines(docs: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES, host: str = "source", copies: bool = True) -> DataFrame:
    """For each row: ``row``, a struct of its columns, ``n_lines``, ``n_dropped`` and ``kept``, the text left.

    A null text has no lines and stays null. All lines dropped: an empty text.
    """
    pin(docs.sparkSession)
    found = boilerplate(docs, ratio, least_pages, host, copies).select(F.col("host").alias("of"), F.col("lines").alias("common"))
    found = small_side(found, "boilerplate")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col(host).alias("host"), "text")
    rows = rows.join(found, F.col("host").eqNullSafe(F.col("of")), "left")
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda line: ~F.array_contains("common", _digest(line)))
    return rows.select(
        "row",
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("common").isNull() | F.col("text").isNull(), 0)
        .otherwise(F.size(lines) - F.size(kept)).cast("long").alias("n_dropped"),
        F.when(F.col("common").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept"),
    )


def drop_lines(docs: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES, host: str = "source", copies: bool = True) -> DataFrame:
    """``docs`` without boilerplate lines; ``n_chars``, where there is one, follows the text. No row is dropped."""
    fields = {c: F.col(f"row.{c}") for c in docs.columns} | {"text": F.col("kept")}
    if "n_chars" in fields:
        fields["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return mark_lines(docs, ratio, least_pages, host, copies).select(*[x.alias(c) for c, x in fields.items()])
