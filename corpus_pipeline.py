"""A training corpus from raw documents: stages in order, each on all that the one before kept.

1. quality rules: documents that the rules reject go;
2. line dedup: boilerplate lines of a host go from the texts;
3. n-gram Jaccard join: of each group of near copies one document stays;
4. secret scans: secrets in the texts are replaced;
5. best-fit packing: the texts become sequences of tokens.

All stages but the last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wxlake.llm import jaccard, line_dedup, packing, quality, secret_scan
from wxlake.llm.common import materialise, table


#: Documents are near copies if their sets of runs of so many words are that similar.
NEAR_WORDS, NEAR_PERCENT = 5, 80
#: A line is boilerplate above this share of its host's pages. Boilerplate on about a tenth of all pages is above
#: or below a tenth by the chance of the host, so the share is half of that; one page in twenty is the general rule.
BOILERPLATE_RATIO = 0.05


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(docs, BOILERPLATE_RATIO, copies=False)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, NEAR_WORDS, NEAR_PERCENT)


def secrets_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", boilerplate_lines),
    ("ngram_jaccard_join", near_copies),
    ("secret_scans", secrets_out),
    ("best_fit_packing", packed),
]

#: Tokens and a trained model are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again. Returns the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
