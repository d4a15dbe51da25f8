"""Newest row per key and duplicate checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str], tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """Keep the row with the highest ``newest`` columns for each key.

    Equal rows are ordered by ``tiebreak``, by default all other columns by name,
    so the kept row never depends on the order of the input. Project first:
    whatever the rows still hold is read, sorted and shuffled, each column once.

    ``row_number() = 1`` is planned as a group limit on both sides of the
    exchange: every input task sends at most one row per key, whatever share of
    the rows the key has.
    """
    ties = sorted(set(df.columns) - set(keys) - set(newest)) if tiebreak is None else tiebreak
    order = [F.col(f"`{c}`").desc_nulls_last() for c in (*newest, *ties)]
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: the number of keys that occur more than once."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    return counted.agg(F.count("*").alias("n_duplicate_keys"))
