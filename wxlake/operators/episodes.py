"""Runs of consecutive days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxlake.functions.numbers import stable_round
from wxlake.spec import RUN_TYPES, RunType


def islands(
    flagged: DataFrame, keys: Sequence[str], day: str, aggregates: Sequence[Column],
    carry: Sequence[str] = (),
) -> DataFrame:
    """Group consecutive days of each key into runs.

    Expects the days that count, one row per key and day. Consecutive days share
    the difference between day number and position. A repeated day does not split
    a run. A group holds at most one row per calendar day of one key.
    """
    window = Window.partitionBy(*keys).orderBy(day)
    label = F.unix_date(F.col(day)) - F.dense_rank().over(window)
    runs = flagged.withColumn("_run", label).groupBy(*keys, *carry, "_run").agg(
        F.min(day).alias("start_date"), F.max(day).alias("end_date"), *aggregates
    )
    length = F.date_diff("end_date", "start_date") + 1
    return runs.withColumn("n_days", length.cast("bigint")).drop("_run")


def meets(run: RunType) -> Column:
    """Whether a day satisfies the condition of a run type; NULL if unknown."""
    measure = F.col(run.measure)
    return measure <= run.threshold if run.op == "<=" else measure >= run.threshold


def flag_days(daily: DataFrame, runs: Sequence[RunType] = RUN_TYPES) -> DataFrame:
    """One row per day and run type whose condition holds, with the measure."""
    candidates = F.array(*[
        F.when(meets(r), F.struct(F.lit(r.name).alias("type"), F.col(r.measure).alias("value")))
        for r in runs
    ])
    held = F.filter(candidates, lambda c: c.isNotNull())
    return daily.select("dept", "city", "obs_date", F.inline(held))


def detect_runs(daily: DataFrame, runs: Sequence[RunType] = RUN_TYPES) -> DataFrame:
    """All run types in one pass: one exchange on (area, type)."""
    found = islands(
        flag_days(daily, runs), ["dept", "type"], "obs_date",
        [F.min("value").alias("_min"), F.sum("value").alias("_sum"), F.max("value").alias("_max")],
        carry=["city"],
    )
    intensity = shortest = None
    for r in runs:
        is_type = F.col("type") == r.name
        pick = F.col(f"_{r.intensity}")
        intensity = (F.when if intensity is None else intensity.when)(is_type, pick)
        shortest = (F.when if shortest is None else shortest.when)(is_type, F.lit(r.min_days))
    return found.filter(F.col("n_days") >= shortest).select(
        "dept", "city", "type", "start_date", "end_date", "n_days",
        stable_round(intensity, 1).alias("intensity"),
    )


def runs_by_type(episodes: DataFrame) -> DataFrame:
    return episodes.groupBy("type").agg(F.count("*").alias("n_runs"))


def latest_runs(episodes: DataFrame, n: int = 30) -> DataFrame:
    """The n runs that ended last, in a fixed order."""
    return episodes.orderBy(F.desc("end_date"), "dept", "type", "start_date").limit(n)


def longest_runs(episodes: DataFrame, kind: str, n: int = 8) -> DataFrame:
    of_kind = episodes.filter(F.col("type") == kind)
    return of_kind.orderBy(F.desc("n_days"), "dept", "start_date").limit(n)
