"""Detected runs checked against official alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxlake.dimensions import ALERT_COLORS
from wxlake.functions.numbers import lookup, stable_round
from wxlake.operators.clean import unify_areas
from wxlake.spec import ALERT_ARCHIVE_START, CONFIRMED_RATE, RUN_TYPES, RunType

RUN_KEY = ("dept", "city", "type", "start_date", "end_date", "n_days", "intensity")


def max_alert_per_day(alerts: DataFrame) -> DataFrame:
    """Highest color per day, area and phenomenon, areas named as in the runs."""
    return unify_areas(alerts).groupBy(
        F.col("vig_date").alias("day"), "dept", "phenomenon_id"
    ).agg(F.max("color_id").alias("color_id"))


def evaluable_days(alerts: DataFrame) -> DataFrame:
    """Days for which an alert map exists."""
    return alerts.select(F.col("vig_date").alias("day")).distinct().withColumn(
        "evaluable", F.lit(1)
    )


def run_days(episodes: DataFrame, runs: Sequence[RunType] = RUN_TYPES) -> DataFrame:
    """One row per day of each run, with the alert phenomenon it may match."""
    phenomena = {r.name: r.phenomenon_id for r in runs}
    return episodes.select(
        *RUN_KEY,
        lookup(phenomena, F.col("type")).alias("phenomenon_id"),
        F.explode(F.sequence("start_date", "end_date")).alias("day"),
    )


def join_alerts(days: DataFrame, alerts: DataFrame) -> DataFrame:
    return days.join(max_alert_per_day(alerts), ["day", "dept", "phenomenon_id"], "left")


def join_evaluable(days: DataFrame, alerts: DataFrame) -> DataFrame:
    return days.join(evaluable_days(alerts), "day", "left")


def coverage(days: DataFrame, min_color: int = 2) -> DataFrame:
    """Covered days, highest color and evaluable days of each run.

    The columns of the run are the grouping key, so no join back is needed.
    """
    return days.groupBy(*RUN_KEY).agg(
        F.count(F.when(F.col("color_id") >= min_color, 1)).alias("alert_days"),
        F.max("color_id").alias("max_color_id"),
        F.count("evaluable").alias("evaluable_days"),
    )


def episode_status(
    end: Column, evaluable: Column, rate: Column, archive_start: str = ALERT_ARCHIVE_START
) -> Column:
    """Out of the archive, then not evaluated, then by the covered share."""
    return (
        F.when(end < F.to_date(F.lit(archive_start)), "out_of_archive")
        .when(evaluable == 0, "not_evaluated")
        .when(rate >= CONFIRMED_RATE, "confirmed")
        .otherwise("not_confirmed")
    )


def coverage_rate(alert_days: Column, n_days: Column) -> Column:
    return stable_round(F.try_divide(F.coalesce(alert_days, F.lit(0)), n_days), 2)


def check_runs(
    episodes: DataFrame, alerts: DataFrame, archive_start: str = ALERT_ARCHIVE_START,
    runs: Sequence[RunType] = RUN_TYPES, min_color: int = 2,
) -> DataFrame:
    """Each run with its alert coverage and status."""
    days = join_evaluable(join_alerts(run_days(episodes, runs), alerts), alerts)
    rated = coverage(days, min_color).withColumn(
        "coverage_rate", coverage_rate(F.col("alert_days"), F.col("n_days"))
    )
    return rated.select(
        *RUN_KEY, "alert_days", "coverage_rate",
        lookup(ALERT_COLORS, F.col("max_color_id")).alias("max_color"),
        episode_status(
            F.col("end_date"), F.col("evaluable_days"), F.col("coverage_rate"), archive_start
        ).alias("status"),
    )
