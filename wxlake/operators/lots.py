"""Which raw lots to load: planning, skipping and completeness."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wxlake import dimensions
from wxlake.schemas import ARCHIVE_TREE

# File families and periods (name, first year, last year, snapshots).
FAMILIES = ("RR-T-Vent", "autres-parametres")
PERIODS = (
    ("avant-1949", 0, 1949, False),
    ("previous-1950-2024", 1950, 2024, False),
    ("latest-2025-2026", 2025, 9999, True),
)
ALERT_FILE = "CDP_CARTE_EXTERNE.json"
DEFAULT_ALERT_DAYS = 3


def check_range(start: date, end: date) -> None:
    if end < start:
        raise ValueError(f"end {end} is before start {start}")


def periods_between(start: date | None, end: date | None, periods: Sequence[tuple] = PERIODS) -> list[str]:
    """Names of the file periods that cover part of a range of days, each end optional."""
    first = start.year if start else 0
    last = end.year if end else 9999
    return [name for name, begin, stop, _ in periods if first <= stop and last >= begin]


def overlapping_periods(
    start: Column, end: Column, run_day: Column, periods: Sequence[tuple] = PERIODS
) -> Column:
    """Array of the file periods that cover part of a range of days.

    The cumulative period is a new snapshot each day, never after the run day.
    """
    candidates = [
        F.when(
            (F.year(start) <= last) & (F.year(end) >= first),
            F.struct(
                F.lit(name).alias("period"),
                (F.least(end, run_day) if snapshots else F.lit(None).cast("date")).alias("snapshot"),
            ),
        )
        for name, first, last, snapshots in periods
    ]
    return F.filter(F.array(*candidates), lambda p: p.isNotNull())


def daily_lots(requests: DataFrame, periods: Sequence[tuple] = PERIODS) -> DataFrame:
    """Requests (dept, start, end, run_day) to lots: area, family, period, snapshot.

    Families and periods are constant arrays, so each request is expanded in its
    own row. An inverted range is an error.
    """
    checked = requests.withColumn(
        "start",
        F.when(F.col("end") >= F.col("start"), F.col("start")).otherwise(
            F.raise_error(F.lit("end is before start")).cast("date")
        ),
    )
    return (
        checked.select(
            "dept",
            F.explode(F.array(*[F.lit(f) for f in FAMILIES])).alias("family"),
            overlapping_periods(F.col("start"), F.col("end"), F.col("run_day"), periods).alias("periods"),
        )
        .select("dept", "family", F.inline("periods"))
        .distinct()
    )


def plan_daily_lots(
    spark: SparkSession, start: date, end: date, run_day: date, periods: Sequence[tuple] = PERIODS
) -> DataFrame:
    """Lots of all areas for one range of days."""
    check_range(start, end)
    requests = dimensions.areas(spark).select(
        "dept", F.lit(start).alias("start"), F.lit(end).alias("end"), F.lit(run_day).alias("run_day")
    )
    return daily_lots(requests, periods)


def plan_hourly_lots(spark: SparkSession, run_day: date) -> DataFrame:
    """One snapshot of the day for each featured area."""
    return dimensions.featured(spark).select("dept", F.lit(run_day).alias("snapshot"))


def plan_grid_lots(spark: SparkSession, first_year: int, run_day: date) -> DataFrame:
    """Grid reference, one monthly lot per year, the current daily window."""
    years = spark.range(first_year, run_day.year + 1).select(
        F.lit("mens").alias("kind"),
        F.col("id").cast("int").alias("year"),
        F.when(F.col("id") == run_day.year, F.lit(run_day)).alias("snapshot"),
    )
    day = run_day.isoformat()
    others = spark.sql(
        "SELECT * FROM VALUES ('grille', CAST(NULL AS INT), CAST(NULL AS DATE)), "
        f"('quot_latest', CAST(NULL AS INT), DATE '{day}') AS t(kind, year, snapshot)"
    )
    return years.unionByName(others)


def pending_lots(planned: DataFrame, present: DataFrame, key: Sequence[str], force: bool = False) -> DataFrame:
    """Planned lots that are not there yet; ``force`` keeps them all."""
    if force:
        return planned
    done = present.select(*[F.col(k).alias(f"_{k}") for k in key])
    same = None
    for k in key:
        equal = F.col(k).eqNullSafe(F.col(f"_{k}"))
        same = equal if same is None else same & equal
    return planned.join(done, same, "left_anti")


def complete_lots(rows: DataFrame, markers: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of lots that have their completion marker."""
    return rows.join(markers.select(*key), list(key), "left_semi")


def archive_files(tree: DataFrame, column: str = "tree") -> DataFrame:
    """Archive tree {year: {month: {day: {time: [files]}}}} to one row per time."""
    parsed = tree.select(F.from_json(column, ARCHIVE_TREE).alias("years"))
    months = parsed.select(F.explode("years").alias("year", "months"))
    days = months.select("year", F.explode("months").alias("month", "days"))
    times = days.select("year", "month", F.explode("days").alias("day", "times"))
    return times.select(
        F.concat_ws("-", "year", "month", "day").try_cast("date").alias("day"),
        F.explode("times").alias("time", "files"),
    )


def first_production(
    tree: DataFrame, start: date | None = None, end: date | None = None,
    wanted: str = ALERT_FILE, column: str = "tree", run_day: date | None = None,
) -> DataFrame:
    """Earliest time of each day whose files include the wanted one.

    Without a range, the last three days up to the run day.
    """
    end = end or run_day
    if start is None and end is not None:
        start = end - timedelta(days=DEFAULT_ALERT_DAYS - 1)
    if start and end:
        check_range(start, end)
    having = archive_files(tree, column).filter(F.array_contains("files", wanted))
    if start:
        having = having.filter(F.col("day") >= F.lit(start))
    if end:
        having = having.filter(F.col("day") <= F.lit(end))
    return having.groupBy("day").agg(F.min("time").alias("time"))
