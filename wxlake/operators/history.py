"""A day against its history: standing among earlier days, records, rolling totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxlake.functions.numbers import stable_round

#: Days of a stretch of a series that one task sums up.
STRETCH_DAYS = 3650
AREA_MONTH = ("dept", "month")


def units(value: Column, digits: int) -> Column:
    """A value as a whole number of its last digit, so counts and sums are exact."""
    return (F.round(value.cast("decimal(28,8)"), digits) * 10**digits).cast("bigint")


def distribution(days: DataFrame, value: str, keys: Sequence[str] = AREA_MONTH, digits: int = 1) -> DataFrame:
    """How often each value occurs per key: ``unit`` (see ``units``) and ``n``. Days without value don't count.

    A table of such counts is all of the history that ``standing`` needs: counts of other days are added by
    ``merged``, and its rows are bounded by the values of a measure and not by the days.
    """
    known = days.select(*keys, units(F.col(value), digits).alias("unit")).filter(F.col("unit").isNotNull())
    return known.groupBy(*keys, "unit").agg(F.count("*").alias("n"))


def merged(counts: DataFrame, more: DataFrame, keys: Sequence[str] = AREA_MONTH) -> DataFrame:
    """Counts of both histories."""
    return counts.unionByName(more).groupBy(*keys, "unit").agg(F.sum("n").alias("n"))


def standing(
    days: DataFrame, counts: DataFrame, value: str, keys: Sequence[str] = AREA_MONTH, digits: int = 1
) -> DataFrame:
    """Days with their place in a history of counts.

    Adds ``n_history``, ``percentile`` (percent of the history at or below the value), ``z_score`` and ``record``
    (``high`` or ``low`` for a value beyond all of the history). All are NULL without history or value, the score
    also where all of the history is one value.

    The days' own values join the counts with a count of 0. Prefix sums over the values of a key then
    answer all days by one equi-join on key and value.
    """
    placed = days.withColumn("unit", units(F.col(value), digits))
    asked = placed.filter(F.col("unit").isNotNull()).select(*keys, "unit", F.lit(0).cast("bigint").alias("n")).distinct()
    points = merged(counts, asked, keys)
    own = Window.partitionBy(*keys)
    held = F.when(F.col("n") > 0, F.col("unit"))
    unit, n = F.col("unit").cast("decimal(19,0)"), F.col("n")
    sums = points.select(
        *keys, "unit",
        F.sum("n").over(own.orderBy("unit").rowsBetween(Window.unboundedPreceding, 0)).alias("below"),
        F.sum("n").over(own).alias("total"), F.sum(n * unit).over(own).cast("double").alias("s1"),
        F.sum(n * unit * unit).over(own).cast("double").alias("s2"),
        F.max(held).over(own).alias("highest"), F.min(held).over(own).alias("lowest"),
    ).filter("total > 0")
    mean = F.col("s1") / F.col("total")
    spread = F.sqrt(F.greatest(F.col("s2") / F.col("total") - mean * mean, F.lit(0.0)))
    return placed.join(sums, [*keys, "unit"], "left").select(
        *[F.col(f"`{c}`") for c in days.columns], F.col("total").alias("n_history"),
        stable_round(100.0 * F.col("below") / F.col("total"), 2).alias("percentile"),
        stable_round(F.when(spread > 1e-6, (F.col("unit") - mean) / spread), 3).alias("z_score"),
        F.when(F.col("unit") > F.col("highest"), "high").when(F.col("unit") < F.col("lowest"), "low").alias("record"),
    )


def records_broken(
    daily: DataFrame, value: str, keys: Sequence[str] = AREA_MONTH, day: str = "obs_date", digits: int = 1
) -> DataFrame:
    """Months whose highest value is above that of all earlier years of the key.

    One row per key and year: the first day with the value, the ``record`` and the one before it. Days are reduced to
    one row per key and year first, so the running maximum goes over years.
    """
    known = daily.select(*keys, F.year(day).alias("year"), F.col(day), units(F.col(value), digits).alias("unit"))
    best = known.filter(F.col("unit").isNotNull()).groupBy(*keys, "year").agg(
        F.max(F.struct("unit", (-F.unix_date(day)).alias("early"))).alias("best"))
    years = Window.partitionBy(*keys).orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    ranked = best.withColumn("before", F.max("best.unit").over(years)).filter(F.col("best.unit") > F.col("before"))
    scale = float(10**digits)
    return ranked.select(
        *keys, "year", F.date_from_unix_date((-F.col("best.early")).cast("int")).alias(day),
        (F.col("best.unit") / scale).alias("record"), (F.col("before") / scale).alias("before"))


def rolling_totals(
    daily: DataFrame, value: str, lengths: Sequence[int] = (3, 7, 30), keys: Sequence[str] = ("dept",), day: str = "obs_date",
    digits: int = 1, stretch: int = STRETCH_DAYS,
) -> DataFrame:
    """Totals of the calendar days up to each day: ``sum_{n}d`` and ``complete_{n}d``.

    Frames are spans of days, not of rows: a missing day is no part of the sum, and a frame is complete only if each of
    its days has a value. A frame without any value has a NULL sum.

    A series is cut into stretches that are summed apart. A stretch also holds the days before it that its first
    frames reach, so a series of any length is spread over tasks and read once.
    """
    longest = max(lengths)
    if stretch < longest:
        raise ValueError(f"stretches of {stretch} days are shorter than {longest}")
    number = F.unix_date(day)
    own = F.floor(number / stretch)
    rows = daily.select(*keys, F.col(day), F.col(value).alias("_value"), number.alias("_number"), own.alias("_own"))
    near_end = F.col("_number") - F.col("_own") * stretch >= stretch - (longest - 1)
    shared = rows.withColumn("_stretch", F.explode(
        F.when(near_end, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(F.array(F.col("_own")))))
    series = Window.partitionBy(*keys, "_stretch").orderBy("_number")
    totals = {}
    for n in lengths:
        frame = series.rangeBetween(-(n - 1), 0)
        totals[f"sum_{n}d"] = stable_round(F.sum("_value").over(frame), digits)
        totals[f"complete_{n}d"] = F.count("_value").over(frame) == n
    # Days that a stretch only borrows have their totals in their own stretch.
    summed = shared.withColumns(totals).filter(F.col("_stretch") == F.col("_own"))
    return summed.select(*keys, day, F.col("_value").alias(value), *totals)
