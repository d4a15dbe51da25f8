"""Monthly and multi-year rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxlake import dimensions
from wxlake.functions import dates
from wxlake.functions.numbers import stable_round

DAYS_PER_YEAR = 365.25
# Width of the steps in which ranks are counted.
SCORE_STEP = 0.1


def rank_within(df: DataFrame, keys: Sequence[str], score: str, name: str) -> DataFrame:
    """rank() by falling score inside each group; equal scores share a rank.

    For tables with one row per area and group, so a group never has more rows
    than there are areas. Use ``rank_by_score`` for anything larger.
    """
    window = Window.partitionBy(*keys).orderBy(F.col(score).desc_nulls_last())
    return df.withColumn(name, F.rank().over(window))


def rank_by_score(df: DataFrame, score: str, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """The same ranks for any number of rows.

    A rank is one plus the number of rows with a higher score. Rows are counted
    per distinct score, scores are numbered within a step of ``SCORE_STEP``, and
    only the steps, at most a thousand for an index of 0 to 100, are sorted as a
    whole. So scores need not be rounded.
    """
    keys = list(keys)
    step = F.floor(F.col(score) / SCORE_STEP)
    counts = df.groupBy(*keys, score).agg(F.count("*").alias("_n")).withColumn("_step", step)
    inside = Window.partitionBy(*keys, "_step").orderBy(F.col(score).desc_nulls_last())
    earlier = Window.unboundedPreceding, -1
    steps = counts.groupBy(*keys, "_step").agg(F.sum("_n").alias("_sum"))
    over = Window.partitionBy(*keys).orderBy(F.col("_step").desc_nulls_last())
    steps = steps.select(
        *[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_step").alias("_of"),
        F.coalesce(F.sum("_sum").over(over.rowsBetween(*earlier)), F.lit(0)).alias("_over"),
    )
    here = F.col("_step").eqNullSafe(F.col("_of"))
    for k in keys:
        here = here & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    above = F.coalesce(F.sum("_n").over(inside.rowsBetween(*earlier)), F.lit(0))
    ranks = counts.withColumn("_above", above).join(steps, here).select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col(score).alias("_score"),
        (F.col("_above") + F.col("_over") + 1).cast("int").alias(name),
    )
    same = F.col(score).eqNullSafe(F.col("_score"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(ranks, same, "left").drop("_score", *[f"_{k}" for k in keys])


def monthly_rollup(daily: DataFrame) -> DataFrame:
    return daily.groupBy("year", "month", "dept", "city").agg(
        stable_round(F.avg("gloom"), 1).alias("mean_gloom"),
        stable_round(F.avg("temp_avg"), 1).alias("mean_temp"),
        stable_round(F.sum("precip_mm"), 1).alias("rain_total_mm"),
        stable_round(F.avg("sunshine_min"), 0).alias("mean_sun_min"),
        F.count("*").alias("n_days"),
    )


def monthly_ranking(daily: DataFrame) -> DataFrame:
    """Areas ranked by mean index in each month, 1 = worst."""
    return rank_within(monthly_rollup(daily), ["year", "month"], "mean_gloom", "gloom_rank")


def last_day(daily: DataFrame) -> Column:
    """Latest day of a table as a scalar subquery."""
    return daily.agg(F.max("obs_date").alias("last")).scalar()


def period_rollup(daily: DataFrame, anchor: Column | None = None) -> DataFrame:
    """Current month, current year, last 5 and last 10 years in one aggregate.

    Each measure is aggregated under four conditions, so the daily table is read
    once and every task sends one partial row per area.
    """
    anchor = last_day(daily) if anchor is None else anchor
    # The scalar becomes a column once; everything below refers to that column.
    dated = daily.withColumn("_last", anchor)
    last, last_year = F.col("_last"), F.year("_last")
    periods = {
        "month": ((F.col("year") == last_year) & (F.col("month") == F.month(last)),
                  dates.month_label(last)),
        "year": (F.col("year") == last_year, dates.years_label(last, 1)),
        "5years": (F.col("year") >= last_year - 4, dates.years_label(last, 5)),
        "10years": (F.col("year") >= last_year - 9, dates.years_label(last, 10)),
    }
    aggregates = [F.max("_last").alias("_last")]
    for name, (inside, _) in periods.items():
        aggregates += [
            F.avg(F.when(inside, F.col("gloom"))).alias(f"{name}_gloom"),
            F.avg(F.when(inside, F.col("temp_avg"))).alias(f"{name}_temp"),
            F.sum(F.when(inside, F.col("precip_mm"))).alias(f"{name}_rain"),
            F.count(F.when(inside, F.lit(1))).alias(f"{name}_days"),
        ]
    # Only days inside the longest period can count.
    wide = dated.filter(periods["10years"][0]).groupBy("dept", "city").agg(*aggregates)
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("period_type"), label.alias("period_label"),
            stable_round(F.col(f"{name}_gloom"), 1).alias("mean_gloom"),
            stable_round(F.col(f"{name}_temp"), 1).alias("mean_temp"),
            stable_round(F.col(f"{name}_rain"), 1).alias("rain_total_mm"),
            F.col(f"{name}_days").alias("n_days"),
        )
        for name, (_, label) in periods.items()
    ])
    long = wide.select("dept", "city", F.inline(rows))
    return long.filter(F.col("n_days") > 0)


def period_podiums(daily: DataFrame, anchor: Column | None = None) -> DataFrame:
    """Areas ranked by mean index in each period."""
    return rank_within(
        period_rollup(daily, anchor), ["period_type"], "mean_gloom", "gloom_rank"
    )


def annual_rain(df: DataFrame) -> DataFrame:
    """Rain shown for a period: the total of a month, else the mean per year."""
    years = F.greatest(F.col("n_days") / DAYS_PER_YEAR, F.lit(1e-6))
    per_year = stable_round(F.col("rain_total_mm") / years, 0)
    shown = F.when(F.col("period_type") == "month", F.col("rain_total_mm")).otherwise(per_year)
    return df.withColumn("rain_shown_mm", shown)


def podium_split(ranking: DataFrame, group: str = "period_type", first: int = 3, then: int = 12) -> DataFrame:
    """Position of each row and whether it is on the podium, listed or counted."""
    window = Window.partitionBy(group).orderBy(F.col("gloom_rank"), F.col("dept"))
    place = F.row_number().over(window)
    part = F.when(F.col("place") <= first, "podium").when(
        F.col("place") <= first + then, "listed"
    ).otherwise("others")
    return ranking.withColumn("place", place).withColumn("part", part)


def podium_rest(split: DataFrame, group: str = "period_type") -> DataFrame:
    """How many rows of each group are neither on the podium nor listed."""
    return split.groupBy(group).agg(F.count_if(F.col("part") == "others").alias("n_others"))


def worst_days(daily: DataFrame, group: str = "city", score: str = "gloom") -> DataFrame:
    """Rows that reach the highest score of their group; ties are kept.

    ``rank() = 1`` is planned as a group limit on both sides of the exchange, so
    a task sends only the rows that tie for its own highest score.
    """
    order = Window.partitionBy(group).orderBy(F.col(score).desc_nulls_last())
    scored = daily.filter(F.col(group).isNotNull() & F.col(score).isNotNull())
    return scored.withColumn("_place", F.rank().over(order)).filter("_place = 1").drop("_place")


def selected_cities(df: DataFrame, cities: Sequence[str] | None = None) -> DataFrame:
    """Rows of the featured cities, or of the given ones."""
    names = [c[0] for c in dimensions.FEATURED] if cities is None else list(cities)
    wanted = dimensions.constant_frame(df.sparkSession, [(n,) for n in names], "city")
    return df.join(wanted, "city", "left_semi")


def rerank_selected(daily: DataFrame) -> DataFrame:
    """Positions 1..n of the featured cities on each day, missing scores last.

    A group is one day of at most ten cities.
    """
    window = Window.partitionBy("obs_date").orderBy(F.col("gloom").desc_nulls_last(), F.col("city"))
    return selected_cities(daily).withColumn("place", F.row_number().over(window))
