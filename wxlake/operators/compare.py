"""Live readings against official hourly observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxlake.functions.dates import met_day_rain, met_day_temp
from wxlake.functions.numbers import stable_round
from wxlake.operators.rollup import lowland, with_city
from wxlake.spec import LIVE, MAX_ELEVATION, MIN_HOURS, MIN_POINTS


def by_met_day(df: DataFrame, ts: str, temp: str, rain: str) -> DataFrame:
    """Rows keyed by meteorological day, with ``temp`` and ``rain`` of that day.

    The two measures have different day boundaries. A reading whose days differ
    becomes two rows, each with one of the measures; all others stay one row. So
    both can be aggregated under one key in one exchange.
    """
    temp_day, rain_day = met_day_temp(F.col(ts)), met_day_rain(F.col(ts))
    nothing = F.lit(None).cast("double")

    def row(day, t, r):
        return F.struct(day.alias("obs_day"), t.alias("temp"), r.alias("rain"))

    both = F.array(row(temp_day, F.col(temp), F.col(rain)))
    split = F.array(row(temp_day, F.col(temp), nothing), row(rain_day, nothing, F.col(rain)))
    others = [c for c in df.columns if c not in (temp, rain)]
    return df.select(*others, F.inline(F.when(temp_day == rain_day, both).otherwise(split)))


def official_days(
    hourly: DataFrame, min_hours: int = MIN_HOURS, max_elevation: float = MAX_ELEVATION
) -> DataFrame:
    """Official temperature and rain per area and meteorological day.

    Stations count only with enough hours of that measure. Days without any
    complete temperature are dropped; their rain alone is not kept.
    """
    keyed = by_met_day(
        lowland(hourly, None, max_elevation).select(
            "dept", "station_id", "obs_ts", F.col("temp"), F.col("precip_mm")
        ),
        "obs_ts", "temp", "precip_mm",
    )
    station_day = keyed.groupBy("dept", "station_id", "obs_day").agg(
        F.avg("temp").alias("temp"), F.count("temp").alias("temp_hours"),
        F.sum("rain").alias("rain"), F.count("rain").alias("rain_hours"),
    )
    has_temp = F.col("temp_hours") >= min_hours
    has_rain = F.col("rain_hours") >= min_hours
    area_day = station_day.groupBy("dept", "obs_day").agg(
        F.avg(F.when(has_temp, F.col("temp"))).alias("temp_off"),
        F.max(F.when(has_temp, F.col("temp_hours"))).alias("n_hours"),
        F.avg(F.when(has_rain, F.col("rain"))).alias("precip_off"),
    )
    return area_day.filter(F.col("n_hours").isNotNull())


def live_days(
    obs: DataFrame, min_points: int = MIN_POINTS, min_points_rain: int = 0
) -> DataFrame:
    """Live temperature and rain per area and meteorological day.

    A reading holds the rain of the past hour and comes four times an hour, so
    the sum is divided by four. Rain has no completeness rule unless asked for.
    """
    live = obs.filter(F.col("source") == LIVE).select(
        "dept", "obs_time", "temperature", "precipitation_mm"
    )
    days = by_met_day(live, "obs_time", "temperature", "precipitation_mm").groupBy(
        "dept", "obs_day"
    ).agg(
        F.avg("temp").alias("temp_live"),
        F.count("temp").alias("n_points"),
        F.sum("rain").alias("_rain"),
        F.count("rain").alias("_rain_points"),
    )
    rain = F.when(F.col("_rain_points") >= min_points_rain, F.col("_rain") / 4)
    return (
        days.filter(F.col("n_points") >= min_points)
        .withColumn("precip_live", rain)
        .drop("_rain", "_rain_points")
    )


def live_vs_official(live: DataFrame, official: DataFrame) -> DataFrame:
    """Both daily tables side by side, with rounded differences."""
    joined = with_city(live.join(official, ["dept", "obs_day"], "inner"))
    return joined.select(
        "city", "dept", "obs_day",
        stable_round(F.col("temp_live"), 2).alias("temp_live"),
        stable_round(F.col("temp_off"), 2).alias("temp_off"),
        stable_round(F.col("temp_live") - F.col("temp_off"), 2).alias("diff_temp"),
        stable_round(F.col("precip_live"), 2).alias("precip_live"),
        stable_round(F.col("precip_off"), 2).alias("precip_off"),
        stable_round(F.col("precip_live") - F.col("precip_off"), 2).alias("diff_precip"),
        "n_hours", "n_points",
    )


def live_reliability(compared: DataFrame) -> DataFrame:
    """Mean absolute error and bias per city, from the rounded differences."""
    return compared.groupBy("city", "dept").agg(
        stable_round(F.avg(F.abs("diff_temp")), 2).alias("mae_temp"),
        stable_round(F.avg("diff_temp"), 2).alias("bias_temp"),
        stable_round(F.avg(F.abs("diff_precip")), 2).alias("mae_precip"),
        F.count("*").alias("n_days_compared"),
    )
