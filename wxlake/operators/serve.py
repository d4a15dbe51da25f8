"""Result frames behind the pages of the site."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxlake.dimensions import CHART_CITIES
from wxlake.functions import labels
from wxlake.functions.dates import day_text
from wxlake.functions.index import SPEC
from wxlake.functions.numbers import stable_round
from wxlake.operators.dedup import latest_per_key
from wxlake.operators.ranking import rank_by_score
from wxlake.operators.rollup import live_index
from wxlake.spec import LIVE, IndexSpec

# Columns served for one day and for the chart.
DAY_COLUMNS = (
    "obs_date", "city", "dept", "gloom", "temp_avg", "temp_min", "temp_max", "precip_mm",
    "wind_ms", "gust_ms", "sunshine_min", "humidity_pct", "fog", "n_stations",
)
CHART_COLUMNS = (
    "obs_date", "city", "dept", "gloom", "temp_avg", "temp_min", "temp_max", "precip_mm",
    "sunshine_min", "wind_ms",
)
LIVE_COLUMNS = (
    "city", "dept", "obs_time", "temperature", "precipitation_mm", "wind_speed_ms",
    "wind_gust_ms", "cloud_cover_pct", "humidity_pct", "weather_code",
    "c_cold", "c_dark", "c_rain", "c_wind", "c_humid", "gloom_live",
)


def latest_live(
    obs: DataFrame, tiebreak: Sequence[str] | None = None, spec: IndexSpec = SPEC
) -> DataFrame:
    """Newest live row of each city with its index."""
    live = obs.filter(F.col("source") == LIVE)
    newest = latest_per_key(live, ["station_id"], ["obs_time"], tiebreak)
    scored = live_index(newest, spec)
    return scored.withColumn("city", F.col("station_id")).select(*LIVE_COLUMNS)


# Types of the served live columns.
LIVE_TYPES = {
    **{c: "double" for c in LIVE_COLUMNS}, "city": "string", "dept": "string",
    "obs_time": "timestamp", "weather_code": "int",
}


def renewed_status(
    obs: DataFrame, stored: DataFrame, since: date, spec: IndexSpec = SPEC
) -> DataFrame:
    """Stored status brought up to date with the observations from a month's first day on.

    Stored rows from that day on are dropped, as their months were replaced; a
    city that has been silent since keeps its older row.
    """
    month = F.lit(since.year * 100 + since.month)
    changed = obs.filter(F.col("year") * 100 + F.col("month") >= month)
    kept = stored.filter(F.to_date("obs_time") < F.lit(since)).select(*LIVE_COLUMNS)
    both = latest_live(changed, None, spec).unionByName(kept)
    return rank_by_score(latest_per_key(both, ["city"], ["obs_time"]), "gloom_live", "gloom_rank_live")


def live_status(
    obs: DataFrame, tiebreak: Sequence[str] | None = None, spec: IndexSpec = SPEC
) -> DataFrame:
    """Newest live row of each city, ranked over all cities."""
    return rank_by_score(latest_live(obs, tiebreak, spec), "gloom_live", "gloom_rank_live")


def day_lookup(daily: DataFrame, day: str, columns: Sequence[str] = DAY_COLUMNS) -> DataFrame:
    """All areas of one day; the year condition prunes the table's folders."""
    at_day = (F.col("year") == int(day[:4])) & (F.col("obs_date") == F.to_date(F.lit(day)))
    return daily.filter(at_day).select(*columns).orderBy("city", "dept")


def trailing_days(df: DataFrame, day: str, days: int, latest: Column | None = None) -> DataFrame:
    """Rows from the last day minus ``days`` on, both ends included."""
    last = df.agg(F.max(day).alias("last")).scalar() if latest is None else latest
    return df.filter(F.col(day) >= F.date_sub(last, days))


def chart_rows(daily: DataFrame, days: int = 30, latest: Column | None = None) -> DataFrame:
    recent = trailing_days(daily, "obs_date", days, latest)
    return recent.select(*CHART_COLUMNS).orderBy("city", "obs_date")


def month_ranking(ranking: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Ranking of one month, by default the last one present."""
    if year is None or month is None:
        number = F.col("year") * 100 + F.col("month")
        picked = ranking.filter(number == ranking.agg(F.max(number).alias("last")).scalar())
    else:
        picked = ranking.filter((F.col("year") == year) & (F.col("month") == month))
    return picked.orderBy("gloom_rank", "dept")


def last_batch(df: DataFrame, batch: str) -> DataFrame:
    return df.filter(F.col(batch) == df.agg(F.max(batch).alias("last")).scalar())


def days_by_year(days: DataFrame) -> DataFrame:
    """First, last and number of available days of each year."""
    return days.select("obs_date").distinct().groupBy(F.year("obs_date").alias("year")).agg(
        F.min("obs_date").alias("first_day"), F.max("obs_date").alias("last_day"),
        F.count("*").alias("n_days"),
    )


def days_of_year(days: DataFrame, year: int) -> DataFrame:
    start = F.make_date(F.lit(year), F.lit(1), F.lit(1))
    end = F.make_date(F.lit(year), F.lit(12), F.lit(31))
    return days_by_year(days.filter(F.col("obs_date").between(start, end)))


def neighbour_days(days: DataFrame) -> DataFrame:
    """Previous and next available day of each day.

    Neighbours are found within a year; the days at the ends of a year take
    theirs from the table of years, which has one row per year.
    """
    distinct = days.select("obs_date").distinct().withColumn("year", F.year("obs_date"))
    inside = Window.partitionBy("year").orderBy("obs_date")
    ends = distinct.groupBy("year").agg(F.min("obs_date").alias("first"), F.max("obs_date").alias("last"))
    order = Window.orderBy("year")
    around = ends.select(
        "year", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after")
    )
    return distinct.withColumns({
        "_prev": F.lag("obs_date").over(inside), "_next": F.lead("obs_date").over(inside),
    }).join(around, "year", "left").select(
        "obs_date",
        F.coalesce("_prev", "before").alias("previous_day"),
        F.coalesce("_next", "after").alias("next_day"),
    )


def preview(df: DataFrame, name: str, pattern: str, order: Sequence[str], rows: int = 8, fallback: int = 5) -> DataFrame:
    """Rows whose name contains the pattern, else the first rows of the table.

    Named rows sort first. Both kinds are cut on their own, so each task keeps
    only a handful of rows.
    """
    named = df.filter(F.col(name).ilike(f"%{pattern}%")).orderBy(*order).limit(rows)
    first = df.orderBy(*order).limit(fallback)
    found = named.agg(F.count("*").alias("n")).scalar()
    return named.unionByName(first.filter(found == 0))


def series_pivot(daily: DataFrame, cities: Sequence[str] = CHART_CITIES) -> DataFrame:
    """Days by chart cities, NULL where a city has no value that day."""
    return daily.groupBy("obs_date").pivot("city", list(cities)).agg(F.max("gloom"))


def national_mean(df: DataFrame, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean index over all areas with its sky class; NaN counts as missing."""
    known = F.when(~F.isnan(score), F.col(score))
    mean = df.groupBy(*keys).agg(F.avg(known).alias("_mean"))
    return mean.select(
        *keys, stable_round(F.col("_mean"), 2).alias("mean_score"), labels.sky(F.col("_mean")).alias("sky")
    )


def as_records(df: DataFrame) -> DataFrame:
    """Dates and times as text and NaN as NULL; a missing label stays NULL."""
    columns = []
    for name, kind in df.dtypes:
        value = F.col(name)
        if kind == "date":
            value = day_text(value)
        elif kind.startswith("timestamp"):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif kind in ("double", "float"):
            value = F.when(~F.isnan(name), value)
        columns.append(value.alias(name))
    return df.select(*columns)


def json_records(df: DataFrame) -> DataFrame:
    """One JSON object per row; missing values are written as null."""
    clean = as_records(df)
    body = F.to_json(F.struct(*clean.columns), {"ignoreNullFields": "false"})
    return clean.select(body.alias("value"))
