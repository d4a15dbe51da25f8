"""Values for maps: interpolation, layers, legend scale, choice of source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxlake import dimensions
from wxlake.functions import geo
from wxlake.functions.numbers import clamp01, ms_to_kmh, stable_round

# Columns of one compact cell.
CELL_DAY = ("lat", "lon", "temp", "precip_mm", "wind_ms", "humidity_pct", "ssi", "gloom")
CELL_MONTH = ("lat", "lon", "temp", "precip_mm", None, None, None, "gloom_partial")


def featured_values(daily: DataFrame, value: str, day: str = "obs_date") -> DataFrame:
    """Coordinates and value of the featured cities, one row per city and day."""
    cities = dimensions.featured(daily.sparkSession).select("city", "lat", "lon")
    points = daily.select(day, "city", F.col(value).alias("value")).join(cities, "city", "inner")
    means = points.groupBy(day, "city", "lat", "lon").agg(F.avg("value").alias("value"))
    return means.filter(F.col("value").isNotNull())


def stations_by_day(points: DataFrame, day: str = "obs_date") -> DataFrame:
    """The points of each day as one array, at most one per featured city."""
    stations = F.array_sort(F.collect_list(F.struct("lat", "lon", "value", "city")))
    return points.groupBy(day).agg(stations.alias("stations"))


def idw_value(lat: Column, lon: Column, stations: str) -> Column:
    """Inverse-distance weighted mean of an array of stations at a place."""

    def weight(s):
        return geo.idw_weight(lat, lon, s["lat"], s["lon"])

    total = F.aggregate(stations, F.lit(0.0), lambda acc, s: acc + weight(s) * s["value"])
    return total / F.aggregate(stations, F.lit(0.0), lambda acc, s: acc + weight(s))


def interpolate(points: DataFrame, rows: int, columns: int, day: str = "obs_date") -> DataFrame:
    """Inverse-distance map of each day on a grid of evenly spaced Mercator rows.

    ``points`` holds at most one value per featured city and day, so the array of
    a day has ten entries at most. Each grid point folds over that array in a
    fixed order; nothing is shuffled after the days are gathered and no pairs are
    formed.
    """
    pixels = stations_by_day(points, day).withColumn(
        "pixel", F.explode(F.sequence(F.lit(0), F.lit(rows * columns - 1)))
    )
    placed = pixels.withColumns({
        "row": F.floor(F.col("pixel") / columns).cast("int"),
        "col": (F.col("pixel") % columns).cast("int"),
    }).withColumns({
        "lat": geo.row_latitude(F.col("row"), rows),
        "lon": geo.column_longitude(F.col("col"), columns),
    })
    # A step of its own: in one select, a lambda would see the rounded aliases.
    valued = placed.withColumn("value", idw_value(F.col("lat"), F.col("lon"), "stations"))
    return valued.select(
        day, "row", "col",
        *[stable_round(F.col(c), n).alias(c) for c, n in (("lat", 4), ("lon", 4), ("value", 3))],
    )


def legend_bounds(df: DataFrame, keys: Sequence[str], value: str, share: float) -> DataFrame:
    """Padded minimum and maximum per key; never below 0 for all-positive values."""
    ends = df.groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high"))
    pad = F.greatest((F.col("high") - F.col("low")) * share, F.lit(0.5))
    floor = F.when(F.col("low") >= 0, F.greatest(F.col("low") - pad, F.lit(0.0)))
    return ends.select(
        *keys, F.coalesce(floor, F.col("low") - pad).alias("vmin"),
        (F.col("high") + pad).alias("vmax"),
    )


def min_max_scale(
    df: DataFrame, keys: Sequence[str], value: str, share: float = 0.15
) -> DataFrame:
    """Values as 0-1 positions on the legend of their key."""
    bounds = legend_bounds(df, keys, value, share)
    span = F.col("vmax") - F.col("vmin")
    known = df.filter(F.col(value).isNotNull()).join(bounds, list(keys), "inner")
    return known.withColumn("scaled", clamp01((F.col(value) - F.col("vmin")) / span))


def _layers(df: DataFrame, keys: Sequence[str], layers: dict[str, Column]) -> DataFrame:
    rows = F.array(*[
        F.struct(F.lit(name).alias("layer"), value.cast("double").alias("value"))
        for name, value in layers.items()
    ])
    return df.select(*keys, F.inline(rows))


def daily_layers(daily: DataFrame, keys: Sequence[str] = ("dept", "obs_date")) -> DataFrame:
    """Layer name and value of each map layer of a past day."""
    return _layers(daily, keys, {
        "temp": F.col("temp_avg"), "wind": ms_to_kmh(F.col("wind_ms")),
        "humid": F.col("humidity_pct"), "rain": F.col("precip_mm"),
        "sun": F.col("sunshine_min"), "gloom": F.col("gloom"),
    })


def live_layers(live: DataFrame, keys: Sequence[str] = ("city", "obs_time")) -> DataFrame:
    """Layers of the live map; sunshine is the share of clear sky."""
    return _layers(live, keys, {
        "temp": F.col("temperature"), "wind": ms_to_kmh(F.col("wind_speed_ms")),
        "humid": F.col("humidity_pct"), "rain": F.col("precipitation_mm"),
        "sun": 100 - F.col("cloud_cover_pct"), "clouds": F.col("cloud_cover_pct"),
        "gloom": F.col("gloom_live"),
    })


def grid_layers(cells: DataFrame, monthly: bool = False) -> DataFrame:
    """Layers of the grid map; monthly cells know three of them."""
    if monthly:
        return _layers(cells, ("cellx", "celly", "year", "month"), {
            "temp": F.col("temp"), "rain": F.col("precip_mm"), "gloom": F.col("gloom_partial"),
        })
    return _layers(cells, ("cellx", "celly", "obs_date"), {
        "temp": F.col("temp"), "rain": F.col("precip_mm"), "wind": ms_to_kmh(F.col("wind_ms")),
        "humid": F.col("humidity_pct"), "sun": F.col("ssi"), "gloom": F.col("gloom"),
    })


def compact_cells(cells: DataFrame, keys: Sequence[str], columns: Sequence[str | None]) -> DataFrame:
    """One array of numbers per cell; unknown measures are NULL entries."""
    entries = [F.lit(None).cast("double") if c is None else F.col(c) for c in columns]
    return cells.select(*keys, F.array(*entries).alias("cell"))


def cells_of_day(grid_daily: DataFrame, day: str) -> DataFrame:
    """Compact cells of one day; year and month prune the table's folders."""
    at_day = (
        (F.col("year") == int(day[:4])) & (F.col("month") == int(day[5:7]))
        & (F.col("obs_date") == F.to_date(F.lit(day)))
    )
    return compact_cells(grid_daily.filter(at_day), ["obs_date"], CELL_DAY)


def cells_of_month(grid_monthly: DataFrame, year: int, month: int) -> DataFrame:
    """Compact cells of one month in the layout of the daily ones."""
    at_month = (F.col("year") == year) & (F.col("month") == month)
    return compact_cells(grid_monthly.filter(at_month), ["year", "month"], CELL_MONTH)


def grid_dates(grid_daily: DataFrame, grid_monthly: DataFrame) -> DataFrame:
    """Days with daily cells and years with monthly cells, as text."""
    days = grid_daily.select(
        F.lit("day").alias("kind"), F.date_format("obs_date", "yyyy-MM-dd").alias("value")
    )
    years = grid_monthly.select(
        F.lit("year").alias("kind"), F.col("year").cast("string").alias("value")
    )
    return days.distinct().unionByName(years.distinct()).orderBy("kind", "value")


def grid_source_by_day(days: DataFrame, grid_daily: DataFrame, grid_monthly: DataFrame) -> DataFrame:
    """Which source draws each day: daily cells, else monthly cells, else stations.

    The three candidates are tagged with a priority and the best one kept. Both
    grids are first reduced to one row per day or month.
    """
    day_cells = grid_daily.groupBy("obs_date").agg(F.count("*").alias("day_cells"))
    month_cells = grid_monthly.groupBy("year", "month").agg(F.count("*").alias("month_cells"))
    dated = days.select("obs_date").distinct().withColumns(
        {"year": F.year("obs_date"), "month": F.month("obs_date")}
    )
    found = dated.join(day_cells, "obs_date", "left").join(month_cells, ["year", "month"], "left")
    return found.select(
        "obs_date",
        F.when(F.col("day_cells").isNotNull(), "grid_daily")
        .when(F.col("month_cells").isNotNull(), "grid_monthly")
        .otherwise("stations").alias("grid_source"),
        F.coalesce("day_cells", "month_cells", F.lit(0)).cast("bigint").alias("n_cells"),
    )
