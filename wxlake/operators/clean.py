"""Raw frames to layer tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxlake import schemas
from wxlake.dimensions import AREA_ALIAS, PHENOMENA
from wxlake.functions import dates
from wxlake.functions.numbers import (
    code_flag, decimal_comma, kmh_to_ms, lookup, number, quality_null,
)
from wxlake.operators.dedup import latest_per_key
from wxlake.spec import LIVE, OFFICIAL

# Layer column <- raw column; the quality code is "Q" + raw column.
DAILY_MAIN_MEASURES = {
    "temperature": "TM", "temp_min": "TN", "temp_max": "TX", "precipitation_mm": "RR",
    "wind_speed_ms": "FFM", "wind_gust_ms": "FXI", "frost_min": "DG",
}
DAILY_OTHER_MEASURES = {
    "sunshine_min": "INST", "humidity_pct": "UM", "pressure_hpa": "PMERM",
    "fog": "BROU", "snowfall_cm": "HNEIGEF",
}
HOURLY_MEASURES = {
    "temp": "T", "precip_mm": "RR1", "wind_ms": "FF", "gust_ms": "FXI", "humidity_pct": "U",
}
FOG_CODES = (45, 48)
STATION_DAY = ("station_id", "obs_date")
KEY_HASH = "_key_hash"
# Fixed value: area codes of the mainland in the alert maps.
MAINLAND_AREA = "^([0-9]{2}|2A|2B)$"


def checked_measures(measures: dict[str, str]) -> list[Column]:
    return [
        quality_null(F.col(raw), F.col(f"Q{raw}")).alias(name) for name, raw in measures.items()
    ]


def area_of_station(station: Column) -> Column:
    return F.substring(station, 1, 2)


def _station_columns() -> list[Column]:
    return [
        F.col("NUM_POSTE").alias("station_id"),
        F.col("NOM_USUEL").alias("station_name"),
        number(F.col("LAT")).alias("latitude"),
        number(F.col("LON")).alias("longitude"),
        number(F.col("ALTI")).alias("elevation"),
    ]


def _newest(
    raw: DataFrame, keys: Sequence[str], columns: Sequence[Column], newest: Sequence[str],
    tiebreak: Sequence[str] | None,
) -> DataFrame:
    """Cleaned columns of the newest row per key, and a hash of the key.

    Rows are projected first, so columns of the files that the model does not
    have are not sorted. The hash is the first key: a sort tells numbers apart
    without a look at the rows, while texts that begin alike need one. Columns
    that only order the rows are dropped.
    """
    order = [*newest, *(tiebreak or ())]
    rows = raw.select(*columns, *[F.col(c).alias(f"_{c}") for c in order])
    rows = rows.filter(F.col(keys[-1]).isNotNull())
    rows = rows.withColumn(KEY_HASH, F.xxhash64(*keys))
    ties = None if tiebreak is None else [f"_{c}" for c in tiebreak]
    found = latest_per_key(rows, [KEY_HASH, *keys], [f"_{c}" for c in newest], ties)
    return found.drop(*[f"_{c}" for c in order])


def _daily_key() -> Column:
    return dates.parse_day(F.col("AAAAMMJJ")).alias("obs_date")


def _main_columns() -> list[Column]:
    return [*_station_columns(), _daily_key(), *checked_measures(DAILY_MAIN_MEASURES)]


def _other_columns() -> list[Column]:
    return [
        F.col("NUM_POSTE").alias("station_id"), _daily_key(), *checked_measures(DAILY_OTHER_MEASURES),
    ]


def daily_main(raw: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """First daily family, newest snapshot per station and day."""
    return _newest(raw, STATION_DAY, _main_columns(), ["snapshot"], tiebreak).drop(KEY_HASH)


def daily_other(raw: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Second daily family, newest snapshot per station and day."""
    return _newest(raw, STATION_DAY, _other_columns(), ["snapshot"], tiebreak).drop(KEY_HASH)


def join_families(main: DataFrame, other: DataFrame, keys: Sequence[str] = STATION_DAY) -> DataFrame:
    """Main measurements with the secondary ones where present.

    Both sides have one row per station and day, so no key can be hot.
    """
    return main.join(other, list(keys), "left")


def official_observations(
    main_raw: DataFrame, other_raw: DataFrame, tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """Both raw daily families to the common observation table.

    They are joined as they were grouped and sorted for the newest rows.
    """
    joined = join_families(
        _newest(main_raw, STATION_DAY, _main_columns(), ["snapshot"], tiebreak),
        _newest(other_raw, STATION_DAY, _other_columns(), ["snapshot"], tiebreak),
        [KEY_HASH, *STATION_DAY],
    )
    return schemas.conform(
        joined.select(
            "*", F.lit(OFFICIAL).alias("source"), F.lit("daily").alias("granularity"),
            area_of_station(F.col("station_id")).alias("dept"),
        ),
        schemas.OBSERVATIONS,
    )


def live_measures(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Live message fields to the common model; wind in m/s. No state."""
    kept = {name: kind for name, kind in df.dtypes if name in keep}
    # Model column <- field of the message.
    return schemas.conform(
        df.select(
            *keep,
            F.lit(LIVE).alias("source"),
            F.col("city").alias("station_id"),
            F.col("city").alias("station_name"),
            "dept", "latitude", "longitude", "elevation",
            F.lit("15min").alias("granularity"),
            F.to_date("obs_time").alias("obs_date"),
            "obs_time",
            F.col("temperature_2m").alias("temperature"),
            F.col("precipitation").alias("precipitation_mm"),
            F.col("relative_humidity_2m").alias("humidity_pct"),
            F.col("pressure_msl").alias("pressure_hpa"),
            kmh_to_ms(F.col("wind_speed_10m")).alias("wind_speed_ms"),
            kmh_to_ms(F.col("wind_gusts_10m")).alias("wind_gust_ms"),
            code_flag(F.col("weather_code"), FOG_CODES).alias("fog"),
            F.col("snowfall").alias("snowfall_cm"),
            F.col("cloud_cover").alias("cloud_cover_pct"),
            "weather_code",
        ),
        {**kept, **schemas.OBSERVATIONS},
    )


def live_observations(raw: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Live messages to the common model, newest poll per city and quarter hour."""
    timed = raw.withColumn("obs_time", dates.parse_quarter(F.col("time")))
    order = ["ingested_at", *(tiebreak or ())]
    rows = live_measures(timed.filter(F.col("obs_time").isNotNull()), keep=order)
    return latest_per_key(rows, ["station_id", "obs_time"], ["ingested_at"], tiebreak).drop(*order)


def union_sources(*parts: DataFrame) -> DataFrame:
    """By-name union of the chosen sources."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def hourly_observations(raw: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Raw hourly files to the hourly table, newest snapshot per station and hour."""
    columns = [
        *_station_columns(), area_of_station(F.col("NUM_POSTE")).alias("dept"),
        dates.parse_hour(F.col("AAAAMMJJHH")).alias("obs_ts"), *checked_measures(HOURLY_MEASURES),
    ]
    newest = _newest(raw, ["station_id", "obs_ts"], columns, ["snapshot"], tiebreak)
    return schemas.conform(newest, schemas.OBSERVATIONS_HOURLY)


def grid_reference(raw: DataFrame) -> DataFrame:
    """Coordinates of each mesh; the text uses decimal commas."""
    return raw.select(
        F.col("`LAMBX (hm)`").try_cast("int").alias("lambx"),
        F.col("`LAMBY (hm)`").try_cast("int").alias("lamby"),
        decimal_comma(F.col("LAT_DG")).alias("lat"),
        decimal_comma(F.col("LON_DG")).alias("lon"),
    )


def _newest_mesh(
    raw: DataFrame, kind: str, day: Column, measures: Sequence[Column], tiebreak: Sequence[str] | None
) -> DataFrame:
    """Newest values per mesh and date; rows without a readable one are dropped."""
    columns = [
        F.col("LAMBX").try_cast("int").alias("lambx"), F.col("LAMBY").try_cast("int").alias("lamby"),
        day.alias("obs_date"), *measures,
    ]
    newest = _newest(raw, ["lambx", "lamby", "obs_date"], columns, ["snapshot"], tiebreak)
    return schemas.conform(newest.withColumn("kind", F.lit(kind)), schemas.GRID)


def grid_monthly(raw: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Monthly mesh values, dated on the first of the month."""
    measures = [decimal_comma(F.col("T")).alias("temp"), decimal_comma(F.col("PRETOTM")).alias("precip_mm")]
    return _newest_mesh(raw, "monthly", dates.parse_month(F.col("DATE")), measures, tiebreak)


def sum_of_phases(liquid: Column, solid: Column) -> Column:
    """Precipitation as liquid plus solid part, texts with decimal commas; NULL if one is missing."""
    return decimal_comma(liquid) + decimal_comma(solid)


def grid_daily(raw: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Daily mesh values; precipitation is the liquid plus the solid part."""
    measures = [
        decimal_comma(F.col("T")).alias("temp"), sum_of_phases(F.col("PRELIQ"), F.col("PRENEI")).alias("precip_mm"),
        decimal_comma(F.col("FF")).alias("wind_ms"), decimal_comma(F.col("HU")).alias("humidity_pct"),
        decimal_comma(F.col("SSI")).alias("ssi"),
    ]
    return _newest_mesh(raw, "daily", dates.parse_day(F.col("DATE")), measures, tiebreak)


def grid_table(values: DataFrame, reference: DataFrame) -> DataFrame:
    """Mesh values with coordinates; meshes outside the reference are dropped.

    No broadcast hint: the reference is small for one country, and Spark decides
    from its measured size.
    """
    return values.filter(F.col("obs_date").isNotNull()).join(
        reference, ["lambx", "lamby"], "inner"
    )


def with_month(df: DataFrame, day: str = "obs_date") -> DataFrame:
    return df.withColumns({"year": F.year(day), "month": F.month(day)})


def not_null_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def alert_rows(documents: DataFrame, term: str | None = "J") -> DataFrame:
    """Nested alert maps to one row per day, area and phenomenon.

    Only periods of the given term (same day) count. An area without any
    phenomenon keeps one row.
    """
    period = documents.select("vig_date", F.explode("product.periods").alias("period"))
    if term is not None:
        period = period.filter(F.col("period.echeance") == term)
    area = period.select("vig_date", F.explode("period.timelaps.domain_ids").alias("area"))
    item = area.select(
        "vig_date",
        F.col("area.domain_id").alias("dept"),
        F.col("area.max_color_id").try_cast("int").alias("dept_max_color_id"),
        F.explode_outer("area.phenomenon_items").alias("item"),
    )
    phenomenon = F.col("item.phenomenon_id").try_cast("int")
    return schemas.conform(
        mainland_areas(item).select(
            "vig_date", "dept", "dept_max_color_id",
            phenomenon.alias("phenomenon_id"),
            F.col("item.phenomenon_max_color_id").try_cast("int").alias("color_id"),
            lookup(PHENOMENA, phenomenon).alias("phenomene"),
        ),
        schemas.ALERTS,
    )


def mainland_areas(df: DataFrame, column: str = "dept") -> DataFrame:
    return df.filter(F.col(column).rlike(MAINLAND_AREA))


def unify_areas(df: DataFrame, column: str = "dept", alias: dict[str, str] = AREA_ALIAS) -> DataFrame:
    """Rename areas that the daily files know under another code."""
    return df.withColumn(column, F.coalesce(lookup(alias, F.col(column)), F.col(column)))
