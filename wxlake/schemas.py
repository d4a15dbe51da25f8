"""Explicit schemas of raw inputs and layer tables: column name -> type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Schema = dict[str, str]


def ddl(schema: Schema) -> str:
    """Schema text for ``DataFrameReader.schema``."""
    return ", ".join(f"`{name}` {kind}" for name, kind in schema.items())


def of_type(kind: str, *names: str) -> Schema:
    return {name: kind for name in names}


def strings(*names: str) -> Schema:
    """All-string schema; raw text is converted later with try_cast."""
    return of_type("string", *names)


# Column names of the raw daily, hourly and grid files.
DAILY_MAIN_COLUMNS = (
    "NUM_POSTE", "NOM_USUEL", "LAT", "LON", "ALTI", "AAAAMMJJ",
    "RR", "QRR", "TN", "QTN", "TX", "QTX", "TM", "QTM",
    "DG", "QDG", "FFM", "QFFM", "FXI", "QFXI",
)
DAILY_OTHER_COLUMNS = (
    "NUM_POSTE", "AAAAMMJJ", "INST", "QINST", "UM", "QUM", "PMERM", "QPMERM",
    "BROU", "QBROU", "HNEIGEF", "QHNEIGEF",
)
HOURLY_COLUMNS = (
    "NUM_POSTE", "NOM_USUEL", "LAT", "LON", "ALTI", "AAAAMMJJHH",
    "T", "QT", "RR1", "QRR1", "FF", "QFF", "FXI", "QFXI", "U", "QU",
)
GRID_REF_COLUMNS = ("LAMBX (hm)", "LAMBY (hm)", "LAT_DG", "LON_DG")
GRID_MONTHLY_COLUMNS = ("LAMBX", "LAMBY", "DATE", "T", "PRETOTM")
GRID_DAILY_COLUMNS = ("LAMBX", "LAMBY", "DATE", "T", "PRELIQ", "PRENEI", "FF", "HU", "SSI")

# Measures of one live message.
CURRENT: Schema = {
    **of_type("double", "temperature_2m", "relative_humidity_2m", "apparent_temperature"),
    "is_day": "int",
    **of_type("double", "precipitation", "rain", "showers", "snowfall"),
    "weather_code": "int",
    **of_type(
        "double", "cloud_cover", "pressure_msl", "surface_pressure", "wind_speed_10m",
        "wind_direction_10m", "wind_gusts_10m",
    ),
}
LIVE_MESSAGE: Schema = {
    **strings("ingested_at", "city", "dept"),
    **of_type("double", "latitude", "longitude", "elevation"),
    "time": "string",
    **CURRENT,
}
# The same message as captured, measures nested below `current`.
NESTED_MESSAGE: Schema = {
    "ingested_at": "string", "poll": "int", **strings("city", "dept"),
    **of_type("double", "latitude", "longitude", "elevation"),
    "current": "struct<time: string, " + ", ".join(f"{n}: {t}" for n, t in CURRENT.items()) + ">",
}

ALERT_DOCUMENT: Schema = {
    "product": (
        "struct<periods: array<struct<echeance: string, timelaps: struct<domain_ids: "
        "array<struct<domain_id: string, max_color_id: string, phenomenon_items: "
        "array<struct<phenomenon_id: string, phenomenon_max_color_id: string>>>>>>>>"
    )
}

# {year: {month: {day: {time: [files]}}}}
ARCHIVE_TREE = "map<string, map<string, map<string, map<string, array<string>>>>>"

OBSERVATIONS: Schema = {
    **strings("source", "station_id", "station_name", "dept"),
    **of_type("double", "latitude", "longitude", "elevation"),
    "granularity": "string", "obs_date": "date", "obs_time": "timestamp",
    **of_type(
        "double", "temperature", "temp_min", "temp_max", "precipitation_mm", "humidity_pct",
        "pressure_hpa", "wind_speed_ms", "wind_gust_ms", "sunshine_min", "frost_min", "fog",
        "snowfall_cm", "cloud_cover_pct",
    ),
    "weather_code": "int",
}
OBSERVATIONS_HOURLY: Schema = {
    **strings("station_id", "station_name", "dept"),
    **of_type("double", "latitude", "longitude", "elevation"),
    "obs_ts": "timestamp",
    **of_type("double", "temp", "precip_mm", "wind_ms", "gust_ms", "humidity_pct"),
}
GRID: Schema = {
    "kind": "string", **of_type("int", "lambx", "lamby"), "obs_date": "date",
    **of_type("double", "temp", "precip_mm", "wind_ms", "humidity_pct", "ssi"),
}
ALERTS: Schema = {
    "vig_date": "date", "dept": "string",
    **of_type("int", "dept_max_color_id", "phenomenon_id", "color_id"), "phenomene": "string",
}
EPISODES: Schema = {
    **strings("dept", "city", "type"), **of_type("date", "start_date", "end_date"),
    "n_days": "bigint", "intensity": "double",
}

EPISODES_ALERTS: Schema = {
    **EPISODES, "alert_days": "bigint", "coverage_rate": "double", **strings("max_color", "status"),
}


def _padded(df: DataFrame, name: str, kind: str) -> Column:
    if name in df.columns:
        return F.col(f"`{name}`").cast(kind).alias(name)
    return F.lit(None).cast(kind).alias(name)


def conform(df: DataFrame, schema: Schema) -> DataFrame:
    """Project to a layer schema; absent columns become typed NULLs."""
    return df.select(*[_padded(df, name, kind) for name, kind in schema.items()])
