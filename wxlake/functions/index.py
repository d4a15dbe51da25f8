"""The five 0-1 components and the weighted 0-100 gloom index."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from wxlake.functions.numbers import clamp01, stable_round
from wxlake.spec import COMPONENTS, IndexSpec

SPEC = IndexSpec()


def cold(temp: Column, spec: IndexSpec = SPEC) -> Column:
    return clamp01((F.lit(spec.temp_comfort) - temp) / (spec.temp_comfort - spec.temp_freezing))


def rain(precip: Column, full: float = SPEC.rain_day) -> Column:
    return clamp01(precip / full)


def wind(speed: Column, spec: IndexSpec = SPEC) -> Column:
    return clamp01(speed / spec.wind_full)


def humid(humidity: Column, spec: IndexSpec = SPEC) -> Column:
    return clamp01((humidity - spec.humid_floor) / spec.humid_span)


def dark_from_sunshine(sunshine: Column, fog: Column, spec: IndexSpec = SPEC) -> Column:
    """Missing sunshine falls back to fog, then to a middle value."""
    return clamp01(F.coalesce(1 - sunshine / spec.sun_full, fog, F.lit(spec.dark_unknown)))


def dark_from_clouds(cover: Column) -> Column:
    return clamp01(cover / 100)


def dark_from_radiation(ssi: Column, spec: IndexSpec = SPEC) -> Column:
    return clamp01(1 - ssi / spec.radiation_full)


def daily_components(
    temp: Column, sunshine: Column, fog: Column, precip: Column, speed: Column,
    humidity: Column, spec: IndexSpec = SPEC,
) -> dict[str, Column]:
    return {
        "cold": cold(temp, spec),
        "dark": dark_from_sunshine(sunshine, fog, spec),
        "rain": rain(precip, spec.rain_day),
        "wind": wind(speed, spec),
        "humid": humid(humidity, spec),
    }


def live_components(
    temp: Column, cover: Column, precip: Column, speed: Column, humidity: Column,
    spec: IndexSpec = SPEC,
) -> dict[str, Column]:
    return {
        "cold": cold(temp, spec),
        "dark": dark_from_clouds(cover),
        "rain": rain(precip, spec.rain_live),
        "wind": wind(speed, spec),
        "humid": humid(humidity, spec),
    }


def grid_components(
    temp: Column, ssi: Column, precip: Column, speed: Column, humidity: Column,
    spec: IndexSpec = SPEC,
) -> dict[str, Column]:
    return {
        "cold": cold(temp, spec),
        "dark": dark_from_radiation(ssi, spec),
        "rain": rain(precip, spec.rain_day),
        "wind": wind(speed, spec),
        "humid": humid(humidity, spec),
    }


def partial_components(temp: Column, precip: Column, spec: IndexSpec = SPEC) -> dict[str, Column]:
    return {"cold": cold(temp, spec), "rain": rain(precip, spec.rain_month)}


def gloom(
    parts: dict[str, Column], spec: IndexSpec = SPEC, known: dict[str, Column] | None = None
) -> Column:
    """Weighted mean of the given components, times 100, one decimal.

    With fewer than five components the weights are rescaled to their sum. By
    default a missing measure counts as its best value (component 0). ``known``
    gives the measure behind each component; components whose measure is NULL
    are then left out and the weights of the others rescaled.
    """
    names = [c for c in COMPONENTS if c in parts]
    if known:
        have = {c: known[c].isNotNull() if c in known else F.lit(True) for c in names}
        score = reduce(add, [F.when(have[c], spec.weight(c) * parts[c]).otherwise(0.0) for c in names])
        total = reduce(add, [F.when(have[c], F.lit(spec.weight(c))).otherwise(0.0) for c in names])
        return stable_round(F.try_divide(score * 100, total), 1)
    score = reduce(add, [spec.weight(c) * parts[c] for c in names]) * 100
    if len(names) < len(COMPONENTS):
        score = score / sum(spec.weight(c) for c in names)
    return stable_round(score, 1)


def with_index(df, parts: dict[str, Column], name: str, spec: IndexSpec = SPEC, known=None):
    """Add the component columns ``c_*`` and the index column."""
    named = df.withColumns({f"c_{c}": parts[c] for c in COMPONENTS if c in parts})
    columns = {c: F.col(f"c_{c}") for c in parts}
    return named.withColumn(name, gloom(columns, spec, known))
