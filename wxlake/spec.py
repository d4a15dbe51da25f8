"""Weights, thresholds and other parameters of the operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class IndexSpec:
    """Parameters of the 0-100 gloom index."""

    # Weights of the five components.
    w_cold: float = 0.30
    w_dark: float = 0.25
    w_rain: float = 0.25
    w_wind: float = 0.10
    w_humid: float = 0.10
    # Thresholds that scale each measure to 0-1.
    temp_comfort: float = 15.0  # degrees C, cold component 0 above
    temp_freezing: float = -5.0  # degrees C, cold component 1 below
    rain_day: float = 20.0  # mm per day
    rain_live: float = 2.0  # mm in the live reading
    rain_month: float = 600.0  # mm per month, 20 mm for 30 days
    sun_full: float = 360.0  # minutes of sunshine in a bright day
    radiation_full: float = 2000.0  # J/cm2 in a bright day
    wind_full: float = 10.0  # m/s
    humid_floor: float = 60.0  # percent, humid component 0 below
    humid_span: float = 40.0
    dark_unknown: float = 0.5  # neither sunshine nor fog observed

    def weight(self, component: str) -> float:
        return getattr(self, f"w_{component}")


COMPONENTS = ("cold", "dark", "rain", "wind", "humid")


@dataclass(frozen=True)
class RunType:
    """One kind of run of consecutive days: condition, length and intensity."""

    name: str
    measure: str
    op: str  # "<=" or ">="
    threshold: float
    min_days: int
    intensity: str  # min, sum or max of the measure over the run
    phenomenon_id: int  # alert phenomenon the run is checked against


# The three kinds of run.
RUN_TYPES = (
    RunType("cold_spell", "temp_min", "<=", 0.0, 3, "min", 7),
    RunType("rain_spell", "precip_mm", ">=", 5.0, 3, "sum", 2),
    RunType("wind_gust", "gust_ms", ">=", 20.0, 1, "max", 1),
)

# Fixed value: lowland stations only, metres.
MAX_ELEVATION = 300.0
# A day is complete from this many official hours or live points.
MIN_HOURS = 20
MIN_POINTS = 80
# Fixed value: first day of the alert archive.
ALERT_ARCHIVE_START = "2022-11-28"
# Fixed value: share of covered days from which a run counts as confirmed.
CONFIRMED_RATE = 0.5
# Mesh cell of 160 hm (16 km), labelled by its centre.
CELL_HM = 160

OFFICIAL = "official"
LIVE = "live"
