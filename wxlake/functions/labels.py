"""Display buckets, symbols and texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wxlake.functions.numbers import ms_to_kmh, stable_round, step_value

# Bounds and results of the display buckets.
SCORE_COLORS = ((25, "#fab219"), (45, "#ec835a"), (65, "#6b4fae"))
SCORE_COLOR_LOW = "#0ca30c"
MOODS = (
    (20, "🌤️ ça passe"), (40, "😶‍🌫️ bof bof"), (60, "🌧️ sortez les plaids"),
    (80, "🫠 misère totale"),
)
MOOD_LOW = "☀️ tout va bien !"
SKIES = ((25, "sky-nuageux"), (45, "sky-gris"), (65, "sky-misere"))
SKY_LOW = "sky-soleil"
RELIABILITIES = ((0.5, "correct"), (1.5, "douteux"))
RELIABILITY_LOW = "fiable"
MONTHS = (
    "janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre",
    "octobre", "novembre", "décembre",
)
BADGE_SEEN = "✔ vigilance "
BADGE_NOT_SEEN = "✖ non vu par la vigilance"

# Weather code -> symbol, valid from that code upwards.
WEATHER_SYMBOLS = (
    (0, "☀️"), (1, "🌤️"), (2, "⛅"), (3, "☁️"), (45, "🌫️"), (48, "🌫️"),
    (51, "🌦️"), (53, "🌦️"), (55, "🌧️"), (61, "🌧️"), (63, "🌧️"), (65, "🌧️"),
    (71, "🌨️"), (73, "🌨️"), (75, "❄️"), (80, "🌧️"), (81, "🌧️"), (82, "⛈️"),
    (95, "⛈️"), (96, "⛈️"), (99, "⛈️"),
)
NO_SYMBOL = "🌡️"


def score_color(score: Column) -> Column:
    return step_value(score, SCORE_COLORS, SCORE_COLOR_LOW)


def mood(score: Column) -> Column:
    return step_value(score, MOODS, MOOD_LOW)


def sky(score: Column) -> Column:
    """Sky class of a mean score; NULL without a score."""
    return F.when(score.isNotNull(), step_value(score, SKIES, SKY_LOW))


def reliability(mae: Column) -> Column:
    return F.when(mae.isNotNull(), step_value(mae, RELIABILITIES, RELIABILITY_LOW))


def freshness(minutes: Column) -> Column:
    """Age of a table in minutes: up to 20 fresh, up to 90 late, then stale."""
    return F.when(minutes <= 20, "fresh").when(minutes <= 90, "late").when(
        minutes.isNotNull(), "stale"
    )


def age_text(minutes: Column) -> Column:
    """Age of a table in words, from whole minutes."""
    hours = F.floor(minutes / 60).cast("string")
    rest = F.lpad((minutes % 60).cast("int").cast("string"), 2, "0")
    return (
        F.when(minutes < 1, "à l'instant")
        .when(minutes < 60, F.concat(F.lit("il y a "), minutes.cast("int").cast("string"), F.lit(" min")))
        .otherwise(F.concat(F.lit("il y a "), hours, F.lit(" h "), rest))
    )


def period_title(kind: Column, label: Column) -> Column:
    """Title of a ranking period: a month by name, other labels as they are."""
    names = F.array(*[F.lit(m) for m in MONTHS])
    month = F.try_element_at(names, F.split_part(label, F.lit("-"), F.lit(2)).try_cast("int"))
    named = F.concat(month, F.lit(" "), F.split_part(label, F.lit("-"), F.lit(1)))
    return F.when(kind == "month", named).otherwise(label)


def weather_symbol(code: Column) -> Column:
    return step_value(code, WEATHER_SYMBOLS, NO_SYMBOL)


def day_symbol(precip: Column, temp_min: Column, sunshine: Column) -> Column:
    """Symbol of a day from rain, then frost, then sunshine."""
    # Bounds and symbols.
    return (
        F.when(precip >= 10, "🌧️")
        .when(precip >= 1, "🌦️")
        .when(temp_min <= 0, "❄️")
        .when(sunshine >= 300, "☀️")
        .when(sunshine >= 120, "⛅")
        .otherwise("☁️")
    )


def alert_badge(status: Column, rate: Column, color: Column) -> Column:
    """Text on the alert coverage of a run.

    Empty for runs outside the archive and for runs without any alert map.
    """
    percent = stable_round(F.coalesce(rate, F.lit(0.0)) * 100, 0).cast("int").cast("string")
    seen = F.concat(
        F.lit(BADGE_SEEN), F.coalesce(color, F.lit("")), F.lit(" ("), percent, F.lit(" %)")
    )
    return (
        F.when(status == "confirmed", seen)
        .when(status == "not_confirmed", F.lit(BADGE_NOT_SEEN))
        .when(status.isin("out_of_archive", "not_evaluated"), F.lit(""))
    )


def intensity_text(kind: Column, intensity: Column) -> Column:
    """Intensity with its unit; gusts are shown in km/h."""
    tenths = F.regexp_replace(intensity.cast("decimal(18,1)").cast("string"), r"\.0$", "")
    kmh = stable_round(ms_to_kmh(intensity), 0).cast("int").cast("string")
    return (
        F.when(kind == "cold_spell", F.concat(F.lit("min "), tenths, F.lit("°C")))
        .when(kind == "rain_spell", F.concat(tenths, F.lit(" mm cumulés")))
        .when(kind == "wind_gust", F.concat(F.lit("rafales "), kmh, F.lit(" km/h")))
    )
