"""Date parsing and day boundaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the raw dates.
DAY_FORMAT = "yyyyMMdd"
MONTH_FORMAT = "yyyyMM"
HOUR_FORMAT = "yyyyMMddHH"
QUARTER_FORMAT = "yyyy-MM-dd'T'HH:mm"

# Minute after midnight at which a meteorological day begins.
TEMP_DAY_STARTS = 1
RAIN_DAY_STARTS = 361


def parse_day(text: Column) -> Column:
    return F.try_to_date(text, DAY_FORMAT)


def parse_month(text: Column) -> Column:
    """``yyyyMM`` to the first day of that month."""
    return F.try_to_date(F.concat(text, F.lit("01")), DAY_FORMAT)


def parse_hour(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(HOUR_FORMAT))


def parse_quarter(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(QUARTER_FORMAT))


def met_day(ts: Column, first_minute: int) -> Column:
    """Day of a reading when days begin that many minutes after midnight."""
    return F.to_date(ts - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(first_minute)))


def met_day_temp(ts: Column) -> Column:
    """Day a temperature belongs to: 00:01 to 24:00, so 00:00 is the day before."""
    return met_day(ts, TEMP_DAY_STARTS)


def met_day_rain(ts: Column) -> Column:
    """Day a rain amount belongs to: 06:01 to 06:00 of the next day."""
    return met_day(ts, RAIN_DAY_STARTS)


def days_between(first: Column | str, last: Column | str) -> Column:
    """Whole days from one day to another."""
    return F.date_diff(last, first)


def quarter_floor(ts: Column) -> Column:
    """Start of the quarter hour."""
    return F.date_trunc("hour", ts) + F.make_dt_interval(
        F.lit(0), F.lit(0), (F.floor(F.minute(ts) / 15) * 15).cast("int")
    )


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def years_label(day: Column, years: int) -> Column:
    """``yyyy`` for one year, ``first-last`` for several."""
    last = F.year(day)
    if years == 1:
        return last.cast("string")
    return F.concat((last - (years - 1)).cast("string"), F.lit("-"), last.cast("string"))
