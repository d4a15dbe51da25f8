"""Numeric cleaning and rounding expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KMH_PER_MS = 3.6


def stable_round(value: Column, digits: int) -> Column:
    """Half-up rounding that does not depend on the last bits of a double.

    The value is first fixed at eight decimals, so sums taken in another order
    round alike. Values outside the decimal range (and NaN) use plain round.
    """
    fixed = F.round(value.cast("decimal(28,8)"), digits).cast("double")
    return F.when(F.abs(value) < 1e19, fixed).otherwise(F.round(value, digits))


def clamp01(value: Column) -> Column:
    """Limit to [0, 1]. NULL gives 0: greatest() skips NULLs."""
    return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))


def number(value: Column) -> Column:
    """Text to double; malformed text gives NULL."""
    return value.try_cast("double")


def decimal_comma(value: Column) -> Column:
    """Text with a decimal comma to double."""
    return F.regexp_replace(value, ",", ".").try_cast("double")


def quality_null(value: Column, code: Column, doubtful: int = 2) -> Column:
    """Numeric value unless its quality code marks it as doubtful.

    A missing code keeps the value, an unreadable one drops it.
    """
    level = code.try_cast("double").try_cast("int")
    return F.when(code.isNull() | (level != doubtful), number(value))


def kmh_to_ms(value: Column) -> Column:
    return value / F.lit(KMH_PER_MS)


def ms_to_kmh(value: Column) -> Column:
    return value * F.lit(KMH_PER_MS)


def code_flag(code: Column, codes) -> Column:
    """1.0 if the code is in the set, 0.0 if not, NULL for a missing code."""
    return code.isin(*codes).cast("double")


def lookup(mapping: dict, key: Column) -> Column:
    """Label of a code from a small constant map; unknown codes give NULL."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def step_value(value: Column, steps, below) -> Column:
    """Result of the highest step whose bound is reached, else ``below``.

    ``steps`` is a list of (lower bound, result) in ascending order.
    """
    out = None
    for bound, result in reversed(list(steps)):
        out = (F.when if out is None else out.when)(value >= bound, F.lit(result))
    return out.otherwise(F.lit(below))
