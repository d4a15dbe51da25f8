"""The next day from the day before: least squares per area, judged against persistence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxlake.functions.numbers import stable_round

#: Share of a feature's own spread below which it says nothing that the others don't.
NO_SPREAD = 1e-9


def next_days(daily: DataFrame, target: str, features: Sequence[str], keys: Sequence[str] = ("dept",), day: str = "obs_date") -> DataFrame:
    """Each day's features with ``y``, the target of the calendar day after it, and ``today``, its own.

    Days without a following day, or with a missing value, are left out. An equi-join on key and day.
    """
    today = daily.select(*keys, day, *[F.col(f).alias(f"x{i}") for i, f in enumerate(features)], F.col(target).alias("today"))
    later = daily.select(*keys, F.date_sub(F.col(day), 1).alias(day), F.col(target).alias("y"))
    return today.join(later, [*keys, day]).dropna(subset=["today", "y", *[f"x{i}" for i in range(len(features))]])


def sufficient_sums(pairs: DataFrame, n_features: int, keys: Sequence[str] = ("dept",)) -> DataFrame:
    """Counts, sums and sums of products of features and target: all that a fit needs, one row per key.

    Sums of other days are added column by column, so a fit can follow a growing table.
    """
    names = [*[f"x{i}" for i in range(n_features)], "y"]
    sums = {f"s_{a}": F.sum(a) for a in names}
    products = {f"s_{a}_{b}": F.sum(F.col(a) * F.col(b)) for i, a in enumerate(names) for b in names[i:]}
    return pairs.groupBy(*keys).agg(F.count("*").alias("n"), *[v.alias(k) for k, v in {**sums, **products}.items()])


def solved(sums: DataFrame, n_features: int, keys: Sequence[str] = ("dept",)) -> DataFrame:
    """``intercept`` and ``slope_0`` ... of each key, by elimination on the centred products.

    A feature without spread beyond the features before it gets the slope 0.
    """
    names = [*[f"x{i}" for i in range(n_features)], "y"]

    def centred(a: str, b: str) -> Column:
        return F.col(f"s_{a}_{b}") - F.col(f"s_{a}") * F.col(f"s_{b}") / F.col("n")

    cells = {(i, j): f"m_{i}_{j}" for i in range(n_features) for j in range(i, n_features + 1)}
    rows = sums.withColumns({cell: centred(names[i], names[j]) for (i, j), cell in cells.items()})
    rows = rows.withColumns({f"spread_{i}": F.col(cells[i, i]) for i in range(n_features)})
    for k in range(n_features):
        pivot = F.col(cells[k, k])
        rows = rows.withColumn(f"use_{k}", pivot > F.col(f"spread_{k}") * NO_SPREAD)
        left = {}
        for i in range(k + 1, n_features):
            share = F.col(cells[k, i]) / pivot
            for j in range(i, n_features + 1):
                kept = F.col(cells[i, j])
                left[cells[i, j]] = F.when(F.col(f"use_{k}"), kept - share * F.col(cells[k, j])).otherwise(kept)
        if left:
            rows = rows.withColumns(left)
    for k in reversed(range(n_features)):
        rest = F.col(cells[k, n_features])
        for j in range(k + 1, n_features):
            rest = rest - F.col(cells[k, j]) * F.col(f"slope_{j}")
        rows = rows.withColumn(f"slope_{k}", F.when(F.col(f"use_{k}"), rest / F.col(cells[k, k])).otherwise(0.0))
    intercept = F.col("s_y") / F.col("n")
    for k in range(n_features):
        intercept = intercept - F.col(f"slope_{k}") * F.col(f"s_x{k}") / F.col("n")
    return rows.select(*keys, "n", intercept.alias("intercept"), *[f"slope_{k}" for k in range(n_features)])


def fit(daily: DataFrame, target: str, features: Sequence[str], until: Column, keys: Sequence[str] = ("dept",), day: str = "obs_date") -> DataFrame:
    """Coefficients per key from all pairs of days whose later day is before ``until``. One aggregate, one row per key."""
    pairs = next_days(daily, target, features, keys, day).filter(F.date_add(F.col(day), 1) < until)
    return solved(sufficient_sums(pairs, len(features), keys), len(features), keys)


def predicted(pairs: DataFrame, coefficients: DataFrame, n_features: int, keys: Sequence[str] = ("dept",)) -> DataFrame:
    """Pairs of days with ``forecast``; those of a key without coefficients are left out."""
    forecast = F.col("intercept")
    for k in range(n_features):
        forecast = forecast + F.col(f"slope_{k}") * F.col(f"x{k}")
    joined = pairs.join(coefficients.drop("n"), list(keys))
    return joined.withColumn("forecast", forecast).drop("intercept", *[f"slope_{k}" for k in range(n_features)])


def skill(
    daily: DataFrame, target: str, features: Sequence[str], since: Column, keys: Sequence[str] = ("dept",), day: str = "obs_date"
) -> DataFrame:
    """Mean absolute error per key on the days from ``since`` on, of the fit on all days before and of persistence.

    Persistence says that tomorrow is as today. ``better`` tells whether the fit has the smaller error.
    """
    coefficients = fit(daily, target, features, since, keys, day)
    later = next_days(daily, target, features, keys, day).filter(F.date_add(F.col(day), 1) >= since)
    judged = predicted(later, coefficients, len(features), keys)
    errors = judged.groupBy(*keys).agg(
        F.count("*").alias("n_days"), stable_round(F.avg(F.abs(F.col("forecast") - F.col("y"))), 3).alias("mae_fit"),
        stable_round(F.avg(F.abs(F.col("today") - F.col("y"))), 3).alias("mae_persistence"))
    return errors.withColumn("better", F.col("mae_fit") < F.col("mae_persistence"))
