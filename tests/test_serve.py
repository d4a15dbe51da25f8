"""Serving frames, maps, profiles and lots."""

import json
import math
from datetime import date

import numpy as np
import pytest
from conftest import day, rows_of
from pyspark.sql import functions as F

from wxlake.functions import geo
from wxlake.operators import lots, maps, profile, serve


def test_neighbour_days_cross_years(spark):
    days = ["2023-12-30", "2024-01-02", "2024-01-05", "2026-07-01"]
    found = serve.neighbour_days(spark.createDataFrame([(day(d),) for d in days * 2], "obs_date date"))
    expected = [(day(d), day(p) if p else None, day(n) if n else None)
                for p, d, n in zip([None, *days], days, [*days[1:], None])]
    assert rows_of(found) == sorted(expected, key=repr)


def test_days_of_year(spark):
    days = spark.createDataFrame([(day(d),) for d in ("2023-12-30", "2024-01-02", "2024-03-01", "2024-03-01")], "obs_date date")
    assert rows_of(serve.days_of_year(days, 2024)) == [(2024, day("2024-01-02"), day("2024-03-01"), 2)]


def test_trailing_days_include_both_ends(spark):
    df = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-02-10')) AS obs_date")
    assert serve.trailing_days(df, "obs_date", 30).count() == 31


def test_month_ranking_default_and_given(spark):
    df = spark.createDataFrame([(2023, 12, "01", 1), (2024, 2, "01", 2), (2024, 2, "02", 1)],
                               "year int, month int, dept string, gloom_rank int")
    assert [r.dept for r in serve.month_ranking(df).collect()] == ["02", "01"]
    assert serve.month_ranking(df, 2023, 12).count() == 1


def test_preview_falls_back_to_first_rows(spark):
    df = spark.createDataFrame([(i, f"Station {i}") for i in range(20)], "id int, name string")
    assert [r.id for r in serve.preview(df, "name", "STATION 1", ["id"]).collect()] == [1, 10, 11, 12, 13, 14, 15, 16]
    assert [r.id for r in serve.preview(df, "name", "none", ["id"]).collect()] == [0, 1, 2, 3, 4]


def test_records_keep_missing_values(spark):
    df = spark.createDataFrame([(day("2024-01-02"), None, float("nan"))], "d date, label string, x double")
    assert json.loads(serve.json_records(df).collect()[0][0]) == {"d": "2024-01-02", "label": None, "x": None}


def test_series_pivot_has_every_chart_city(spark):
    df = spark.createDataFrame([(day("2024-01-02"), "Paris", 5.0), (day("2024-01-03"), "Nancy", 7.0)],
                               "obs_date date, city string, gloom double")
    assert rows_of(serve.series_pivot(df)) == [
        (day("2024-01-02"), None, None, 5.0, None), (day("2024-01-03"), None, None, None, None)]


def test_interpolation_matches_direct_sums(spark):
    values = {"Paris": 3.0, "Nice": 9.0, "Lille": -2.0, "Nancy": 99.0}
    daily = spark.createDataFrame([(day("2024-01-02"), c, v) for c, v in values.items()] + [(day("2024-01-03"), "Nice", None)],
                                  "obs_date date, city string, t double")
    found = maps.interpolate(maps.featured_values(daily, "t"), 4, 3).collect()
    assert len(found) == 12  # the day without any value draws nothing
    places = {"Paris": (48.8566, 2.3522), "Nice": (43.7102, 7.2620), "Lille": (50.6292, 3.0573)}

    def mercator(lat):
        return math.log(math.tan(math.pi / 4 + math.radians(lat) / 2))

    for r in found:
        y = mercator(51.4) + r.row / 3 * (mercator(41.2) - mercator(51.4))
        lat = math.degrees(math.atan(math.exp(y))) * 2 - 90
        lon = -5.6 + r.col / 2 * 15.6
        weights = {c: (math.hypot(lat - a, (lon - o) * math.cos(math.radians(46.5))) + 0.05) ** -2.5 for c, (a, o) in places.items()}
        expected = sum(w * values[c] for c, w in weights.items()) / sum(weights.values())
        assert r.value == pytest.approx(expected, abs=6e-4) and r.lat == pytest.approx(lat, abs=1e-4)


def test_legend_bounds(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 10.0), ("b", -1.0), ("b", -1.0), ("c", None)], "k string, v double")
    bounds = {r.k: (r.vmin, r.vmax) for r in maps.legend_bounds(df, ["k"], "v", 0.15).collect()}
    assert bounds == {"a": (0.0, 11.5), "b": (-1.5, -0.5), "c": (None, None)}
    scaled = maps.min_max_scale(df, ["k"], "v")
    assert scaled.count() == 4 and scaled.filter("scaled < 0 or scaled > 1").count() == 0


def test_grid_source_choice(spark):
    days = spark.createDataFrame([(day(d),) for d in ("2024-01-02", "2024-01-03", "2024-02-01")], "obs_date date")
    daily = spark.createDataFrame([(day("2024-01-02"),)] * 3, "obs_date date")
    monthly = spark.createDataFrame([(2024, 1)] * 2, "year int, month int")
    assert rows_of(maps.grid_source_by_day(days, daily, monthly)) == [
        (day("2024-01-02"), "grid_daily", 3), (day("2024-01-03"), "grid_monthly", 2), (day("2024-02-01"), "stations", 0)]


def test_mercator_round_trip(spark):
    lat = spark.range(42, 52).select(F.col("id").cast("double").alias("lat"))
    back = lat.select("lat", geo.inverse_mercator(geo.mercator(F.col("lat"))).alias("b")).collect()
    assert all(r.lat == pytest.approx(r.b) for r in back)


def test_national_mean_skips_missing(spark):
    df = spark.createDataFrame([(20.0,), (40.0,), (None,), (float("nan"),)], "g double")
    assert rows_of(serve.national_mean(df, "g")) == [(30.0, "sky-nuageux")]


@pytest.mark.parametrize("shape", ["hot", "spread", "outlier", "single"])
@pytest.mark.parametrize("margin", [5e-4, 0.0, 0.2])
def test_exact_quantiles_match_numpy(spark, shape, margin):
    rng = np.random.default_rng(7)
    values = {
        "hot": np.concatenate([np.full(4000, 5.0), rng.normal(size=6000)]),
        "spread": rng.normal(size=5001), "outlier": np.append(rng.random(1000), 1e12), "single": np.array([3.5]),
    }[shape]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    p = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
    found = {r.p: r.quantile for r in profile.exact_quantiles(df, ["x"], p, margin).collect()}
    for q in p:
        assert found[q] == pytest.approx(float(np.quantile(values, q)), rel=1e-12), (shape, q)


def test_describe_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    assert rows_of(profile.describe(df, ["a", "b"]), "column", "n", "mean", "std", "median") == [
        ("a", 0, None, None, None), ("b", 2, 2.0, 1.41, 2.0)]


def test_fill_rate_and_value_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None), (1, 2)], "a int, b int")
    assert rows_of(profile.fill_rate(df, ["a", "b"])) == [("a", 66.7), ("b", 33.3)]
    assert rows_of(profile.value_counts(df, "a")) == [(1, 2), (None, 1)]


def test_daily_lots_cover_the_range(spark):
    plan = lots.plan_daily_lots(spark, date(1949, 6, 1), date(2025, 8, 1), date(2025, 7, 1))
    assert plan.count() == 95 * 2 * 3
    assert rows_of(plan.filter("dept = '01' AND family = 'RR-T-Vent'"), "period", "snapshot") == [
        ("avant-1949", None), ("latest-2025-2026", day("2025-07-01")), ("previous-1950-2024", None)]
    assert rows_of(lots.plan_daily_lots(spark, date(2024, 1, 1), date(2024, 2, 1), date(2026, 1, 1)).select("period").distinct()) == [("previous-1950-2024",)]
    with pytest.raises(ValueError):
        lots.plan_daily_lots(spark, date(2024, 2, 1), date(2024, 1, 1), date(2026, 1, 1))


def test_inverted_request_fails(spark):
    bad = spark.createDataFrame([("01", day("2024-02-01"), day("2024-01-01"), day("2024-03-01"))], "dept string, start date, end date, run_day date")
    with pytest.raises(Exception, match="end is before start"):
        lots.daily_lots(bad).collect()


def test_pending_lots(spark):
    planned = spark.createDataFrame([("01", None), ("01", "s"), ("02", None)], "dept string, snapshot string")
    present = spark.createDataFrame([("01", None)], "dept string, snapshot string")
    key = ["dept", "snapshot"]
    assert rows_of(lots.pending_lots(planned, present, key)) == [("01", "s"), ("02", None)]
    assert lots.pending_lots(planned, present, key, force=True).count() == 3


def test_hourly_and_grid_lots(spark):
    assert lots.plan_hourly_lots(spark, date(2026, 1, 2)).count() == 10
    plan = rows_of(lots.plan_grid_lots(spark, 2024, date(2026, 1, 2)), "kind", "year", "snapshot")
    assert plan == sorted([("grille", None, None), ("mens", 2024, None), ("mens", 2025, None),
                           ("mens", 2026, day("2026-01-02")), ("quot_latest", None, day("2026-01-02"))], key=repr)


def test_first_production(spark):
    wanted = [lots.ALERT_FILE]
    tree = {"2024": {"01": {"01": {"060000": ["x"], "080000": wanted, "100000": wanted}, "02": {"060000": ["x"]},
                            "03": {"060000": wanted}}, "02": {"01": {"070000": wanted}}}}
    df = spark.createDataFrame([(json.dumps(tree),)], "tree string")
    assert rows_of(lots.first_production(df)) == [
        (day("2024-01-01"), "080000"), (day("2024-01-03"), "060000"), (day("2024-02-01"), "070000")]
    assert rows_of(lots.first_production(df, run_day=date(2024, 1, 3))) == [
        (day("2024-01-01"), "080000"), (day("2024-01-03"), "060000")]
