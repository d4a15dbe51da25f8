"""Index, roll-ups and rankings."""

import pytest
from conftest import day, rows_of
from pyspark.sql import functions as F

from wxlake import schemas
from wxlake.dimensions import AREA_CITY, FEATURED
from wxlake.functions import index, labels
from wxlake.functions.numbers import clamp01, stable_round
from wxlake.operators import ranking, rollup

OBS = schemas.ddl({k: schemas.OBSERVATIONS[k] for k in (
    "source", "station_id", "dept", "elevation", "obs_date", "temperature", "temp_min", "temp_max",
    "precipitation_mm", "wind_speed_ms", "sunshine_min", "humidity_pct", "fog")})


def observations(spark, rows):
    """Rows given as dicts on top of a lowland station with no measures."""
    names = [c.split("`")[1] for c in OBS.split(", ")]
    base = {"source": "official", "station_id": "59000001", "dept": "59", "elevation": 20.0,
            "obs_date": day("2026-01-09")}
    data = [tuple({**base, **r}.get(n) for n in names) for r in rows]
    return schemas.conform(spark.createDataFrame(data, OBS), schemas.OBSERVATIONS)


def test_all_measures_missing_gives_half_dark(spark):
    found = rollup.area_daily(observations(spark, [{}]))
    row = found.collect()[0]
    assert (row.c_cold, row.c_dark, row.c_rain, row.c_wind, row.c_humid) == (0, 0.5, 0, 0, 0)
    assert row.gloom == 12.5 and row.city == "Lille" and row.n_stations == 1
    missing = rollup.area_daily(observations(spark, [{}]), renormalise_missing=True)
    assert missing.collect()[0].gloom is None


def test_known_worst_day(spark):
    """3.8 degrees, 17.7 mm, no sun, 10.7 m/s and about 92 % humidity score 81.8."""
    rows = [{"temperature": 3.8, "precipitation_mm": 17.7, "sunshine_min": 0.0,
             "wind_speed_ms": 10.7, "humidity_pct": 91.6}]
    assert rollup.area_daily(observations(spark, rows)).collect()[0].gloom == 81.8


def test_elevation_limit_is_inclusive_and_needs_a_value(spark):
    rows = [{"station_id": str(e), "elevation": e, "temperature": 10.0} for e in (300.0, 301.0, None)]
    assert rollup.area_daily(observations(spark, rows)).collect()[0].n_stations == 1


def test_mean_temperature_falls_back_to_extremes(spark):
    rows = [{"temp_min": -2.0, "temp_max": 4.0}]
    assert rollup.area_daily(observations(spark, rows)).collect()[0].temp_avg == 1.0


def test_dark_prefers_sunshine_then_fog(spark):
    rows = [
        {"obs_date": day("2026-01-01"), "sunshine_min": 180.0, "fog": 1.0},
        {"obs_date": day("2026-01-02"), "fog": 1.0}, {"obs_date": day("2026-01-03")},
    ]
    found = rollup.area_daily(observations(spark, rows))
    assert [r.c_dark for r in found.orderBy("obs_date").collect()] == [0.5, 1.0, 0.5]


def test_unknown_area_has_no_city(spark):
    assert rollup.area_daily(observations(spark, [{"dept": "99"}])).collect()[0].city is None


def test_grid_cells_and_partial_index(spark):
    rows = [("monthly", x, 0, day("2024-01-01"), t, 600.0, None, None, None, 45.0, 5.0, 2024, 1)
            for x, t in ((0, 5.0), (159, -5.0), (160, 15.0))]
    grid = spark.createDataFrame(rows, schemas.ddl({
        **schemas.GRID, "lat": "double", "lon": "double", "year": "int", "month": "int"}))
    found = rollup.cell_monthly(grid)
    # Cold 0.75 and full rain; the weights sum to 0.55.
    assert rows_of(found, "cellx", "temp", "gloom_partial") == [(240, 15.0, 45.5), (80, 0.0, 86.4)]


@pytest.mark.parametrize("years, expected", [("", [2024]), ("2022", [2022]), ("2021-2022", [2021, 2022])])
def test_in_years(spark, years, expected):
    df = spark.createDataFrame([(y,) for y in (2021, 2022, 2024)], "year int")
    assert [r[0] for r in rollup.in_years(df, years).orderBy("year").collect()] == expected


def daily(spark, rows):
    """Daily index rows (dept, date, gloom, rain)."""
    df = spark.createDataFrame(rows, "dept string, obs_date date, gloom double, precip_mm double")
    return rollup.with_city(df).withColumns({
        "temp_avg": F.lit(10.0), "sunshine_min": F.lit(None).cast("double"),
        "year": F.year("obs_date"), "month": F.month("obs_date")})


def test_ranks_share_ties_and_leave_gaps(spark):
    rows = [(d, day("2026-01-01"), g, 1.0) for d, g in (("01", 50.0), ("02", 70.0), ("03", 50.0), ("04", None))]
    monthly = ranking.monthly_ranking(daily(spark, rows))
    expected = [("01", 2), ("02", 1), ("03", 2), ("04", 4)]
    assert rows_of(monthly, "dept", "gloom_rank") == expected
    by_count = ranking.rank_by_score(daily(spark, rows), "gloom", "place")
    assert rows_of(by_count, "dept", "place") == expected


def test_rank_by_score_equals_window_rank(spark):
    df = spark.range(3000).select(
        (F.col("id") % 3).alias("g"), F.when(F.col("id") % 50 != 0, (F.hash("id") % 40).cast("double")).alias("s"), "id")
    both = ranking.rank_by_score(ranking.rank_within(df, ["g"], "s", "a"), "s", "b", ["g"])
    assert both.count() == 3000
    assert both.filter("a <> b").count() == 0


def test_periods_follow_the_last_day(spark):
    dates = ["2026-03-02", "2026-03-01", "2026-01-01", "2022-05-05", "2021-12-31", "2017-01-01", "2016-12-31"]
    podiums = ranking.period_podiums(daily(spark, [("75", day(d), 40.0, 2.0) for d in dates]))
    assert rows_of(podiums, "period_type", "period_label", "n_days", "rain_total_mm", "gloom_rank") == sorted([
        ("month", "2026-03", 2, 4.0, 1), ("year", "2026", 3, 6.0, 1),
        ("5years", "2022-2026", 4, 8.0, 1), ("10years", "2017-2026", 6, 12.0, 1)], key=repr)


def test_area_absent_from_a_period_is_not_listed(spark):
    rows = [("75", day("2026-03-02"), 40.0, 2.0), ("59", day("2020-01-01"), 60.0, 2.0)]
    found = ranking.period_podiums(daily(spark, rows))
    assert rows_of(found.filter("dept = '59'"), "period_type", "gloom_rank") == [("10years", 1)]


def test_annual_rain(spark):
    rows = [("75", "month", 40.0, 31), ("75", "5years", 730.5, 731)]
    df = spark.createDataFrame(rows, "dept string, period_type string, rain_total_mm double, n_days bigint")
    assert rows_of(ranking.annual_rain(df), "period_type", "rain_shown_mm") == [("5years", 365.0), ("month", 40.0)]


def test_worst_days_keep_ties(spark):
    rows = [("75", day(f"2026-01-0{i}"), g, 0.0) for i, g in ((1, 70.0), (2, 70.0), (3, 10.0))]
    assert rows_of(ranking.worst_days(daily(spark, rows)), "obs_date") == [(day("2026-01-01"),), (day("2026-01-02"),)]


def test_podium_split(spark):
    rows = [(str(i), "year", i) for i in range(1, 20)]
    df = spark.createDataFrame(rows, "dept string, period_type string, gloom_rank int")
    parts = dict(ranking.podium_split(df).groupBy("part").count().collect())
    assert parts == {"podium": 3, "listed": 12, "others": 4}


def test_rerank_of_featured_cities_puts_missing_last(spark):
    rows = [("75", day("2026-01-01"), None, 0.0), ("59", day("2026-01-01"), 0.0, 0.0), ("01", day("2026-01-01"), 90.0, 0.0)]
    assert rows_of(ranking.rerank_selected(daily(spark, rows)), "city", "place") == [("Lille", 1), ("Paris", 2)]


def test_stable_round_absorbs_noise(spark):
    df = spark.createDataFrame([(52.349999999999994,), (1.005,), (-0.25,), (None,), (1e30,), (float("nan"),)], "x double")
    values = [r[0] for r in df.select(stable_round(F.col("x"), 1)).collect()]
    assert values[:5] == [52.4, 1.0, -0.3, None, 1e30] and values[5] != values[5]


def test_clamp_of_null_is_zero(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (0.4,), (7.0,)], "x double")
    assert [r[0] for r in df.select(clamp01(F.col("x"))).collect()] == [0.0, 0.0, 0.4, 1.0]


def test_index_stays_between_0_and_100(spark):
    df = spark.range(2000).select(*[
        (F.randn(seed) * 60).alias(c) for seed, c in enumerate(("t", "s", "f", "p", "w", "h"))])
    parts = index.daily_components(*[F.col(c) for c in ("t", "s", "f", "p", "w", "h")])
    ends = index.with_index(df, parts, "g").agg(F.min("g"), F.max("g")).collect()[0]
    assert 0 <= ends[0] and ends[1] <= 100


def test_labels(spark):
    df = spark.createDataFrame([(24.9, 44, 0.49, 20), (25.0, 45, 0.5, 21), (65.0, 47, 1.5, 91), (None, None, None, None)],
                               "score double, code int, mae double, age int")
    found = df.select(labels.score_color(F.col("score")), labels.weather_symbol(F.col("code")),
                      labels.reliability(F.col("mae")), labels.freshness(F.col("age")), labels.sky(F.col("score")))
    assert [tuple(r) for r in found.collect()] == [
        ("#0ca30c", "☁️", "fiable", "fresh", "sky-soleil"), ("#fab219", "🌫️", "correct", "late", "sky-nuageux"),
        ("#6b4fae", "🌫️", "douteux", "stale", "sky-misere"), ("#0ca30c", "🌡️", None, None, None)]


def test_dimensions():
    assert len(AREA_CITY) == 95 and len(FEATURED) == 10
    assert all(AREA_CITY[dept] == city for city, dept, _, _ in FEATURED)
