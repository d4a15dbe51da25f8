"""Runs of days, comparison of sources, alerts."""

import random
from datetime import date

import pytest
from conftest import day, moment, rows_of
from pyspark.sql import functions as F

from wxlake import schemas
from wxlake.operators import alerts, compare, episodes


def daily(spark, rows):
    return spark.createDataFrame(rows, (
        "dept string, city string, obs_date date, temp_min double, precip_mm double, gust_ms double"))


def cold(dates, dept="59", value=-1.0):
    return [(dept, "Lille", day(d), value, None, None) for d in dates]


def test_run_of_three_and_none_of_two(spark):
    dates = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-05", "2024-01-06"]
    found = episodes.detect_runs(daily(spark, cold(dates)))
    assert rows_of(found) == [("59", "Lille", "cold_spell", day("2024-01-01"), day("2024-01-03"), 3, -1.0)]


def test_run_across_the_year_end_and_per_area(spark):
    dates = ["2023-12-30", "2023-12-31", "2024-01-01"]
    found = episodes.detect_runs(daily(spark, cold(dates) + cold(dates[:2], "75")))
    assert rows_of(found, "dept", "start_date", "n_days") == [("59", day("2023-12-30"), 3)]


def test_repeated_day_does_not_split_a_run(spark):
    dates = ["2024-01-01", "2024-01-02", "2024-01-02", "2024-01-03"]
    assert rows_of(episodes.detect_runs(daily(spark, cold(dates))), "n_days") == [(3,)]


def test_intensity_of_each_type(spark):
    rows = [("59", "Lille", day(f"2024-01-0{i}"), -float(i), 5.0 + i, 18.0 + i) for i in (1, 2, 3)]
    found = episodes.detect_runs(daily(spark, rows))
    assert rows_of(found, "type", "n_days", "intensity") == [
        ("cold_spell", 3, -3.0), ("rain_spell", 3, 21.0), ("wind_gust", 2, 21.0)]


def test_run_lengths_sum_to_flagged_days(spark):
    rows = spark.range(4000).select(
        (F.col("id") % 4).cast("string").alias("dept"), F.lit("x").alias("city"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") / 4).cast("int")).alias("obs_date"),
        F.lit(None).cast("double").alias("temp_min"), F.lit(None).cast("double").alias("precip_mm"),
        (F.abs(F.hash("id")) % 30).cast("double").alias("gust_ms"))
    total = episodes.detect_runs(rows).agg(F.sum("n_days")).collect()[0][0]
    assert total == rows.filter("gust_ms >= 20").count()


@pytest.mark.parametrize("seed", range(4))
def test_islands_match_brute_force(spark, seed):
    rng = random.Random(seed)
    start = day("1999-11-01").toordinal()
    days = {(k, start + i) for k in "ab" for i in range(150) if rng.random() < 0.7}
    expected = []
    for key, first in sorted(days):
        if (key, first - 1) not in days:
            last = first
            while (key, last + 1) in days:
                last += 1
            expected.append((key, date.fromordinal(first), date.fromordinal(last), last - first + 1, last - first + 1))
    df = spark.createDataFrame([(k, date.fromordinal(d)) for k, d in days], "k string, d date")
    found = episodes.islands(df, ["k"], "d", [F.count("*").alias("n")])
    assert rows_of(found, "k", "start_date", "end_date", "n_days", "n") == sorted(expected, key=repr)


def hourly(spark, rows):
    return spark.createDataFrame(rows, "dept string, station_id string, elevation double, obs_ts timestamp, temp double, precip_mm double")


def test_day_boundaries(spark):
    times = ["2024-01-02 00:00", "2024-01-02 00:01", "2024-01-02 06:00", "2024-01-02 06:01", "2024-01-02 07:00"]
    rows = [("59", "s", 10.0, moment(t), float(i), 10.0 * i) for i, t in enumerate(times)]
    keyed = compare.by_met_day(hourly(spark, rows), "obs_ts", "temp", "precip_mm")
    temp = rows_of(keyed.filter("temp is not null"), "temp", "obs_day")
    rain = rows_of(keyed.filter("rain is not null"), "rain", "obs_day")
    first, second = day("2024-01-01"), day("2024-01-02")
    assert temp == [(0.0, first)] + [(float(i), second) for i in (1, 2, 3, 4)]
    assert sorted(rain) == [(0.0, first), (10.0, first), (20.0, first), (30.0, second), (40.0, second)]


def full_day(station, hours, temp, rain, elevation=10.0):
    """Hourly rows from 01:00 on the first day."""
    return [("59", station, elevation, moment(f"2024-01-0{1 + (h // 24)} {h % 24:02d}:00"), temp, rain)
            for h in range(1, hours + 1)]


def test_stations_need_twenty_hours_and_low_ground(spark):
    rows = full_day("a", 20, 5.0, 1.0) + full_day("b", 19, 50.0, 9.0) + full_day("c", 24, 90.0, 9.0, 301.0)
    found = compare.official_days(hourly(spark, rows)).collect()
    assert [(r.obs_day, r.temp_off, r.n_hours, r.precip_off) for r in found] == [(day("2024-01-01"), 5.0, 20, None)]


def test_rain_of_a_complete_day(spark):
    # 01:00 to 06:00 belong to the rain of the day before, so 24 more hours complete the day.
    rows = full_day("a", 30, 5.0, 0.5)
    found = {r.obs_day: r for r in compare.official_days(hourly(spark, rows)).collect()}
    assert list(found) == [day("2024-01-01")]
    assert found[day("2024-01-01")].precip_off == 12.0


def test_live_day_and_reliability(spark):
    quarter = [("live", "59", moment(f"2024-01-01 {m // 60:02d}:{m % 60:02d}"), 7.0, 2.0) for m in range(15, 1440, 15)]
    obs = spark.createDataFrame(quarter, "source string, dept string, obs_time timestamp, temperature double, precipitation_mm double")
    live = compare.live_days(obs)
    row = live.collect()[0]
    assert (row.n_points, row.temp_live) == (95, 7.0)
    assert row.precip_live == 71 * 2.0 / 4  # 06:15 to 23:45
    official = spark.createDataFrame([("59", day("2024-01-01"), 6.5, 24, 30.0)],
                                     "dept string, obs_day date, temp_off double, n_hours bigint, precip_off double")
    compared = compare.live_vs_official(live, official)
    assert rows_of(compared, "city", "diff_temp", "diff_precip") == [("Lille", 0.5, 5.5)]
    assert rows_of(compare.live_reliability(compared), "mae_temp", "bias_temp", "mae_precip", "n_days_compared") == [(0.5, 0.5, 5.5, 1)]
    assert compare.live_days(obs.limit(79)).count() == 0
    assert compare.live_days(obs, min_points_rain=96).collect()[0].precip_live is None


def runs(spark, rows):
    return spark.createDataFrame(
        [(d, "x", t, day(a), day(z), n, 1.0) for d, t, a, z, n in rows], schemas.ddl(schemas.EPISODES))


def alert_rows(spark, rows):
    return spark.createDataFrame([(day(d), a, 4, p, c, None) for d, a, p, c in rows], schemas.ddl(schemas.ALERTS))


def test_status_order(spark):
    found = alerts.check_runs(
        runs(spark, [
            ("59", "rain_spell", "2022-11-25", "2022-11-27", 3), ("59", "rain_spell", "2023-03-01", "2023-03-03", 3),
            ("59", "wind_gust", "2024-01-01", "2024-01-02", 2), ("59", "rain_spell", "2024-01-01", "2024-01-03", 3)]),
        alert_rows(spark, [
            ("2024-01-01", "59", 1, 2), ("2024-01-02", "59", 1, 1), ("2024-01-03", "75", 1, 4),
            ("2024-01-02", "59", 2, 3), ("2024-01-01", "59", 2, 1)]),
    )
    assert rows_of(found, "type", "start_date", "alert_days", "coverage_rate", "max_color", "status") == sorted([
        ("rain_spell", day("2022-11-25"), 0, 0.0, None, "out_of_archive"),
        ("rain_spell", day("2023-03-01"), 0, 0.0, None, "not_evaluated"),
        ("wind_gust", day("2024-01-01"), 1, 0.5, "jaune", "confirmed"),
        ("rain_spell", day("2024-01-01"), 1, 0.33, "orange", "not_confirmed")], key=repr)


def test_highest_color_of_several_periods_and_area_alias(spark):
    rows = alert_rows(spark, [("2024-01-01", "2A", 2, 2), ("2024-01-01", "2B", 2, 3), ("2024-01-01", "20", 2, 1)])
    assert rows_of(alerts.max_alert_per_day(rows)) == [(day("2024-01-01"), "20", 2, 3)]
    checked = alerts.check_runs(runs(spark, [("20", "rain_spell", "2024-01-01", "2024-01-01", 1)]), rows)
    assert rows_of(checked, "max_color", "status") == [("orange", "confirmed")]
