"""Maps from any number of stations."""

import datetime as dt
import random

import numpy as np
import pytest
from conftest import rows_of

from wxlake.functions import geo
from wxlake.operators import fields, maps
from wxlake.sources import layers

START = dt.date(2024, 1, 1)


def table(n_stations=40, n_days=100, seed=2):
    pick = random.Random(seed)
    stations = [(f"s{i}", 42 + 9 * pick.random(), -5 + 14 * pick.random()) for i in range(n_stations)]
    readings = [(START + dt.timedelta(days=d), s[0], pick.choice([None, float("nan"), pick.gauss(8, 4), pick.gauss(8, 4)]))
                for d in range(n_days) for s in stations if pick.random() < 0.7 and d != 50]
    readings += [(START, "s1", 3.0), (START, "unknown", 500.0), (START, "nowhere", 500.0), (None, "s1", 500.0)]
    return [*stations, ("nowhere", None, 3.0)], readings


def wanted(stations, readings, rows, columns):
    place = {s: (lat, lon) for s, lat, lon in stations if lat is not None}
    by_day = {}
    for day, station, value in readings:
        if day is not None and value is not None and value == value and station in place:
            by_day.setdefault(day, {}).setdefault(station, []).append(value)
    lat, lon = fields.pixel_places(np.arange(rows * columns), rows, columns)
    out = {}
    for day, own in by_day.items():
        for p in range(rows * columns):
            weights = {s: (np.hypot(lat[p] - place[s][0], (lon[p] - place[s][1]) * geo.COS_MID_LATITUDE) + geo.IDW_OFFSET) ** -geo.IDW_POWER for s in own}
            out[day, p // columns, p % columns] = sum(w * np.mean(own[s]) for s, w in weights.items()) / sum(weights.values())
    return out


@pytest.mark.parametrize("pixels, per_block, days", [(512, 256, 64), (7, 5, 9)])
def test_maps_equal_weighted_means(spark, pixels, per_block, days):
    stations, readings = table()
    found = fields.interpolate_stations(
        spark.createDataFrame(readings, "obs_date date, station string, value double"),
        spark.createDataFrame(stations, "station string, lat double, lon double"), 5, 4, pixels=pixels, per_block=per_block, days=days)
    expected = wanted(stations, readings, 5, 4)
    rows = {(r.obs_date, r.row, r.col): r.value for r in found.collect()}
    assert rows.keys() == expected.keys() and all(abs(rows[k] - v) <= 0.00051 for k, v in expected.items())


def test_few_stations_give_the_map_of_the_featured_cities(spark):
    daily = spark.createDataFrame([(START, "Lille", 3.0), (START, "Nice", 12.0), (START, "Brest", None)], "obs_date date, city string, temp_avg double")
    points = maps.featured_values(daily, "temp_avg")
    stations = points.selectExpr("city AS station", "lat", "lon")
    found = fields.interpolate_stations(points.selectExpr("obs_date", "city AS station", "value"), stations, 6, 5)
    assert rows_of(found) == rows_of(maps.interpolate(points, 6, 5))


def test_folder_values_without_opening_files(spark, tmp_path):
    for year, month in ((2023, 12), (2024, 1), (2024, 2)):
        folder = tmp_path / f"year={year}" / f"month={month}"
        folder.mkdir(parents=True)
        (folder / "part-0.parquet").write_text("no Parquet")  # reading it would fail
        (folder / "notes.txt").write_text("x")
    assert [tuple(r) for r in layers.folder_values(spark, str(tmp_path), ["year", "month"]).collect()] == [(2023, 12), (2024, 1), (2024, 2)]
    assert [r.year for r in layers.folder_values(spark, str(tmp_path), ["year"]).collect()] == [2023, 2024]


def test_blocks_are_bounded_and_empty_tables_have_no_map(spark):
    stations, readings = table(60, 3)
    placed = spark.createDataFrame(stations[:-1], "station string, lat double, lon double")
    for row in fields.weight_blocks(placed, 20, 20, 8, pixels=50).collect():
        assert len(row.weights) == 50 * len(row.names) * 8
    none = spark.createDataFrame([], "obs_date date, station string, value double")
    assert fields.interpolate_stations(none, placed, 5, 4).count() == 0
    some = spark.createDataFrame(readings, none.schema)
    assert fields.interpolate_stations(some, placed.limit(0), 5, 4).count() == 0
