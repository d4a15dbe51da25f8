"""Maps from any number of stations: blocks of weights times blocks of readings."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxlake.functions import geo
from wxlake.functions.numbers import stable_round
from wxlake.session import fresh_folder

#: Pixels, stations and days of a block: a block of weights has 1 MB, one of readings 128 KB, a product 1 MB.
PIXELS, STATIONS, DAYS = 512, 256, 64

WEIGHTS = "pixel_block int, station_block int, names array<string>, weights binary"
READINGS = "day_block int, station_block int, names array<string>, readings binary"
PRODUCTS = "day int, pixel int, weighted double, weight double"


def pixel_places(pixels: np.ndarray, rows: int, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """Latitude and longitude of pixels, numbered by row from the north and column from the west."""
    top, bottom = (math.log(math.tan(math.pi / 4 + math.radians(lat) / 2)) for lat in (geo.NORTH, geo.SOUTH))
    row, column = pixels // columns, pixels % columns
    lat = np.degrees(np.arctan(np.exp(top + row / (rows - 1) * (bottom - top)))) * 2 - 90
    return lat, geo.WEST + column / (columns - 1) * (geo.EAST - geo.WEST)


def weight_blocks(stations: DataFrame, rows: int, columns: int, station_blocks: int, pixels: int = PIXELS) -> DataFrame:
    """Inverse-distance weights of stations (station, lat, lon) at all pixels, a row for each block of both."""
    count = rows * columns

    def weigh(key, block):
        order = np.argsort(block.column("station").to_numpy(zero_copy_only=False).astype(str), kind="stable")
        names = block.column("station").take(pa.array(order)).to_pylist()
        lat, lon = (block.column(c).to_numpy()[order] for c in ("lat", "lon"))
        own = np.arange(key[0].as_py() * pixels, min(count, (key[0].as_py() + 1) * pixels))
        at_lat, at_lon = pixel_places(own, rows, columns)
        distance = np.hypot(at_lat[:, None] - lat, (at_lon[:, None] - lon) * geo.COS_MID_LATITUDE) + geo.IDW_OFFSET
        return pa.table({
            "pixel_block": pa.array([key[0].as_py()], pa.int32()), "station_block": pa.array([key[1].as_py()], pa.int32()),
            "names": pa.array([names], pa.list_(pa.string())), "weights": [(distance**-geo.IDW_POWER).tobytes()]})

    blocks = F.sequence(F.lit(0), F.lit(-(-count // pixels) - 1))
    dealt = stations.select("station", "lat", "lon", _block_of(station_blocks)).withColumn("pixel_block", F.explode(blocks))
    return dealt.groupBy("pixel_block", "station_block").applyInArrow(weigh, WEIGHTS)


def _block_of(station_blocks: int):
    return F.pmod(F.xxhash64("station"), F.lit(station_blocks)).cast("int").alias("station_block")


def reading_blocks(readings: DataFrame, station_blocks: int, days: int = DAYS) -> DataFrame:
    """Readings (day number, station, value), one for a day and station, as matrices with gaps, one row for each block."""

    def gather(block):
        names, place = np.unique(block.column("station").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        number = block.column("day").to_numpy()
        matrix = np.full((days, len(names)), np.nan)
        matrix[number % days, place] = block.column("value").to_numpy()
        return pa.table({
            "day_block": pa.array([number[0] // days], pa.int32()), "station_block": block.column("station_block").slice(0, 1),
            "names": pa.array([names.tolist()], pa.list_(pa.string())), "readings": [matrix.tobytes()]})

    dealt = readings.select("day", "station", "value", _block_of(station_blocks), F.floor(F.col("day") / days).alias("day_block"))
    return dealt.groupBy("day_block", "station_block").applyInArrow(gather, READINGS)


def _products(days: int, pixels: int):
    def multiply(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in ("pixel_block", "day_block", "weights", "readings")}
                known, present = (batch.column(c)[i].values.to_numpy(zero_copy_only=False).astype(str) for c in ("names", "present"))
                weights = np.frombuffer(row["weights"].as_buffer()).reshape(-1, len(known))[:, np.searchsorted(known, present)]
                values = np.frombuffer(row["readings"].as_buffer()).reshape(days, -1)
                there = ~np.isnan(values)
                # A missing value takes its weight out of the second product.
                weighted, total = np.where(there, values, 0.0) @ weights.T, there.astype(float) @ weights.T
                some = np.flatnonzero(there.any(axis=1))
                n = weights.shape[0]
                yield pa.RecordBatch.from_pydict({
                    "day": pa.array(np.repeat(row["day_block"].as_py() * days + some, n), pa.int32()),
                    "pixel": pa.array(np.tile(row["pixel_block"].as_py() * pixels + np.arange(n), len(some)), pa.int32()),
                    "weighted": weighted[some].ravel(), "weight": total[some].ravel()})

    return multiply


def interpolate_stations(
    readings: DataFrame, stations: DataFrame, rows: int, columns: int, day: str = "obs_date", pixels: int = PIXELS,
    per_block: int = STATIONS, days: int = DAYS,
) -> DataFrame:
    """Inverse-distance map of each day, from all stations that have a value on it.

    ``readings``: day, ``station``, ``value``; ``stations``: ``station``, ``lat``, ``lon``, one row each. Several
    readings of a station and day count as their mean. NULL and NaN values, and stations without coordinates,
    take no part; days without any value are absent. At least two rows and columns.

    The weights of pixels and stations are computed once, in blocks, and written. Each meets the blocks of readings of
    its stations in an equi-join, is multiplied with them and with the pattern of what is there, and the
    products are summed over the blocks of stations. Tasks hold single blocks, whose bytes do not depend on the
    number of stations, pixels or days.
    """
    spark = readings.sparkSession
    placed = stations.filter("station IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL").select(
        F.col("station").cast("string").alias("station"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))
    station_blocks = max(1, -(-placed.count() // per_block))
    folder = fresh_folder(spark, "map-weights")
    weight_blocks(placed, rows, columns, station_blocks, pixels).write.parquet(folder)
    weights = spark.read.schema(WEIGHTS).parquet(folder)
    known = readings.filter(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double")) & F.col(day).isNotNull())
    means = known.select(F.unix_date(day).alias("day"), F.col("station").cast("string").alias("station"), "value").groupBy(
        "day", "station").agg(F.avg("value").cast("double").alias("value"))
    means = means.join(placed.select("station"), "station", "left_semi")
    blocks = reading_blocks(means, station_blocks, days).withColumn(
        "pixel_block", F.explode(F.sequence(F.lit(0), F.lit(-(-rows * columns // pixels) - 1))))
    met = weights.join(blocks.withColumnRenamed("names", "present"), ["pixel_block", "station_block"])
    sums = met.select("pixel_block", "day_block", "names", "weights", "present", "readings").mapInArrow(_products(days, pixels), PRODUCTS)
    maps = sums.groupBy("day", "pixel").agg(F.sum("weighted").alias("weighted"), F.sum("weight").alias("weight"))
    row, column = F.floor(F.col("pixel") / columns).cast("int"), (F.col("pixel") % columns).cast("int")
    return maps.select(
        F.date_from_unix_date("day").alias(day), row.alias("row"), column.alias("col"),
        stable_round(geo.row_latitude(row, rows), 4).alias("lat"), stable_round(geo.column_longitude(column, columns), 4).alias("lon"),
        stable_round(F.col("weighted") / F.col("weight"), 3).alias("value"))
