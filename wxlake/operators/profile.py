"""Table profiles: fill rates, statistics, frequencies."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wxlake.functions.numbers import stable_round
from wxlake.session import fresh_folder

# Standard error of approximate distinct counts, as a share of the count.
RELATIVE_ERROR = 0.01
# Rows of a part that one task puts in order.
PART_ROWS = 100_000


def _long(df: DataFrame, values: dict) -> DataFrame:
    """One row per entry of a one-row frame."""
    rows = F.array(*[F.struct(F.lit(k).alias("column"), v.alias("value")) for k, v in values.items()])
    return df.select(F.inline(rows))


def fill_rate(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Percent of non-NULL values per column, one decimal, in one aggregate."""
    counts = df.agg(F.count("*").alias("_all"), *[F.count(c).alias(c) for c in columns])
    share = {c: stable_round(F.try_divide(F.col(c) * 100.0, F.col("_all")), 1) for c in columns}
    return _long(counts, share).withColumnRenamed("value", "fill_pct")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each value; missing values have their own row."""
    return df.groupBy(column).agg(F.count("*").alias("n"))


def distinct_count(
    df: DataFrame, column: str, keys: Sequence[str] = (), approx: bool = False, error: float = RELATIVE_ERROR
) -> DataFrame:
    """Distinct values per key, exact or by a sketch.

    The sketch's standard error is ``error`` of a count, at most. Below a few hundred values (more with a smaller
    error) it holds the values' hashes, so the count of a small group is exact. Its size is bounded, and sketches of
    other rows can be merged.
    """
    if not approx:
        return df.groupBy(*keys).agg(F.count_distinct(F.col(column)).alias("n_distinct"))
    bits = min(21, max(4, math.ceil(2 * math.log2(1.04 / error))))
    text = F.col(column).cast("string")
    # A group without values has a NULL sketch.
    count = F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(text, F.lit(bits))), F.lit(0).cast("bigint"))
    return df.groupBy(*keys).agg(count.alias("n_distinct"))


def min_max_distinct(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(column).alias("lowest"), F.max(column).alias("highest"),
        F.count_distinct(column).alias("n_distinct"),
    )


def area_month_profile(obs: DataFrame) -> DataFrame:
    """Profile per area and month; rain is the mean day times the days of the month."""
    days = F.day(F.last_day(F.make_date("year", "month", F.lit(1))))
    return _with_month(obs).groupBy("year", "month", "dept").agg(
        stable_round(F.avg("temperature"), 1).alias("mean_temp"),
        stable_round(F.min("temp_min"), 1).alias("lowest_temp"),
        stable_round(F.max("temp_max"), 1).alias("highest_temp"),
        stable_round(F.avg("precipitation_mm") * days, 1).alias("rain_mm"),
        F.count_if(F.coalesce(F.col("frost_min"), F.lit(0.0)) > 0).alias("frost_days"),
    )


def _with_month(obs: DataFrame) -> DataFrame:
    return obs.withColumns({"year": F.year("obs_date"), "month": F.month("obs_date")})


def _below(rows: DataFrame, label: str) -> DataFrame:
    """``below`` plus the counts ``n`` of all smaller values of the same range.

    Rows are dealt by range into parts of about ``PART_ROWS`` and written with the
    number of their part, as the bounds are sampled. A part is summed by itself, and
    the parts' totals give its offset, so no task sorts a whole range.
    """
    spark = rows.sparkSession
    path = fresh_folder(spark, label)
    rows.write.parquet(f"{path}/rows")
    rows = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    parts = max(1, -(-rows.count() // PART_ROWS))
    dealt = rows.repartitionByRange(parts, "column", "range", "value").withColumn("part", F.spark_partition_id())
    dealt.write.parquet(f"{path}/dealt")
    dealt = spark.read.schema(dealt.schema).parquet(f"{path}/dealt")
    earlier = Window.unboundedPreceding, -1
    inside = Window.partitionBy("column", "range", "part").orderBy("value").rowsBetween(*earlier)
    before = Window.partitionBy("column", "range").orderBy("part").rowsBetween(*earlier)
    sums = dealt.groupBy("column", "range", "part").agg(F.sum("n").alias("part_n"))
    offsets = sums.select("column", "range", "part", F.coalesce(F.sum("part_n").over(before), F.lit(0)).alias("offset"))
    summed = dealt.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return summed.join(offsets, ["column", "range", "part"]).withColumn(
        "below", F.col("below") + F.col("offset") + F.col("inside")).drop("offset", "inside", "part")


def _long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ])
    return df.select(F.inline(rows)).filter(F.col("value").isNotNull())


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], margin: float = 5e-4
) -> DataFrame:
    """Exact interpolated quantiles of any number of rows.

    Values are counted first, so a frequent value is one row. Approximate
    quantiles a little below and above each wanted one cut the values into
    ranges; exact counts per range tell which ones hold the wanted positions, and
    only those, about one row in a thousand, are put in order, in parts of
    bounded size. A chosen range is known by its end values and
    the exact count below it, so approximate cuts never change a result.
    """
    long = _long_values(df, columns)
    edges = sorted({
        min(max(p + side * margin, 0.0), 1.0) for p in probabilities for side in (-1, 1)
    })
    cuts = long.groupBy("column").agg(
        F.percentile_approx("value", F.lit(edges), 10000).alias("cuts")
    )
    counted = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    # One row per profiled column on the broadcast side.
    ranged = counted.join(F.broadcast(cuts), "column").select(
        "column", "n",
        F.array_max(F.filter("cuts", lambda c: c < F.col("value"))).alias("above"),
        F.array_min(F.filter("cuts", lambda c: c >= F.col("value"))).alias("upto"),
    )
    by_column = Window.partitionBy("column")
    in_order = by_column.orderBy(F.col("above").asc_nulls_first())
    below = F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    # At most one row per cut and column.
    ranges = ranged.groupBy("column", "above", "upto").agg(F.sum("n").alias("n")).select(
        "column", "above", "upto", "n", F.coalesce(below, F.lit(0)).alias("below"),
        F.sum("n").over(by_column).alias("total"),
    )

    def neighbours(p: float):
        """The two positions, counted from 0, that a quantile lies between."""
        position = (F.col("total") - 1) * p
        return [
            F.struct(F.lit(p).alias("p"), position.alias("position"), end(position).alias("at"))
            for end in (F.floor, F.ceil)
        ]

    wanted = F.array(*[entry for p in probabilities for entry in neighbours(float(p))])
    first, last = F.col("below"), F.col("below") + F.col("n") - 1
    chosen = ranges.select(
        "column", "above", "upto", "below",
        F.filter(wanted, lambda w: w["at"].between(first, last)).alias("wanted"),
    ).filter(F.size("wanted") > 0)
    inside = (F.col("above").isNull() | (F.col("value") > F.col("above"))) & (
        F.col("upto").isNull() | (F.col("value") <= F.col("upto"))
    )
    # At most two ranges per column and probability on the broadcast side.
    candidates = counted.join(F.broadcast(chosen), "column").filter(inside).select(
        "column", F.coalesce("above", F.lit(float("-inf"))).alias("range"), "value", "n", "below", "wanted"
    )
    placed = _below(candidates, "quantiles").withColumns({
        "first": F.col("below"), "last": F.col("below") + F.col("n") - 1,
    })
    hits = placed.select("column", "value", F.inline(F.filter(
        "wanted", lambda w: w["at"].between(F.col("first"), F.col("last"))
    )))
    low, high = F.min("value"), F.max("value")
    fraction = F.max(F.col("position") - F.floor("position"))
    return hits.groupBy("column", "p").agg((low + (high - low) * fraction).alias("quantile"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles per column, two decimals."""
    basics = df.agg(*[
        F.struct(
            F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
            F.min(c).alias("min"), F.max(c).alias("max"),
        ).alias(c)
        for c in columns
    ])
    rows = _long(basics, {c: F.col(c) for c in columns}).select("column", "value.*")
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75))
    spread = quartiles.groupBy("column").agg(*[
        F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(name)
        for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))
    ])
    joined = rows.join(spread, "column", "left")
    return joined.select("column", "n", *[
        stable_round(F.col(c).cast("double"), 2).alias(c)
        for c in ("mean", "std", "min", "q1", "median", "q3", "max")
    ])
