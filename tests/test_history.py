"""Standing in a history, records, rolling totals, next-day fit, joins on order."""

import bisect
import datetime as dt
import random

import numpy as np
import pytest
from conftest import day, rows_of
from pyspark.sql import functions as F

from wxlake.operators import forecast, history, joins, profile

START = dt.date(2000, 1, 1)


def series(n, seed=1, gap=0.1):
    """Days of two areas with gaps, missing values and one area with a single day."""
    pick = random.Random(seed)
    rows = [(area, START + dt.timedelta(days=i), pick.choice([None, round(pick.gauss(10, 5), 2), round(pick.gauss(10, 5), 1)]))
            for area in ("01", "02") for i in range(n) if pick.random() > gap]
    return [*rows, ("03", START, 1.0)]


def frame_of(spark, rows):
    daily = spark.createDataFrame(rows, "dept string, obs_date date, rain double")
    return daily.withColumns({"month": F.month("obs_date"), "year": F.year("obs_date")})


def test_standing_equals_counting(spark):
    rows = series(900)
    daily = frame_of(spark, rows)
    cut = dt.date(2002, 1, 1)
    past = daily.filter(F.col("obs_date") < cut)
    counts = history.merged(*[history.distribution(past.filter(f"day(obs_date) {c} 15"), "rain") for c in ("<", ">=")])
    assert rows_of(counts) == rows_of(history.distribution(past, "rain").select(*counts.columns))
    days = daily.filter(F.col("obs_date") >= cut).withColumn("n_history_of", F.lit(1))
    found = {(r.dept, r.obs_date): r for r in history.standing(days, counts, "rain").collect()}
    assert len(found) == days.count()
    unit = {r: None if r[2] is None else round(r[2] * 10 + 1e-9) for r in rows}
    for area, when, value in rows:
        if when < cut:
            continue
        old = [unit[r] for r in rows if r[0] == area and r[1] < cut and r[1].month == when.month and r[2] is not None]
        row, own = found[area, when], unit[area, when, value]
        if own is None or not old:
            assert (row.n_history, row.percentile, row.z_score, row.record) == (None,) * 4
            continue
        assert row.n_history == len(old) and row.percentile == pytest.approx(100 * sum(u <= own for u in old) / len(old), abs=0.006)
        assert row.z_score == pytest.approx((own - np.mean(old)) / np.std(old), abs=0.002)
        assert row.record == ("high" if own > max(old) else "low" if own < min(old) else None)


def test_no_history_and_no_days(spark):
    daily = frame_of(spark, series(40))
    none = history.distribution(daily.limit(0), "rain")
    assert all(r.percentile is None and r.record is None for r in history.standing(daily, none, "rain").collect())
    assert history.standing(daily.limit(0), history.distribution(daily, "rain"), "rain").count() == 0


def test_records_by_year(spark):
    rows = [("01", day("2001-05-02"), 5.0), ("01", day("2001-05-09"), 7.0), ("01", day("2002-05-01"), 7.0), ("01", day("2003-05-01"), 8.0),
            ("01", day("2003-05-03"), 8.0), ("01", day("2004-05-01"), None), ("01", day("2005-06-01"), 99.0)]
    assert rows_of(history.records_broken(frame_of(spark, rows), "rain")) == [("01", 5, 2003, day("2003-05-01"), 8.0, 7.0)]


@pytest.mark.parametrize("stretch", [30, 37, 10_000])
def test_rolling_totals_follow_the_calendar(spark, stretch):
    rows = series(200, seed=stretch, gap=0.3) + [("04", dt.date(1969, 12, 30) + dt.timedelta(days=i), 1.0) for i in range(5)]
    values = {(r[0], r[1]): r[2] for r in rows}
    found = history.rolling_totals(frame_of(spark, rows), "rain", stretch=stretch).collect()
    assert sorted((r.dept, r.obs_date) for r in found) == sorted(values)
    for r in found:
        for n in (3, 7, 30):
            window = [values.get((r.dept, r.obs_date - dt.timedelta(days=i))) for i in range(n)]
            known = [v for v in window if v is not None]
            assert r[f"complete_{n}d"] == (len(known) == n)
            assert r[f"sum_{n}d"] == (pytest.approx(sum(known), abs=0.051) if known else None)
    with pytest.raises(ValueError, match="shorter"):
        history.rolling_totals(frame_of(spark, rows), "rain", stretch=29)


def weather(spark, n=400):
    """Areas whose next day depends on two of three measures; the third repeats the first."""
    pick = random.Random(3)
    rows = []
    for area, (a, c) in {"01": (0.7, -0.2), "02": (0.1, 0.5)}.items():
        x, z = 5.0, 1.0
        for i in range(n):
            if i % 50:
                rows.append((area, START + dt.timedelta(days=i), x, z, 2 * x + 1))
            x, z = 2 + a * x + c * z + pick.gauss(0, 0.3), pick.gauss(0, 2)
    rows += [("03", START + dt.timedelta(days=i), 4.0, 1.0, 9.0) for i in range(5)] + [("04", START, 1.0, None, None)]
    return rows, spark.createDataFrame(rows, "dept string, obs_date date, t double, z double, copy double")


def test_fit_equals_least_squares(spark):
    rows, daily = weather(spark)
    until = F.lit(START + dt.timedelta(days=300))
    found = {r.dept: r for r in forecast.fit(daily, "t", ["t", "z"], until).collect()}
    for area in ("01", "02"):
        own = {r[1]: r for r in rows if r[0] == area}
        pairs = [(own[d], own[d + dt.timedelta(days=1)]) for d in own if d + dt.timedelta(days=1) in own and (d - START).days + 1 < 300]
        matrix = np.array([[1, a[2], a[3]] for a, _ in pairs])
        wanted = np.linalg.lstsq(matrix, np.array([later[2] for _, later in pairs]), rcond=None)[0]
        r = found[area]
        assert r.n == len(pairs) and np.allclose([r.intercept, r.slope_0, r.slope_1], wanted, atol=1e-8)
    assert (found["03"].intercept, found["03"].slope_0, found["03"].slope_1) == (4.0, 0.0, 0.0) and "04" not in found
    doubled = {r.dept: r for r in forecast.fit(daily, "t", ["t", "copy", "z"], until).collect()}
    for area in ("01", "02"):
        assert doubled[area].slope_1 == 0 and doubled[area].slope_2 == pytest.approx(found[area].slope_1, abs=1e-8)


def test_skill_is_judged_on_later_days(spark):
    _, daily = weather(spark)
    found = {r.dept: r for r in forecast.skill(daily, "t", ["t", "z"], F.lit(START + dt.timedelta(days=300))).collect()}
    assert set(found) == {"01", "02"} and all(r.better and r.mae_fit < 0.35 and 80 < r.n_days < 100 for r in found.values())


def test_small_groups_are_counted_exactly_by_the_sketch(spark):
    rows = spark.range(120_000).selectExpr("if(id < 400, 'small', if(id < 403, 'tiny', 'large')) AS g", "id AS v")
    rows = rows.unionByName(rows).unionByName(spark.sql("SELECT 'none' AS g, cast(NULL AS bigint) AS v"))
    found = {r.g: r.n_distinct for r in profile.distinct_count(rows, "v", ["g"], approx=True).collect()}
    assert found["tiny"] == 3 and found["small"] == 400 and found["none"] == 0
    assert abs(found["large"] - (120_000 - 403)) < 0.05 * 120_000


def ranges(n, seed):
    pick = random.Random(seed)
    out = []
    for i in range(n):
        start = START + dt.timedelta(days=pick.randint(-50, 2500))
        end = start + dt.timedelta(days=pick.choice([0, 3, 40, 900, -1]))
        out.append((i, pick.choice(["a", "a", "a", "b", None]), pick.choice([start] * 9 + [None]), pick.choice([end] * 9 + [None])))
    return out


@pytest.mark.parametrize("width, keys", [(365, ["k"]), (7, ["k"]), (100_000, []), (50, [])])
def test_overlaps_equal_comparing_all(spark, width, keys):
    left, right = ranges(90, 1), ranges(80, 2)
    a = spark.createDataFrame(left, "l int, k string, s date, e date")
    c = spark.createDataFrame(right, "r int, k string, s2 date, e2 date")
    c = c if keys else c.withColumnRenamed("k", "k2")
    low, high = dt.date.min, dt.date.max
    wanted = []
    for i, k, s, e in left:
        for j, k2, s2, e2 in right:
            first, last, first2, last2 = s or low, e or high, s2 or low, e2 or high
            if first <= last and first2 <= last2 and first <= last2 and first2 <= last and (not keys or (k is not None and k == k2)):
                wanted.append((i, j))
    found = joins.overlap_join(a, c, ("s", "e"), ("s2", "e2"), keys, width)
    assert rows_of(found, "l", "r") == sorted(wanted, key=repr)
    assert joins.overlap_join(a.limit(0), c, ("s", "e"), ("s2", "e2"), keys, width).count() == 0


def test_a_large_period_table_is_joined_by_bins(spark):
    periods = spark.range(100_000).selectExpr("id", "date'1950-01-01' + cast(id % 25000 AS int) AS s", "date'1950-01-01' + cast(id % 25000 + 5 AS int) AS e")
    requests = spark.range(3_000).selectExpr("id AS r", "date'1960-01-01' + cast(id AS int) AS f", "date'1960-01-01' + cast(id + 2 AS int) AS t")
    found = joins.overlap_join(requests, periods, ("f", "t"), ("s", "e"))
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert found.count() == 3_000 * 8 * 4


def test_bins_follow_the_lengths_of_the_ranges(spark):
    periods = spark.range(50_000).selectExpr("id", "date'1990-01-01' + cast(id % 2400 AS int) AS s", "IF(id % 97 <> 0, date'1990-01-01' + cast(id % 2400 + id % 40 AS int), NULL) AS e")
    requests = spark.range(2_000).selectExpr("id AS r", "date'1990-01-01' + cast(id AS int) AS f", "date'1990-01-01' + cast(id + id % 30 AS int) AS t")
    found = joins.overlap_join(requests, periods, ("f", "t"), ("s", "e"))
    wide = joins.overlap_join(requests, periods, ("f", "t"), ("s", "e"), width=365)
    agg = [F.count("*"), F.sum(F.xxhash64("r", "id").cast("decimal(38,0)"))]
    assert found.agg(*agg).first() == wide.agg(*agg).first()
    # Pairs that share a bin, of those that overlap: few with the chosen width, many with years.
    def compared(days):
        sides = []
        for rows, start, end in ((requests, "f", "t"), (periods, "s", "e")):
            last = F.coalesce(F.unix_date(end), F.unix_date(F.lit("1996-08-01").cast("date")))
            bins = F.explode(joins.bins(F.unix_date(start), last, days)).alias("bin")
            sides.append(rows.select(bins).groupBy("bin").count())
        return sides[0].join(sides[1].withColumnRenamed("count", "n"), "bin").agg(F.sum(F.col("count") * F.col("n"))).first()[0]

    assert compared(joins.bin_width(15.5, 32)) < 3 * found.count() and compared(365) > 5 * found.count()
    assert joins.bin_width(1, 1) == 1 and joins.bin_width(1, 8000) == 1000


def test_pairs_are_laid_out_so_that_files_stay_small(spark, tmp_path):
    periods = spark.range(60_000).selectExpr("xxhash64(id) AS id", "date'1990-01-01' + cast(pmod(xxhash64(id, 1), 2400) AS int) AS s").selectExpr("*", "IF(id % 97 <> 0, s + cast(pmod(id, 40) AS int), NULL) AS e")
    requests = spark.range(3_000).selectExpr("id AS r", "date'1990-01-01' + cast(pmod(xxhash64(id, 2), 2000) AS int) AS f").selectExpr("*", "f + cast(r % 30 AS int) AS t")
    found = joins.overlap_join(requests, periods, ("f", "t"), ("s", "e"))
    # Both sides are dealt out, however small one is: a copy of it in each task would keep the order of the other.
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    found.select("id", "r", "f", "t").write.parquet(f"{tmp_path}/pairs")
    written = spark.read.parquet(f"{tmp_path}/pairs")
    size = sum(f.stat().st_size for f in tmp_path.glob("pairs/*.parquet"))
    wanted = requests.join(periods, F.expr("s <= t AND coalesce(e, date'9999-12-31') >= f"))
    agg = [F.count("*"), F.sum(F.xxhash64("id", "r", "f", "t").cast("decimal(38,0)"))]
    assert written.agg(*agg).first() == wanted.agg(*agg).first()
    assert size < 2 * written.count()


def test_a_hot_key_is_cut_into_tiles(spark):
    # One key and one range, rows that come twice, NULL values, a kind of column that has no hash.
    rows = spark.range(5_000).selectExpr("'a' AS k", "cast(1 AS bigint) AS _bin", "1 AS s", "2 AS e", "IF(id % 3 = 0, NULL, id % 1000) AS v", "map(id, 'x') AS m")
    for salts in (1, 7):
        tiles = joins.tiled(rows, ["k", "_bin"], "s", "e", salts, "_l_")
        most, total = tiles.agg(F.max(F.size("_l_0")), F.sum(F.size("_l_0"))).first()
        assert most <= joins.TILE_ROWS and total == 5_000
        back = tiles.select(F.explode("_l_2").alias("v"))
        assert back.exceptAll(rows.select("v")).isEmpty() and back.count() == 5_000
    left = rows.filter("v < 30 OR v IS NULL").selectExpr("k", "date'1990-01-01' AS s", "date'1990-01-03' AS e", "v", "m")
    right = spark.range(700).selectExpr("'a' AS k", "date'1990-01-02' AS s2", "IF(id = 3, NULL, date'1990-01-02') AS e2", "IF(id < 600, NULL, 'w') AS w")
    found = joins.overlap_join(left, right, ("s", "e"), ("s2", "e2"), ["k"])
    assert found.columns == ["k", "s", "e", "v", "m", "s2", "e2", "w"]
    n = left.count()
    assert found.agg(F.count("*"), F.count("v"), F.count("w"), F.count("e2"), F.count("m")).first() == (
        700 * n, 700 * left.filter("v IS NOT NULL").count(), 100 * n, 699 * n, 700 * n)


def test_as_of_equals_searching(spark):
    pick = random.Random(4)
    entries = [(pick.choice("ab"), START + dt.timedelta(days=pick.randint(0, 3000)), pick.randint(0, 99)) for _ in range(200)]
    entries += [("a", None, 1), (None, START, 2), ("c", START, 3), ("a", entries[0][1], None)]
    rows = [(i, pick.choice(["a", "a", "b", "c", "d", None]), pick.choice([None] + [START + dt.timedelta(days=pick.randint(-300, 4000))] * 9)) for i in range(400)]
    table = spark.createDataFrame(entries, "k string, since date, v int")
    asked = spark.createDataFrame(rows, "id int, k string, at date")
    best = {}
    for k, since, v in entries:
        if k is not None and since is not None:
            best[k, since] = max(best.get((k, since), -1), -1 if v is None else v)
    starts = {k: sorted(s for key, s in best if key == k) for k in "abcd"}
    wanted = []
    for i, k, at in rows:
        place = bisect.bisect_right(starts.get(k, []), at) if at is not None and k is not None else 0
        since = starts[k][place - 1] if place else None
        wanted.append((i, k, at, since, best[k, since] if since else None))
    for bin_of in (None, F.unix_date("at"), F.lit(0)):
        found = joins.as_of_join(asked, table, "at", "since", ["k"], bin_of)
        assert rows_of(found) == sorted(wanted, key=repr)
    assert rows_of(joins.as_of_join(asked, table.limit(0), "at", "since", ["k"])) == sorted(((*r, None, None) for r in rows), key=repr)
    assert joins.as_of_join(asked.limit(0), table, "at", "since", ["k"]).count() == 0


def test_steps_from_a_table(spark):
    steps = spark.createDataFrame([(0.0, "clear"), (3.0, "cloud"), (45.0, "fog")], "bound double, label string")
    values = spark.createDataFrame([(-1.0,), (0.0,), (2.9,), (3.0,), (99.0,), (None,)], "v double")
    found = joins.step_lookup(values, steps, "v", "bound")
    assert rows_of(found, "v", "label") == sorted([(-1.0, None), (0.0, "clear"), (2.9, "clear"), (3.0, "cloud"), (99.0, "fog"), (None, None)], key=repr)
