"""Shapes of physical plans that must hold at any scale."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wxlake import schemas

from wxlake.checks import bindings as b
from wxlake.operators import dedup, episodes, lots, ranking, rollup
from wxlake.sources import layers

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="no tables")


@pytest.fixture(scope="module")
def observed(spark, tmp_path_factory):
    """Observations of 40 stations x 200 days, stored by source and month."""
    rows = spark.range(8000).select(
        F.lit("official").alias("source"),
        F.concat(F.lpad((F.col("id") % 40).cast("string"), 2, "0"), F.lit("001")).alias("station_id"),
        F.lpad((F.col("id") % 40).cast("string"), 2, "0").alias("dept"),
        F.lit(10.0).alias("elevation"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 40).cast("int")).alias("obs_date"),
        *[(F.col("id") % 7).cast("double").alias(c) for c in (
            "temperature", "temp_min", "temp_max", "precipitation_mm", "wind_speed_ms", "wind_gust_ms",
            "sunshine_min", "humidity_pct", "fog")])
    path = str(tmp_path_factory.mktemp("obs") / "t")
    stored = rows.withColumn("year", F.year("obs_date")).withColumn("month", F.month("obs_date"))
    layers.write_partitions(stored, path, ["source", "year", "month"])
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_newest_row_is_limited_before_the_exchange(spark):
    df = spark.range(10).select((F.col("id") % 5).alias("id"), (F.col("id") % 3).alias("s"))
    steps = re.findall(r"WindowGroupLimit.*?(Partial|Final)|(Exchange hashpartitioning)",
                       plan(dedup.latest_per_key(df, ["id"], ["s"])))
    assert [a or c for a, c in steps] == ["Final", "Exchange hashpartitioning", "Partial"]


def test_day_rollup_is_one_exchange_with_partial_aggregation(observed):
    text = plan(rollup.area_daily(observed))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_avg" in text
    assert "BroadcastHashJoin" in text and "LocalTableScan" in text  # the area table


def test_filters_reach_folders_and_columns_are_pruned(observed):
    text = plan(rollup.lowland(observed).filter("year = 2024 AND month = 2").select("temperature"))
    assert re.search(r"PartitionFilters: \[[^\]]*source[^\]]*year[^\]]*month", text)
    assert "PushedFilters: [IsNotNull(elevation), LessThanOrEqual(elevation,300.0)]" in text
    assert "ReadSchema: struct<elevation:double,temperature:double>" in text


def test_all_run_types_in_one_pass(observed):
    text = plan(episodes.detect_runs(rollup.area_daily(observed)))
    assert text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning") == 2  # day roll-up, then (area, type)


def test_periods_read_the_table_once(observed):
    daily = rollup.area_daily(observed).drop("city").withColumn("city", F.col("dept"))
    text = plan(ranking.period_rollup(daily, F.lit("2024-07-01").cast("date")))
    assert text.count("FileScan") == 1 and "Union" not in text


def test_both_met_days_in_one_aggregate(spark):
    from wxlake.operators import compare

    hourly = spark.sql("SELECT '59' AS dept, 's' AS station_id, 1D AS elevation, "
                       "timestamp_seconds(id * 3600) AS obs_ts, 1D AS temp, 1D AS precip_mm FROM range(100)")
    text = plan(compare.official_days(hourly))
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 2


def test_hot_key_reaches_the_exchange_once_per_task(spark):
    """A third of all rows share one key; each task still sends one row for it."""
    df = spark.range(0, 90000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("s"))
    found = dedup.latest_per_key(df, ["k"], ["s"])
    found.collect()
    executed = found._jdf.queryExecution().executedPlan()
    sent = _metric(executed, "shuffleRecordsWritten")
    assert found.count() == 60001 and sent == 60000 + 6


@pytest.fixture
def small_partitions(spark):
    """Make a few megabytes look like a big cluster's partitions."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_hot_join_key_is_split(spark, small_partitions):
    """A third of the rows share one key on both the semi join and the join back."""
    rows = spark.range(0, 400000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 1000).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    markers = spark.range(0, 1000, 1, 8).select((F.col("id") - 1).alias("k"))
    found = lots.complete_lots(rows, markers, ["k"])
    assert len(found.collect()) == rows.filter("k < 999").count()
    assert "skew=true" in plan(found)
    scored = rows.withColumn("score", F.when(F.col("k") == -1, 99.0).otherwise(F.col("k") % 50 * 1.0))
    ranked = ranking.rank_by_score(scored, "score", "place")
    assert len(ranked.collect()) == 400000 and "skew=true" in plan(ranked)


def test_a_hot_folder_is_written_by_several_tasks(spark, small_partitions, tmp_path):
    rows = spark.range(0, 200000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 10).cast("string")).alias("g"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    layers.write_partitions(rows, str(tmp_path / "t"), ["g"])
    files = [p.parent.name for p in (tmp_path / "t").rglob("*.parquet")]
    assert files.count("g=hot") > 3 and spark.read.parquet(str(tmp_path / "t")).count() == 200000


def _metric(executed, name):
    """Sum of a metric over the exchanges of a finished plan."""
    total, todo = 0, [executed]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
        else:
            if node.getClass().getSimpleName() == "ShuffleExchangeExec":
                total += node.metrics().apply(name).value()
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


@needs_tables
def test_no_query_leaves_the_jvm_or_joins_without_a_key(spark):
    from wxlake.checks.queries import QUERIES

    for name, build in QUERIES.items():
        if name.startswith("stream_"):
            continue
        text = plan(build(spark, SF))
        for bad in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
            if name == "idw_all_stations" and bad == "InArrow":
                continue  # products of matrices, in blocks
            assert bad not in text, (name, bad)


@needs_tables
def test_bindings_read_only_needed_columns(spark):
    text = plan(b.observations(spark, SF).select("dept", "temperature"))
    assert "l_extendedprice" not in text and "l_shipdate" not in text


@needs_tables
def test_staging_writes_the_asked_family_only(spark, monkeypatch):
    from wxlake.checks.queries import QUERIES

    monkeypatch.setattr(b, "_STAGED", {})
    writers = spark.conf.get(b.OPEN_FILES)
    n = b.table(spark, SF, "lineitem").count()
    for name in ("scan_csv_snapshots", "complete_lots_only"):
        assert QUERIES[name](spark, SF).count() <= n
    (folder,) = b._STAGED.values()
    files = spark.read.option("recursiveFileLookup", True).text(folder).inputFiles()
    assert files and all("family=RR-T-Vent" in f for f in files)
    rows = spark.read.option("header", True).option("sep", ";").csv(folder)
    assert rows.count() == n and rows.filter("substring(NUM_POSTE, 1, 2) <> lpad(dept, 2, '0')").count() == 0
    assert spark.conf.get(b.OPEN_FILES) == writers


def test_job_path_reads_and_sorts_only_what_the_model_has(spark, tmp_path):
    from conftest import write_lot
    from wxlake.operators import clean
    from wxlake.sources import raw

    columns = [*schemas.DAILY_MAIN_COLUMNS, "UNUSED1", "UNUSED2"]
    row = {"NUM_POSTE": "59000001", "AAAAMMJJ": "20240101", "TM": "1.5", "UNUSED1": "x"}
    write_lot(tmp_path, "dept=59/period=latest-2025-2026/family=RR-T-Vent/snapshot=2026-01-01", columns, [row, {**row, "TM": "2.5"}])
    daily = clean.daily_main(raw.read_daily_family(spark, str(tmp_path), "RR-T-Vent"))
    text = plan(daily)
    assert "UNUSED" not in text and "WindowGroupLimit" in text
    assert [r.temperature for r in daily.collect()] == [2.5]


@needs_tables
def test_lots_are_staged_without_a_shuffle_and_hold_the_text_of_a_cast(spark, monkeypatch):
    monkeypatch.setattr(b, "_STAGED", {})
    group = f"staging-{id(monkeypatch)}"
    spark.sparkContext.setJobGroup(group, "staging")
    try:
        root = b.stage_daily(spark, SF)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    # Behind a shuffle, the job that writes has the shuffle's stage too.
    written = [j for j in tracker.getJobIdsForGroup(group) if len(tracker.getJobInfo(j).stageIds) > 1]
    assert written == []
    from wxlake.sources import raw

    for family, names in zip(b.FAMILIES, (b.MAIN_TEXT, b.OTHER_TEXT)):
        found = raw.read_daily_family(spark, root, family, names).select(*names, "snapshot")
        wanted = b._text(b.daily_rows(spark, SF), (*names, "snapshot"))
        assert found.exceptAll(wanted).count() == 0 and wanted.exceptAll(found).count() == 0


def test_daily_families_are_sorted_by_a_number_and_each_column_once(spark, tmp_path):
    from conftest import write_lot
    from wxlake.operators import clean
    from wxlake.sources import raw

    row = {"NUM_POSTE": "59000001", "AAAAMMJJ": "20240101", "TM": "1.5", "INST": "7"}
    for family, columns in zip(b.FAMILIES, (schemas.DAILY_MAIN_COLUMNS, schemas.DAILY_OTHER_COLUMNS)):
        write_lot(tmp_path, f"dept=59/period=latest-2025-2026/family={family}/snapshot=2026-01-01", columns, [row, {**row, "TM": None, "INST": None}])
    main, other = (raw.read_daily_family(spark, str(tmp_path), family) for family in b.FAMILIES)
    found = clean.official_observations(main, other)
    text = plan(found)
    assert not re.search(r"(?<!named_)struct\(", text)
    sorts = re.findall(r"Sort \[(\w+)#", text)
    assert sorts and set(sorts) == {clean.KEY_HASH}
    assert clean.KEY_HASH not in found.columns + clean.daily_main(main).columns + clean.daily_other(other).columns
    assert [(r.temperature, r.sunshine_min) for r in found.collect()] == [(1.5, 7.0)]


def test_quantiles_put_values_in_order_in_bounded_parts(spark, monkeypatch):
    from wxlake.operators import profile

    monkeypatch.setattr(profile, "PART_ROWS", 50)
    values = spark.range(40_000).select((F.col("id") * 7919 % 40_000).cast("double").alias("v"))
    for frame in (values, values.select(F.when(F.col("v") < 30_000, 5.0).otherwise(F.col("v")).alias("v"))):
        want = sorted(r.v for r in frame.collect())
        found = {r.p: r.quantile for r in profile.exact_quantiles(frame, ["v"], (0.0, 0.5, 0.9, 1.0)).collect()}
        assert found == {p: want[int(p * 39_999)] + (want[min(39_999, int(p * 39_999) + 1)] - want[int(p * 39_999)]) * (p * 39_999 % 1) for p in found}


def test_unrounded_scores_are_not_sorted_in_one_task(spark):
    from wxlake.operators import ranking

    scored = spark.range(5000).select("id", (F.xxhash64("id") % 1000 / 7 + 200).alias("score"))
    ranked = ranking.rank_by_score(scored, "score", "place")
    rows = {r.id: r for r in ranked.collect()}
    order = sorted((r.score for r in rows.values()), reverse=True)
    assert all(r.place == order.index(r.score) + 1 for r in list(rows.values())[:200])
