"""Whole jobs over a lake folder, and layer reading and writing."""

from datetime import date
from pathlib import Path

import pytest
from conftest import day, rows_of, write_json_lines, write_lot
from pyspark.sql import functions as F

from wxlake import schemas
from wxlake.operators import clean
from wxlake.plans import lake as jobs
from wxlake.sources import layers, raw


def build_raw(root):
    """A small raw layer: 2 areas x 40 days, live day, hourly day, grid, alerts."""
    main, other = schemas.DAILY_MAIN_COLUMNS, schemas.DAILY_OTHER_COLUMNS
    dates = [date(2023, 12, 25).toordinal() + i for i in range(40)]
    for dept in ("59", "06"):
        rows, extra = [], []
        for i, n in enumerate(dates):
            d = date.fromordinal(n).strftime("%Y%m%d")
            cold = dept == "59" and 3 <= i < 8
            base = {"NUM_POSTE": dept + "000001", "NOM_USUEL": "A", "LAT": "50", "LON": "3", "ALTI": "20", "AAAAMMJJ": d}
            rows.append({**base, "TM": -2 if cold else 6, "TN": -5 if cold else 2, "TX": 1 if cold else 9,
                         "RR": 8 if dept == "06" and i < 4 else 1, "FFM": 4, "FXI": 25 if i == 39 else 9})
            rows.append({**base, "NUM_POSTE": dept + "000002", "ALTI": "1500", "TM": -20, "TN": -25, "TX": -15, "RR": 0})
            extra.append({"NUM_POSTE": dept + "000001", "AAAAMMJJ": d, "INST": 60, "UM": 80})
        base = f"source=official/dept={dept}/period=latest-2025-2026/family="
        write_lot(root, base + "RR-T-Vent/snapshot=2024-03-01", main, rows)
        write_lot(root, base + "autres-parametres/snapshot=2024-03-01", other, extra)
    write_json_lines(Path(root) / "source=live" / "ingest_date=2024-01-10" / "part-0.txt", [
        {"ingested_at": f"2024-01-10T{m // 60:02d}:{m % 60:02d}:30Z", "city": "Lille", "dept": "59",
         "time": f"2024-01-10T{m // 60:02d}:{m % 60:02d}", "temperature_2m": 5.0, "precipitation": 1.0,
         "cloud_cover": 50.0, "wind_speed_10m": 36.0, "relative_humidity_2m": 80.0}
        for m in range(15, 1440, 15)])
    hours = [{"NUM_POSTE": "59000001", "NOM_USUEL": "A", "ALTI": "20", "T": "4.5", "RR1": "0.5",
              "AAAAMMJJHH": f"20240{110 + h // 24}{h % 24:02d}"} for h in range(1, 31)]
    write_lot(root, "source=official_hourly/dept=59/period=latest/snapshot=2024-01-12", schemas.HOURLY_COLUMNS, hours)
    reference = Path(root) / "source=grid" / "kind=grille"
    reference.mkdir(parents=True)
    (reference / "grid.csv").write_text("LAMBX (hm);LAMBY (hm);LAT_DG;LON_DG\n0;0;43,5;7,5\n80;0;43,5;7,6\n")
    mesh = [{"LAMBX": x, "LAMBY": 0, "T": "5,0"} for x in (0, 80)]
    write_lot(root, "source=grid/kind=mens/year=2024/snapshot=2024-03-01", schemas.GRID_MONTHLY_COLUMNS,
              [{**m, "DATE": d, "PRETOTM": "60"} for m in mesh for d in ("202312", "202401")])
    write_lot(root, "source=grid/kind=quot_latest/snapshot=2024-03-01", schemas.GRID_DAILY_COLUMNS,
              [{**m, "DATE": "20240110", "PRELIQ": "1", "PRENEI": "0", "FF": "5", "HU": "80", "SSI": "1000"} for m in mesh])
    for d in ("2023-12-28", "2023-12-29", "2023-12-30", "2024-01-20"):
        folder = Path(root) / "source=alerts" / f"date={d}"
        folder.mkdir(parents=True)
        (folder / "CDP_CARTE_EXTERNE.json").write_text(
            '{"product": {"periods": [{"echeance": "J", "timelaps": {"domain_ids": [{"domain_id": "59", '
            '"max_color_id": 2, "phenomenon_items": [{"phenomenon_id": "7", "phenomenon_max_color_id": 2}]}]}}]}}')


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    build_raw(root / "raw")
    lake = jobs.Lake(str(root))
    assert jobs.build_business_tables(spark, lake) == []  # nothing there yet
    assert jobs.build_comparison(spark, lake) == []
    assert jobs.build_grid_tables(spark, lake) == []
    assert jobs.build_observations(spark, lake, complete_only=False) == 2 * 2 * 40 + 95
    assert jobs.build_hourly(spark, lake, complete_only=True) == 30
    assert jobs.build_grid(spark, lake) == 6
    assert jobs.build_alerts(spark, lake) == 4
    assert jobs.build_business_tables(spark, lake) == [
        "live_status", "gloom_daily", "gloom_ranking", "gloom_podiums", "episodes", "gloom_dates"]
    assert jobs.build_grid_tables(spark, lake) == ["grid_daily", "grid_monthly"]
    assert jobs.build_comparison(spark, lake) == ["live_vs_official", "live_reliability", "episodes_alerts"]
    return lake


def test_daily_table(spark, lake):
    daily = spark.read.parquet(lake.business("gloom_daily"))
    assert daily.count() == 80 and daily.filter("n_stations <> 1").count() == 0  # high stations left out
    # cold 17/20, dark 1-60/360, rain 1/20, wind 0.4, humid 0.5
    row = daily.filter("dept = '59' AND obs_date = '2023-12-29'").collect()[0]
    assert row.gloom == round(100 * (0.3 * 0.85 + 0.25 * 5 / 6 + 0.25 * 0.05 + 0.1 * 0.4 + 0.1 * 0.5), 1)


def test_rankings_and_dates(spark, lake):
    ranking = spark.read.parquet(lake.business("gloom_ranking"))
    assert rows_of(ranking, "year", "month", "dept", "n_days", "gloom_rank") == [
        (2023, 12, "06", 7, 2), (2023, 12, "59", 7, 1), (2024, 1, "06", 31, 2), (2024, 1, "59", 31, 1),
        (2024, 2, "06", 2, 1), (2024, 2, "59", 2, 1)]
    podiums = spark.read.parquet(lake.business("gloom_podiums"))
    assert sorted(r[0] for r in podiums.select("period_type").distinct().collect()) == ["10years", "5years", "month", "year"]
    assert jobs.served_days(spark, lake).count() == 40


def test_episodes_and_alerts(spark, lake):
    checked = spark.read.parquet(lake.business("episodes_alerts"))
    assert rows_of(checked, "dept", "type", "start_date", "n_days", "alert_days", "status") == sorted([
        ("59", "cold_spell", day("2023-12-28"), 5, 3, "confirmed"),
        ("06", "rain_spell", day("2023-12-25"), 4, 0, "not_confirmed"),
        ("59", "wind_gust", day("2024-02-02"), 1, 0, "not_evaluated"),
        ("06", "wind_gust", day("2024-02-02"), 1, 0, "not_evaluated")], key=repr)
    served = jobs.served_episodes(spark, lake, 2)
    assert [r.type for r in served.collect()] == ["wind_gust", "wind_gust"] and "status" in served.columns


def test_live_and_comparison(spark, lake):
    status = spark.read.parquet(lake.business("live_status")).collect()
    # cold 0.5, dark 0.5, rain 0.5, wind 1, humid 0.5
    assert [(r.city, r.gloom_live, r.gloom_rank_live) for r in status] == [("Lille", 55.0, 1)]
    compared = spark.read.parquet(lake.business("live_vs_official"))
    assert rows_of(compared, "city", "diff_temp", "precip_live", "precip_off", "n_hours", "n_points") == [
        ("Lille", 0.5, 17.75, 12.0, 24, 95)]


def test_grid_tables(spark, lake):
    daily = spark.read.parquet(lake.business("grid_daily"))
    # cold 0.5, dark 0.5, rain 0.05, wind 0.5, humid 0.5
    assert rows_of(daily, "cellx", "celly", "lon", "gloom") == [(80, 80, 7.55, 38.8)]
    monthly = spark.read.parquet(lake.business("grid_monthly"))
    assert rows_of(monthly, "year", "month", "gloom_partial") == [(2024, 1, 31.8)]  # latest year only


def test_rerun_changes_nothing(spark, lake):
    def content():
        return rows_of(spark.read.parquet(lake.layer("observations")).drop("obs_time"))

    before = content()
    jobs.build_observations(spark, lake)
    assert content() == before


def test_live_run_leaves_other_folders_alone(spark, lake):
    def counts():
        return dict(spark.read.parquet(lake.layer("observations")).groupBy("source").count().collect())

    before = counts()
    jobs.build_observations(spark, lake, sources=("live",))
    assert counts() == before and before["official"] == 160


def test_mid_month_range_keeps_whole_months(spark, lake):
    jobs.build_observations(spark, lake, sources=("official",), start=date(2024, 1, 15), end=date(2024, 1, 20))
    stored = jobs.observations(spark, lake)
    assert stored.filter("source = 'official' AND month = 1").count() == 4 * 31
    assert stored.filter("source = 'official'").count() == 160


def test_area_codes_stay_text(spark, lake):
    stored = jobs.observations(spark, lake)
    assert dict(stored.dtypes)["dept"] == "string" and stored.filter("dept = '06'").count() == 80


def test_whole_months():
    assert layers.whole_months(date(2024, 2, 10), date(2024, 2, 11)) == (date(2024, 2, 1), date(2024, 2, 29))
    assert layers.whole_months(None, None) == (None, None)


def test_optional_table_hides_only_missing_paths(spark, tmp_path):
    assert layers.optional_table(spark, str(tmp_path / "none")) is None
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        layers.optional_table(spark, str(broken)).collect()


def test_first_present_and_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    assert layers.first_present(spark, [path], {"a": "int"}).collect() == []
    layers.write_small_table(spark.range(3), path)
    assert layers.first_present(spark, [path + "-x", path], {"id": "bigint"}).count() == 3


def test_small_table_is_one_file(spark, tmp_path):
    layers.write_small_table(spark.range(0, 1000, 1, 8), str(tmp_path / "t"))
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 1


def test_partition_folders_get_one_file_each(spark, tmp_path):
    df = spark.range(0, 2000, 1, 8).withColumn("g", F.col("id") % 5)
    layers.write_partitions(df, str(tmp_path / "t"), ["g"])
    files = [p.parent.name for p in (tmp_path / "t").rglob("*.parquet")]
    assert sorted(files) == [f"g={i}" for i in range(5)]


def test_newest_write(spark, tmp_path):
    layers.write_small_table(spark.range(3), str(tmp_path / "t"))
    assert layers.newest_write(spark, str(tmp_path / "t")).collect()[0][0] is not None


def test_path_fields(spark, tmp_path):
    write_lot(tmp_path, "dept=06/x/snapshot=2024-01-01", ("a", "b"), [{"a": 1}])
    rows = raw.with_path_field(raw.read_csv_lots(spark, str(tmp_path), ("a", "b")), "dept", "dept=([^/]+)")
    assert rows_of(rows) == [("1", None, "2024-01-01", "06")]


def test_mainland_filter(spark):
    df = spark.createDataFrame([("06",), ("2A",), ("2C",), ("FRA",), ("9",), (None,)], "dept string")
    assert rows_of(clean.mainland_areas(df)) == [("06",), ("2A",)]


def test_reports(spark, lake):
    tables = jobs.layer_report(spark, lake, "a")
    assert tables["duplicate station days"].collect()[0][0] == 0
    assert tables["duplicate quarter hours"].collect()[0][0] == 0
    assert tables["named station"].count() == 8 and tables["last live rows"].count() == 5
    found = jobs.business_report(spark, lake)
    assert [r.gloom_rank for r in found["ranking"].collect()] == [1, 1]
    assert found["longest cold spells"].count() == 1
    assert found["worst days of the last year"].filter("year <> 2024").count() == 0
    counts = jobs.table_counts(spark, lake, ["episodes", "absent"])
    assert rows_of(counts) == [("episodes", 4)]


def test_streams_of_a_lake_feed_the_batch_jobs(spark, tmp_path):
    from wxlake.streaming import live

    lake = jobs.Lake(str(tmp_path / "lake"))
    write_json_lines(tmp_path / "in" / "a.txt", [
        {"ingested_at": f"2024-01-10T10:{m:02d}:30Z", "city": "Lille", "dept": "59",
         "time": f"2024-01-10T10:{m // 15 * 15:02d}", "temperature_2m": float(m)} for m in range(0, 40)])
    lines = live.file_source(spark, str(tmp_path / "in"), "value string", "text")
    messages = lines.withColumn("timestamp", F.get_json_object("value", "$.ingested_at").cast("timestamp"))
    jobs.start_landing(lake, messages, available_now=True)
    jobs.start_live_table(lake, messages, available_now=True)
    assert jobs.build_observations(spark, lake, sources=("live",)) == 3
    assert jobs.build_business_tables(spark, lake, scope="live") == ["live_status"]
    batch = spark.read.parquet(lake.business("live_status"))
    stream = spark.read.parquet(lake.business("live_latest"))
    assert rows_of(stream, "obs_time", "gloom_live") == rows_of(batch, "obs_time", "gloom_live")
    assert stream.collect()[0].temperature == 39.0
    jobs.start_live_changes(lake, messages, available_now=True)
    assert rows_of(jobs.live_changes(spark, lake), "obs_time", "gloom_live") == rows_of(batch, "obs_time", "gloom_live")


def test_job_command_line(spark, lake, capsys):
    import run_job

    for line in (["alerts"], ["business", "--scope", "live"], ["grid-index", "--years", "2023-2024"],
                 ["comparison"], ["report"], ["observations", "--sources", "live", "--start", "2024-01-01"],
                 ["hourly", "--complete-only"], ["grid"]):
        run_job.run(spark, run_job.arguments([*line, "--lake", lake.root]))
    said = capsys.readouterr().out
    assert "4 rows" in said and "live_vs_official" in said and "runs per type" in said
    monthly = spark.read.parquet(lake.business("grid_monthly"))
    assert sorted(r[0] for r in monthly.select("year").distinct().collect()) == [2023, 2024]


def test_fallback_on_an_empty_table_has_one_schema(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path))
    runs = spark.sql("SELECT '59' dept, 'Lille' city, 'cold_spell' type, DATE'2024-01-01' start_date, "
                     "DATE'2024-01-04' end_date, 4L n_days, -5.0D intensity")
    assert jobs.served_episodes(spark, lake).count() == 0
    layers.write_small_table(runs, lake.business("episodes"))
    alone = jobs.served_episodes(spark, lake)
    layers.write_small_table(layers.empty_table(spark, schemas.EPISODES_ALERTS), lake.business("episodes_alerts"))
    beside_empty = jobs.served_episodes(spark, lake)
    assert alone.schema == beside_empty.schema and "max_color" in alone.columns
    assert alone.collect() == beside_empty.collect() and alone.count() == 1


def _poll(city, moment, temperature):
    return {"ingested_at": moment + ":30Z", "city": city, "dept": "59", "time": moment, "temperature_2m": temperature}


def test_live_cycle_keeps_silent_cities_and_replaces_months(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path))
    live = Path(lake.raw("live"))
    write_json_lines(live / "ingest_date=2024-01-10" / "a.txt", [_poll("Lille", "2024-01-10T10:00", 1.0), _poll("Lyon", "2024-01-10T10:00", 2.0)])
    jobs.build_observations(spark, lake, ("live",))
    assert jobs.build_live_tables(spark, lake, since=date(2024, 2, 1)) == ["live_status"]  # nothing stored: in full
    write_json_lines(live / "ingest_date=2024-02-03" / "a.txt", [_poll("Lille", "2024-02-03T10:00", 3.0), _poll("Lille", "2024-02-02T10:00", 4.0)])
    jobs.build_observations(spark, lake, ("live",), date(2024, 2, 3))
    jobs.build_live_tables(spark, lake, since=date(2024, 2, 3))
    cycle = spark.read.parquet(lake.business("live_status")).collect()
    assert sorted((r.city, r.temperature) for r in cycle) == [("Lille", 3.0), ("Lyon", 2.0)]
    jobs.build_live_tables(spark, lake)
    assert sorted(map(tuple, spark.read.parquet(lake.business("live_status")).collect())) == sorted(map(tuple, cycle))


def test_a_range_prunes_folders(spark, tmp_path):
    live = tmp_path / "live"
    write_json_lines(live / "ingest_date=2024-01-10" / "a.txt", [_poll("Lille", "2024-01-10T10:00", 1.0)])
    write_json_lines(live / "ingest_date=2024-03-10" / "a.txt", [_poll("Lille", "2024-03-10T10:00", 1.0)])
    late = raw.read_live_messages(spark, str(live), date(2024, 3, 1))
    plan = late._jdf.queryExecution().toString()
    assert late.count() == 1 and "PartitionFilters: [isnotnull(ingest_date" in plan
    columns = schemas.DAILY_MAIN_COLUMNS
    for period in ("previous-1950-2024", "latest-2025-2026"):
        write_lot(tmp_path, f"dept=59/period={period}/family=RR-T-Vent/snapshot=2026-01-01", columns, [{"NUM_POSTE": period}])
    read = raw.read_daily_family(spark, str(tmp_path), "RR-T-Vent", start=date(2025, 5, 1))
    assert rows_of(read, "NUM_POSTE") == [("latest-2025-2026",)]
    assert raw.read_daily_family(spark, str(tmp_path), "RR-T-Vent", end=date(1940, 1, 1)).count() == 0


def test_markers_are_found_without_reading_data_files(spark, tmp_path):
    columns = schemas.DAILY_MAIN_COLUMNS
    for dept, marker in (("01", True), ("02", False), ("0 3", True)):
        write_lot(tmp_path, f"dept={dept}/period=p/family=RR-T-Vent/snapshot=2026-01-01", columns, [{"NUM_POSTE": dept}], marker)
    found = raw.complete_lots(spark, f"{tmp_path}/dept=*/period=*/family=*/snapshot=*")
    assert found.count() == 2
    rows = raw.read_daily_family(spark, str(tmp_path), "RR-T-Vent", complete_only=True)
    assert rows_of(rows, "NUM_POSTE") == [("0 3",), ("01",)]
