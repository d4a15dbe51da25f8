"""Streams: landing, restart, live table, rate."""

from pathlib import Path

import pytest
from conftest import moment, rows_of, write_json_lines
from pyspark.sql import functions as F

from wxlake import schemas
from wxlake.checks import bindings as b
from wxlake.checks import queries
from wxlake.operators import clean, dedup, rollup
from wxlake.sources import raw
from wxlake.streaming import live

SF = "/root/testdata/sf0.001"


def poll(at, city, time, temp):
    return {"ingested_at": f"2024-01-01T{at}:00Z", "city": city, "dept": "59", "time": f"2024-01-01T{time}",
            "temperature_2m": temp, "cloud_cover": 50.0, "precipitation": 0.0, "wind_speed_10m": 18.0,
            "relative_humidity_2m": 70.0}


BATCHES = [
    [poll("10:01", "Lille", "10:00", 1.0), poll("10:01", "Nice", "10:00", 9.0)],
    [poll("10:05", "Lille", "10:00", 2.0), poll("10:16", "Lille", "10:15", 3.0)],
    # Late: an older poll of a quarter hour already seen, and of one not seen.
    [poll("10:00", "Lille", "10:00", -9.0), poll("09:50", "Nice", "09:45", 8.0)],
]


def source(spark, folder):
    lines = live.file_source(spark, str(folder), "value string", "text", files_per_batch=1)
    return lines.withColumn("timestamp", F.get_json_object("value", "$.ingested_at").cast("timestamp"))


def feed(folder, number):
    write_json_lines(folder / f"batch-{number}.txt", BATCHES[number])


def test_landing_restart_and_orphan_file(spark, tmp_path):
    inbox, out, mark = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "mark")
    feed(inbox, 0)
    live.land_raw(source(spark, inbox), out, mark, available_now=True)
    live.land_raw(source(spark, inbox), out, mark, available_now=True)  # nothing new
    assert raw.read_live_messages(spark, out).count() == 2
    feed(inbox, 1)
    live.land_raw(source(spark, inbox), out, mark, available_now=True)
    (tmp_path / "raw" / "ingest_date=2024-01-01" / "part-99.txt").write_text('{"city": "Nowhere"}\n')
    landed = raw.read_live_messages(spark, out)
    assert landed.count() == 4 and landed.filter("city = 'Nowhere'").count() == 0
    first = spark.read.text(out).filter("value like '%Nice%'").collect()[0]
    assert '"temperature_2m": 9.0' in first.value and str(first.ingest_date) == "2024-01-01"


@pytest.fixture
def fed(tmp_path):
    for n in range(len(BATCHES)):
        feed(tmp_path / "in", n)
    return tmp_path


def batch_rows(spark, folder):
    """The same messages through the batch code."""
    raw_rows = spark.read.schema(schemas.ddl(schemas.LIVE_MESSAGE)).json(str(folder))
    return rollup.live_index(clean.live_observations(raw_rows))


def test_log_gives_the_batch_result(spark, fed):
    rows = live.live_rows(source(spark, fed / "in")).select("station_id", "obs_time", "ingested_at", "gloom_live")
    keys = ["station_id", "obs_time"]
    live.log_latest(rows, str(fed / "log"), str(fed / "mark"), keys, ["ingested_at"], available_now=True)
    log = spark.read.parquet(str(fed / "log"))
    assert log.select("batch").distinct().count() == 3
    latest = dedup.latest_per_key(log.drop("batch"), keys, ["ingested_at"])
    wanted = batch_rows(spark, fed / "in")
    assert rows_of(latest, *keys, "gloom_live") == rows_of(wanted, *keys, "gloom_live")
    assert latest.count() == 4


def test_live_table_keeps_the_newest_row_per_city(spark, fed):
    rows = live.live_rows(source(spark, fed / "in")).select("station_id", "obs_time", "ingested_at", "temperature")
    path = str(fed / "table")
    arguments = (rows, path, str(fed / "mark"), ["station_id"], ["obs_time", "ingested_at"])
    live.upsert_latest(*arguments, available_now=True)
    table = live.current_version(spark, path, dict(rows.dtypes))
    assert rows_of(table, "station_id", "obs_time", "temperature") == [
        ("Lille", moment("2024-01-01 10:15"), 3.0), ("Nice", moment("2024-01-01 10:00"), 9.0)]
    live.upsert_latest(*arguments, available_now=True)  # restart without new input
    assert rows_of(live.current_version(spark, path, dict(rows.dtypes))) == rows_of(table)


def test_rate_on_a_stream_equals_the_batch_count(spark, fed):
    stream = live.message_rate(source(spark, fed / "in"))
    live.log_updates(stream, str(fed / "rate"), str(fed / "mark"), available_now=True)
    updates = spark.read.parquet(str(fed / "rate")).groupBy("window_start").agg(F.max("n").alias("n"))
    lines = spark.read.text(str(fed / "in")).withColumn(
        "timestamp", F.get_json_object("value", "$.ingested_at").cast("timestamp"))
    batch = live.message_rate(lines)
    assert rows_of(updates) == rows_of(batch, "window_start", "n")
    assert batch.filter("per_second <> n / 300").count() == 0


def test_keyed_json_and_record_assembly(spark):
    cities = spark.createDataFrame([("Nice", "06"), ("Lille", "59")], "city string, dept string")
    blocks = spark.createDataFrame([("Lille", 1.5), ("Oslo", 0.0), ("Nice", 9.0)], "city string, temperature_2m double")
    records = live.assemble_records(cities, blocks, F.lit("2024-01-01T10:00:00Z"))
    found = live.keyed_json(records).select("key", F.get_json_object("value", "$.dept"), F.get_json_object("value", "$.temperature_2m"))
    assert rows_of(found) == [("Lille", "59", "1.5"), ("Nice", "06", "9.0")]


def test_error_lines(spark):
    lines = spark.createDataFrame([("a ERROR b",), ("java.lang.Exception",), ("Traceback (most",), ("error",), ("fine",)], "value string")
    assert live.error_lines(lines).count() == 3


def test_kafka_needs_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        live.kafka_source(spark, "localhost:1", "t")
    records = spark.createDataFrame([("Nice", 1.0)], "city string, t double")
    with pytest.raises(Exception, match="(?i)kafka"):
        live.publish(records, "localhost:1", "t")


def test_old_versions_go_and_unfinished_ones_are_not_read(spark, tmp_path):
    path = str(tmp_path / "table")
    columns = {"k": "int", "t": "int"}
    for i in range(6):
        spark.createDataFrame([(1, i), (10 + i, 0)], "k int, t int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    rows = live.file_source(spark, str(tmp_path / "in"), "k int, t int", files_per_batch=1)
    live.upsert_latest(rows, path, str(tmp_path / "checkpoint"), ["k"], ["t"], available_now=True, keep=2)
    assert live.versions(spark, path) == [4, 5]
    spark.createDataFrame([(99, 99)], "k int, t int").write.parquet(f"{path}/version=6")
    (tmp_path / "table" / "version=6" / "_SUCCESS").unlink()
    found = live.current_version(spark, path, columns)
    assert rows_of(found) == [(1, 5), *[(10 + i, 0) for i in range(6)]]
    assert live.current_version(spark, str(tmp_path / "none"), columns).count() == 0


def test_rows_dropped_by_the_watermark_are_counted(spark, tmp_path):
    for i, moment in enumerate(("2024-01-02 10:00:00", "2024-01-02 12:00:00", "2024-01-01 00:00:00")):
        spark.sql(f"SELECT TIMESTAMP'{moment}' AS timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    rows = live.file_source(spark, str(tmp_path / "in"), "timestamp timestamp", files_per_batch=1)
    query = live.log_updates(live.message_rate(rows), str(tmp_path / "log"), str(tmp_path / "checkpoint"), available_now=True)
    assert live.rows_dropped(query) == 1


def test_log_by_day_is_pruned(spark, tmp_path):
    data = spark.sql("SELECT * FROM VALUES (1, DATE'2024-01-01', 5), (1, DATE'2024-01-02', 6) AS t(k, d, t)")
    data.write.parquet(str(tmp_path / "in"))
    rows = live.file_source(spark, str(tmp_path / "in"), data.schema)
    live.log_latest(rows, str(tmp_path / "log"), str(tmp_path / "checkpoint"), ["k", "d"], ["t"], available_now=True, day="d")
    log = spark.read.schema(data.schema).parquet(str(tmp_path / "log")).filter("d = DATE'2024-01-02'")
    assert log.count() == 1 and "PartitionFilters: [isnotnull(d" in log._jdf.queryExecution().toString()


@pytest.mark.skipif(not Path(SF).exists(), reason="no tables")
def test_feeds_grow_in_files_and_are_dealt_without_the_raw_layer(spark, monkeypatch):
    monkeypatch.setattr(queries, "FILE_MESSAGES", 5)
    monkeypatch.setattr(b, "_STAGED", {})
    n = b.table(spark, SF, "events").count()
    queries._message_stream(spark, SF)
    queries._timed_stream(spark, SF)
    folders = {key[2]: folder for key, folder in b._STAGED.items()}
    assert set(folders) == {"dealt-messages", "timed-messages"}
    dealt, lines = spark.read.text(folders["dealt-messages"]), b.message_lines(spark, SF).select("value")
    assert dealt.count() == n and dealt.exceptAll(lines).count() == 0
    assert len(dealt.inputFiles()) > 8 and all(f.endswith(".gz") for f in dealt.inputFiles())
    feed = spark.read.text(f"{folders['timed-messages']}/feed")
    assert n < feed.count() < 1.3 * n and feed.distinct().exceptAll(lines).count() == 0 and len(feed.inputFiles()) > 8


@pytest.mark.skipif(not Path(SF).exists(), reason="no tables")
def test_a_larger_inbox_is_written_by_more_tasks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "FILE_MESSAGES", 5)
    monkeypatch.setattr(queries, "fresh_folder", lambda _, label: str(tmp_path / label))
    found = queries.QUERIES["stream_checkpoint_resume"](spark, SF).first()
    n = b.table(spark, SF, "events").count()
    assert (found.n_rows, found.n_messages) == (n, n)
    assert len(spark.read.text(str(tmp_path / "resumed" / "inbox")).inputFiles()) > 6
