"""Streams with state and the compacted log."""

import shutil

import pytest
from conftest import moment, rows_of
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from wxlake.operators.dedup import latest_per_key
from wxlake.streaming import live, log, state

READING = "city string, at timestamp, polled timestamp, temp double"
KEYS, NEWEST = ["city", "at"], ["polled"]


def reading(city, at, polled, temp):
    return (city, moment(f"2024-01-{at}"), moment(f"2024-01-{polled}"), temp)


FEED = [
    [reading("Lille", "01 10:00", "01 10:01", 1.0), reading("Nice", "01 10:00", "01 10:01", 9.0)],
    # A newer poll, a repeated delivery, and a poll that is late but not too late.
    [reading("Lille", "01 10:00", "01 10:05", 2.0), reading("Nice", "01 10:00", "01 10:01", 9.0), reading("Lille", "01 09:45", "01 09:46", -1.0)],
    [reading("Lille", "01 15:00", "01 15:01", 3.0), reading("Lille", "01 10:00", "01 10:02", 7.0)],
    [reading("Nice", "01 16:00", "01 16:01", 6.0)],
    # Older than the hours that the state waits, and later than the batch after which that is known.
    [reading("Nice", "01 09:00", "01 15:30", 5.0)],
]
TOO_LATE = FEED[4][0]


@pytest.fixture
def feed(spark, tmp_path):
    def write(batches, name="in"):
        for rows in batches:
            spark.createDataFrame(rows, READING).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        return live.file_source(spark, str(tmp_path / name), READING, files_per_batch=1)

    return write


def states(query):
    return [[op.numRowsTotal for op in p.stateOperators] for p in query.recentProgress]


def test_repeats_go_and_too_late_rows_are_counted(spark, tmp_path, feed):
    rows = state.drop_repeats(feed(FEED), ["city", "at", "polled"], "at", "2 hours")
    query = state.append_closed(rows, str(tmp_path / "out"), str(tmp_path / "mark"), available_now=True)
    found = rows_of(spark.read.parquet(str(tmp_path / "out")), "city", "at", "polled", "temp")
    assert found == sorted({r for rows in FEED for r in rows} - {TOO_LATE}, key=repr)
    assert live.rows_dropped(query) == 1


def test_closed_keys_are_sent_once_and_forgotten(spark, tmp_path, feed):
    end = [reading(None, "30 00:00", "30 00:00", None)]
    rows = state.closed_newest(feed([*FEED, end]), KEYS, NEWEST, "at", "4 hours")
    query = state.append_closed(rows, str(tmp_path / "out"), str(tmp_path / "mark"), available_now=True)
    kept = [r for rows in FEED for r in rows if r != TOO_LATE]
    wanted = latest_per_key(spark.createDataFrame(kept, READING), KEYS, NEWEST)
    assert rows_of(spark.read.parquet(str(tmp_path / "out")), *KEYS, "temp") == rows_of(wanted, *KEYS, "temp")
    assert live.rows_dropped(query) == 1
    assert states(query)[-1] == [1, 1]  # what ended the feed is all that is held


def test_state_stays_bounded_over_a_long_feed(spark, tmp_path, feed):
    batches = [[reading("Lille", f"{d:02d} {h:02d}:00", f"{d:02d} {h:02d}:01", float(h)) for h in range(24)] for d in range(1, 9)]
    rows = state.closed_newest(feed(batches), KEYS, NEWEST, "at", "6 hours")
    query = state.append_closed(rows, str(tmp_path / "out"), str(tmp_path / "mark"), available_now=True)
    assert max(max(s) for s in states(query)) <= 24 + 24 + 6
    assert spark.read.parquet(str(tmp_path / "out")).count() == 8 * 24 - 6


def test_the_event_time_must_be_a_key(spark, feed):
    with pytest.raises(ValueError, match="at"):
        state.closed_newest(feed(FEED[:1]), ["city"], NEWEST, "at", "1 hour")


def changes(spark, tmp_path, rows, silent, **options):
    changed = state.newest_per_key(rows, "city", ["at", "polled"], "at", "6 hours", silent)
    query = log.write_log(changed, str(tmp_path / "log"), str(tmp_path / "mark"), ["city"], by_batch=True, mode="update",
                          available_now=True, **options)
    return dict(changed.dtypes), query


def test_newest_per_city_writes_only_what_changed(spark, tmp_path, feed):
    schema, query = changes(spark, tmp_path, feed(FEED), "30 days", compact_every=None)
    rows = log.current_rows(spark, str(tmp_path / "log"), schema, ["city"], by_batch=True)
    assert rows_of(rows, "city", "temp") == [("Lille", 3.0), ("Nice", 6.0)]
    written = {n: rows_of(spark.read.parquet(str(tmp_path / "log" / f"batch={n}")), "city", "temp") for n in range(5)}
    # The repeated and the late polls change nothing and are not written.
    assert written == {0: [("Lille", 1.0), ("Nice", 9.0)], 1: [("Lille", 2.0)], 2: [("Lille", 3.0)], 3: [("Nice", 6.0)], 4: []}
    assert states(query)[-1] == [2]


def test_silent_cities_go_and_may_come_back(spark, tmp_path, feed):
    later = [
        [reading("Lille", "03 10:00", "03 10:01", 4.0)], [reading("Lille", "03 10:15", "03 10:16", 4.5)], [reading("Nice", "03 11:00", "03 11:01", 8.0)]]
    rows = feed([*FEED, *later[:2]])
    schema, query = changes(spark, tmp_path, rows, "12 hours")
    current = log.current_rows(spark, str(tmp_path / "log"), schema, ["city"], by_batch=True)
    assert rows_of(current, "city", "temp") == [("Lille", 4.5)]
    assert states(query)[-1] == [1]
    changes(spark, tmp_path, feed(later[2:]), "12 hours")
    current = log.current_rows(spark, str(tmp_path / "log"), schema, ["city"], by_batch=True)
    assert rows_of(current, "city", "temp") == [("Lille", 4.5), ("Nice", 8.0)]


def test_nulls_and_ties_do_not_depend_on_the_order(spark, tmp_path, feed):
    tied = [reading("Nice", "01 10:00", "01 10:01", t) for t in (2.0, None, 5.0)] + [("Oslo", moment("2024-01-01 10:00"), None, 1.0)]
    for name, rows in (("a", tied), ("b", tied[::-1])):
        folder = tmp_path / name
        schema, _ = changes(spark, folder, feed([[r] for r in rows], name + "-in"), "30 days")
        found = log.current_rows(spark, str(folder / "log"), schema, ["city"], by_batch=True)
        assert rows_of(found, "city", "temp") == [("Nice", 5.0), ("Oslo", 1.0)]


def many(n):
    """Each batch renews two keys and brings one of its own."""
    return [[(k, i) for k in (i % 5, (i + 1) % 5, 100 + i)] for i in range(n)]


def run_log(spark, tmp_path, batches, **options):
    for rows in batches:
        spark.createDataFrame(rows, "k int, t int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = live.file_source(spark, str(tmp_path / "in"), "k int, t int", files_per_batch=1)
    return log.write_log(stream, str(tmp_path / "log"), str(tmp_path / "mark"), ["k"], ["t"], available_now=True, **options)


SCHEMA = {"k": "int", "t": "int"}


def read_log(spark, tmp_path):
    return rows_of(log.current_rows(spark, str(tmp_path / "log"), SCHEMA, ["k"], ["t"]))


def newest(batches):
    return sorted({k: t for rows in batches for k, t in rows}.items(), key=repr)


def test_compaction_bounds_the_folders_and_changes_no_row(spark, tmp_path):
    seen = []
    batches = many(12)
    run_log(spark, tmp_path, batches, compact_every=3, after=lambda n: seen.append(
        (n, len(log.open_folders(spark, str(tmp_path / "log"))), len(list((tmp_path / "log").iterdir())), read_log(spark, tmp_path))))
    assert [s[0] for s in seen] == list(range(12))
    for number, opened, stored, rows in seen:
        assert rows == newest(batches[: number + 1])
        assert opened <= 4 and stored <= 9
    assert log.snapshots(spark, str(tmp_path / "log"))


def test_a_stop_halfway_through_a_compaction_is_harmless(spark, tmp_path):
    batches = many(6)
    run_log(spark, tmp_path, batches, compact_every=None)
    path, wanted = str(tmp_path / "log"), newest(batches)
    kept = tmp_path / "kept"
    shutil.copytree(path, kept)
    assert log.compact(spark, path, SCHEMA, ["k"], ["t"]) == 5 and read_log(spark, tmp_path) == wanted
    (tmp_path / "log" / "snapshot=5" / "_SUCCESS").unlink()  # as if it had stopped while writing
    assert log.snapshots(spark, path) == [] and read_log(spark, tmp_path) == wanted
    assert log.compact(spark, path, SCHEMA, ["k"], ["t"], up_to=3) == 3 and read_log(spark, tmp_path) == wanted
    assert log.compact(spark, path, SCHEMA, ["k"], ["t"]) == 5 and read_log(spark, tmp_path) == wanted
    for n in range(4):  # as if it had stopped before it removed the old batches
        if not (tmp_path / "log" / f"batch={n}").exists():
            shutil.copytree(kept / f"batch={n}", tmp_path / "log" / f"batch={n}")
    assert read_log(spark, tmp_path) == wanted and log.compact(spark, path, SCHEMA, ["k"], ["t"]) == 5


def test_a_reader_that_has_begun_can_finish(spark, tmp_path):
    batches = many(6)
    run_log(spark, tmp_path, batches, compact_every=None)
    path = str(tmp_path / "log")
    log.compact(spark, path, SCHEMA, ["k"], ["t"], up_to=2)
    begun = log.current_rows(spark, path, SCHEMA, ["k"], ["t"])
    log.compact(spark, path, SCHEMA, ["k"], ["t"])
    assert rows_of(begun) == newest(batches)


@pytest.mark.parametrize("compact_every", [None, 2])
def test_a_batch_that_fails_before_its_commit_is_neither_lost_nor_doubled(spark, tmp_path, compact_every):
    batches, failed = many(6), []

    def fail_once(number):
        if number in (1, 4) and number not in failed:
            failed.append(number)
            raise RuntimeError("lost before the commit")

    for rows in batches:
        spark.createDataFrame(rows, "k int, t int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="lost before the commit"):
            run_log(spark, tmp_path, [], compact_every=compact_every, after=fail_once)
    run_log(spark, tmp_path, [], compact_every=compact_every, after=fail_once)
    assert failed == [1, 4] and read_log(spark, tmp_path) == newest(batches)
    if not compact_every:
        rows = spark.read.parquet(*log.open_folders(spark, str(tmp_path / "log")))
        assert rows.count() == sum(map(len, batches)) and rows.select(F.count_distinct("k", "t")).first()[0] == rows.count()


def test_ties_do_not_depend_on_the_batch(spark, tmp_path):
    columns = "k int, t int, v int"
    for i, v in enumerate((5, 9, 7)):
        spark.createDataFrame([(1, 1, v)], columns).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = live.file_source(spark, str(tmp_path / "in"), columns, files_per_batch=1)
    log.write_log(stream, str(tmp_path / "log"), str(tmp_path / "mark"), ["k"], ["t"], compact_every=1, available_now=True)
    schema = {"k": "int", "t": "int", "v": "int"}
    assert rows_of(log.current_rows(spark, str(tmp_path / "log"), schema, ["k"], ["t"])) == [(1, 1, 9)]


def test_an_empty_log(spark, tmp_path):
    assert read_log(spark, tmp_path) == []
    assert log.compact(spark, str(tmp_path / "log"), SCHEMA, ["k"], ["t"]) is None
