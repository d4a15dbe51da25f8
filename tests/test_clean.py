"""Raw files to layer tables, from hand-written lots."""

import pytest
from conftest import day, moment, rows_of, write_json_lines, write_lot
from pyspark.sql import functions as F

from wxlake import schemas
from wxlake.operators import clean, dedup
from wxlake.sources import raw

MAIN, OTHER = schemas.DAILY_MAIN_COLUMNS, schemas.DAILY_OTHER_COLUMNS


def station(number="06000001", date="20240101", **values):
    return {"NUM_POSTE": number, "NOM_USUEL": "A", "LAT": "43.5", "LON": "7.1", "ALTI": "10",
            "AAAAMMJJ": date, **values}


def main_frame(spark, tmp_path, rows, path="dept=06/period=p/family=RR-T-Vent/snapshot=2024-02-01"):
    write_lot(tmp_path, path, MAIN, rows)
    return raw.read_daily_family(spark, str(tmp_path), "RR-T-Vent", MAIN)


def test_quality_codes_and_malformed_numbers(spark, tmp_path):
    rows = [
        station("06000001", TM="5.5", QTM="1"), station("06000002", TM="5.5", QTM="2"),
        station("06000003", TM="5.5", QTM=None), station("06000004", TM="abc", QTM="1"),
        station("06000005", TM="5.5", QTM="x"), station("06000006", TM="5.5", QTM="9"),
    ]
    found = clean.daily_main(main_frame(spark, tmp_path, rows))
    assert rows_of(found, "station_id", "temperature") == [
        ("06000001", 5.5), ("06000002", None), ("06000003", 5.5), ("06000004", None),
        ("06000005", None), ("06000006", 5.5),
    ]


def test_newest_snapshot_wins_and_missing_snapshot_loses(spark, tmp_path):
    for path, value in (("dept=06/period=old/family=RR-T-Vent", "1"),
                        ("dept=06/period=new/family=RR-T-Vent/snapshot=2024-02-01", "2"),
                        ("dept=06/period=new/family=RR-T-Vent/snapshot=2024-02-02", "3")):
        write_lot(tmp_path, path, MAIN, [station(TM=value)])
    rows = raw.read_daily_family(spark, str(tmp_path), "RR-T-Vent", MAIN)
    assert rows_of(rows, "snapshot", "TM") == sorted(
        [(None, "1"), ("2024-02-01", "2"), ("2024-02-02", "3")], key=repr)
    assert rows_of(clean.daily_main(rows), "temperature") == [(3.0,)]


def test_unparsable_dates_are_dropped(spark, tmp_path):
    rows = [station(date="20240101"), station(date="20241301"), station(date=None), station(date="soon")]
    assert rows_of(clean.daily_main(main_frame(spark, tmp_path, rows)), "obs_date") == [(day("2024-01-01"),)]


def test_ties_do_not_depend_on_input_order(spark, tmp_path):
    tied = main_frame(spark, tmp_path, [station(TM="1"), station(TM="7"), station(TM="3")])
    for partitions in (1, 3, 5):
        found = clean.daily_main(tied.repartition(partitions, F.rand(partitions)))
        assert rows_of(found, "temperature") == [(7.0,)]


def test_families_join_keeps_main_only(spark, tmp_path):
    write_lot(tmp_path, "dept=06/period=p/family=RR-T-Vent/snapshot=2024-02-01", MAIN,
              [station("06000001", TM="1"), station("06000002", TM="2")])
    write_lot(tmp_path, "dept=06/period=p/family=autres-parametres/snapshot=2024-02-01", OTHER, [
        {"NUM_POSTE": "06000001", "AAAAMMJJ": "20240101", "INST": "120", "QINST": "1"},
        {"NUM_POSTE": "06000009", "AAAAMMJJ": "20240101", "INST": "60"},
    ])
    root = str(tmp_path)
    found = clean.official_observations(
        raw.read_daily_family(spark, root, "RR-T-Vent", MAIN),
        raw.read_daily_family(spark, root, "autres-parametres", OTHER),
    )
    assert found.columns == list(schemas.OBSERVATIONS)
    assert rows_of(found, "source", "dept", "station_id", "sunshine_min", "cloud_cover_pct") == [
        ("official", "06", "06000001", 120.0, None), ("official", "06", "06000002", None, None),
    ]


def test_extra_columns_come_from_the_header(spark, tmp_path):
    columns = ("NUM_POSTE", "EXTRA", *MAIN[1:])
    write_lot(tmp_path, "dept=06/period=p/family=RR-T-Vent", columns, [{**station(TM="4"), "EXTRA": "?"}])
    rows = raw.read_daily_family(spark, str(tmp_path), "RR-T-Vent")
    assert rows_of(clean.daily_main(rows), "station_name", "temperature") == [("A", 4.0)]


def test_wrong_column_order_is_refused(spark, tmp_path):
    write_lot(tmp_path, "dept=06/period=p/family=RR-T-Vent", tuple(reversed(MAIN)), [station(TM="4")])
    with pytest.raises(Exception, match="(?i)header|schema"):
        raw.read_daily_family(spark, str(tmp_path), "RR-T-Vent", MAIN).collect()


def test_only_complete_lots_are_read(spark, tmp_path):
    path = "dept=06/period=p/family=RR-T-Vent/snapshot=2024-02-0"
    write_lot(tmp_path, path + "1", MAIN, [station("06000001")])
    write_lot(tmp_path, path + "2", MAIN, [station("06000002")], marker=False)
    both = raw.read_daily_family(spark, str(tmp_path), "RR-T-Vent", MAIN)
    complete = raw.read_daily_family(spark, str(tmp_path), "RR-T-Vent", MAIN, complete_only=True)
    assert both.count() == 2
    assert rows_of(complete, "NUM_POSTE", "snapshot") == [("06000001", "2024-02-01")]


def message(**values):
    base = {"ingested_at": "2024-01-01T10:00:00Z", "city": "Nice", "dept": "06", "latitude": 43.7,
            "longitude": 7.2, "elevation": 10.0, "time": "2024-01-01T10:00"}
    return {**base, **values}


def test_live_messages(spark, tmp_path):
    write_json_lines(tmp_path / "ingest_date=2024-01-01" / "part-0.txt", [
        message(temperature_2m=1.0, wind_speed_10m=36.0, weather_code=45),
        message(ingested_at="2024-01-01T10:00:30Z", temperature_2m=2.0, wind_speed_10m=36.0, weather_code=45),
        message(time="2024-01-01T10:15", weather_code=None),
        message(time="2024-01-01T10:30", weather_code=3),
        message(time="broken"),
    ])
    found = clean.live_observations(raw.read_live_messages(spark, str(tmp_path)))
    assert rows_of(found, "obs_time", "temperature", "wind_speed_ms", "fog", "weather_code") == [
        (moment("2024-01-01 10:00"), 2.0, 10.0, 1.0, 45),
        (moment("2024-01-01 10:15"), None, None, None, None),
        (moment("2024-01-01 10:30"), None, None, 0.0, 3),
    ]


def test_grid_decimal_comma_and_reference(spark, tmp_path):
    reference = tmp_path / "kind=grille"
    reference.mkdir()
    (reference / "grid.csv").write_text(
        "LAMBX (hm);LAMBY (hm);LAT_DG;LON_DG\n80;160;43,25;7,5\n", encoding="utf-8")
    base = {"LAMBX": "80", "LAMBY": "160", "T": "2,5"}
    write_lot(tmp_path, "kind=mens/year=2024/snapshot=2024-02-01", schemas.GRID_MONTHLY_COLUMNS,
              [{**base, "DATE": "202401", "PRETOTM": "10"}])
    write_lot(tmp_path, "kind=quot_latest/snapshot=2024-02-01", schemas.GRID_DAILY_COLUMNS, [
        {**base, "DATE": "20240105", "PRELIQ": "1,5", "PRENEI": "0,5", "FF": "3", "HU": "80", "SSI": "900"},
        {**base, "DATE": "20240106", "PRELIQ": "1,5"},
        {**base, "LAMBX": "999", "DATE": "20240105", "PRELIQ": "1", "PRENEI": "1"},
    ])
    root = str(tmp_path)
    values = clean.union_sources(
        clean.grid_monthly(raw.read_grid_values(spark, root, "mens")),
        clean.grid_daily(raw.read_grid_values(spark, root, "quot_latest")),
    )
    table = clean.grid_table(values, clean.grid_reference(raw.read_grid_reference(spark, f"{root}/kind=grille")))
    assert rows_of(table, "kind", "obs_date", "temp", "precip_mm", "ssi", "lat") == [
        ("daily", day("2024-01-05"), 2.5, 2.0, 900.0, 43.25),
        ("daily", day("2024-01-06"), 2.5, None, None, 43.25),
        ("monthly", day("2024-01-01"), 2.5, 10.0, None, 43.25),
    ]


def area(code, color, items):
    return {"domain_id": code, "max_color_id": color, "phenomenon_items": [
        {"phenomenon_id": p, "phenomenon_max_color_id": c} for p, c in items]}


def test_alert_documents(spark, tmp_path):
    import json

    folder = tmp_path / "date=2024-01-05"
    folder.mkdir()
    document = {"product": {"periods": [
        {"echeance": "J", "timelaps": {"domain_ids": [
            area("06", 3, [("1", "3"), (2, 1)]), area("2A", "1", []), area("FRA", 4, [("1", 4)])]}},
        {"echeance": "J", "timelaps": {"domain_ids": [area("06", 2, [("1", 2)])]}},
        {"echeance": "J1", "timelaps": {"domain_ids": [area("75", 4, [("7", 4)])]}},
    ]}}
    (folder / "CDP_CARTE_EXTERNE.json").write_text(json.dumps(document, indent=1), encoding="utf-8")
    found = clean.alert_rows(raw.read_alert_documents(spark, str(tmp_path)))
    assert rows_of(found, "dept", "dept_max_color_id", "phenomenon_id", "color_id", "phenomene") == sorted([
        ("06", 3, 1, 3, "vent_violent"), ("06", 3, 2, 1, "pluie_inondation"),
        ("06", 2, 1, 2, "vent_violent"), ("2A", 1, None, None, None),
    ], key=repr)
    assert found.select("vig_date").distinct().collect()[0][0] == day("2024-01-05")


def test_bom_and_nested_messages(spark):
    lines = spark.createDataFrame([
        ('﻿{"ingested_at": "x", "poll": 1, "city": "Nice", "current": {"time": "t", "temperature_2m": 3.5}}',),
        ("  ",), ("",), (' {"city": "Lyon", "poll": 2, "current": {"weather_code": 3}}',),
    ], "value string")
    found = raw.parse_nested_messages(lines)
    assert rows_of(found, "city", "poll", "time", "temperature_2m", "weather_code") == [
        ("Lyon", 2, None, None, 3), ("Nice", 1, "t", 3.5, None)]


def test_area_from_file_name(spark):
    name = spark.range(1).select(raw.area_of_file(F.lit("a/b/Q_2A_latest_x.csv.gz")).alias("v"))
    assert name.collect()[0][0] == "2A"


def test_latest_per_key_is_idempotent_and_ignores_older(spark):
    rows = [(k, s, v) for k in range(20) for s, v in ((1, 10 * k), (2, 10 * k + 1))]
    df = spark.createDataFrame(rows, "k int, s int, v int")
    once = dedup.latest_per_key(df, ["k"], ["s"])
    again = dedup.latest_per_key(once, ["k"], ["s"])
    older = dedup.latest_per_key(df.union(spark.createDataFrame([(3, 0, 99)], "k int, s int, v int")), ["k"], ["s"])
    assert rows_of(once) == rows_of(again) == rows_of(older) == sorted(
        [(k, 2, 10 * k + 1) for k in range(20)], key=repr)
    assert dedup.duplicate_keys(df, ["k"]).collect()[0][0] == 20
    assert dedup.duplicate_keys(once, ["k"]).collect()[0][0] == 0
