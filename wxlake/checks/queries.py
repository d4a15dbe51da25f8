"""Registered queries: each runs an operator over whole tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxlake import dimensions, schemas
from wxlake.checks import bindings as b
from wxlake.checks import oracle as o
from wxlake.checks.oracle import rnd, sql
from wxlake.functions import dates, geo, labels, numbers
from wxlake.operators import (
    alerts, clean, compare, dedup, episodes, fields, forecast, history, joins, lots, maps, profile, ranking, rollup, serve,
)
from wxlake.plans import lake as jobs
from wxlake.session import fresh_folder, pin_session
from wxlake.sources import layers, raw
from wxlake.streaming import live as streams
from wxlake.streaming import log as stream_log
from wxlake.streaming import state as stream_state

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, twin: str | None = None):
    """Register a query and its SQL twin."""

    def register(build):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return build(pin_session(spark), sf)

        QUERIES[name] = run
        if twin is not None:
            ORACLES[name] = sql(twin)
        return build

    return register


def _daily(spark, sf) -> DataFrame:
    return rollup.area_daily(b.observations(spark, sf), max_elevation=b.MAX_ELEVATION)


def _last_day(spark, sf):
    """Last day of the lowland observations, without building the daily table."""
    rows = rollup.lowland(b.observations(spark, sf), max_elevation=b.MAX_ELEVATION)
    return rows.agg(F.max("obs_date").alias("last")).scalar()


def _runs(spark, sf) -> DataFrame:
    return episodes.detect_runs(_daily(spark, sf))


def _live(spark, sf) -> DataFrame:
    return rollup.live_index(b.live_observations(spark, sf))


def _compared(spark, sf) -> DataFrame:
    return compare.live_vs_official(
        compare.live_days(b.live_observations(spark, sf), b.MIN_POINTS),
        compare.official_days(b.hourly_observations(spark, sf), b.MIN_HOURS),
    )


def _checked_runs(spark, sf) -> DataFrame:
    return alerts.check_runs(_runs(spark, sf), b.alerts(spark, sf), b.ARCHIVE_START)


def _plain_time(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


OBS = o.OBS_COLUMNS.split(", ")

# -- sources -------------------------------------------------------------------


@query("scan_csv_snapshots", """
    SELECT station_id, strftime(obs_date, '%Y%m%d') AS day, snapshot, tm, elevation, l_orderkey FROM raw""")
def _(spark, sf):
    family = lots.FAMILIES[0]
    rows = raw.read_daily_family(spark, b.stage_daily(spark, sf, family), family, b.MAIN_TEXT)
    return b.typed_ties(rows, b.DAILY_TIES).select(
        F.col("NUM_POSTE").alias("station_id"), F.col("AAAAMMJJ").alias("day"), "snapshot",
        numbers.number(F.col("TM")).alias("tm"), numbers.number(F.col("ALTI")).alias("elevation"),
        "l_orderkey",
    )


@query("scan_grid_ref", "SELECT lambx, lamby, lat, lon FROM gridref")
def _(spark, sf):
    folder = b.stage_grid(spark, sf)
    return clean.grid_reference(raw.read_grid_reference(spark, f"{folder}/kind=grille"))


@query("scan_json_lines", """
    SELECT ingested_at, city, dept, strftime(obs_time, '%Y-%m-%dT%H:%M') AS time, temperature_2m,
      weather_code, wind_speed_10m FROM messages""")
def _(spark, sf):
    return raw.read_live_messages(spark, b.stage_messages(spark, sf)).select(
        "ingested_at", "city", "dept", "time", "temperature_2m", "weather_code", "wind_speed_10m"
    )


@query("scan_json_document", """
    SELECT vig_date, count(DISTINCT term) AS n_periods, count(DISTINCT (term, dept)) AS n_areas
    FROM alert_orders GROUP BY vig_date""")
def _(spark, sf):
    documents = raw.read_alert_documents(spark, b.stage_alerts(spark, sf), "*.txt")
    areas = F.flatten("product.periods.timelaps.domain_ids")
    return documents.select(
        "vig_date", F.size("product.periods").cast("bigint").alias("n_periods"),
        F.size(areas).cast("bigint").alias("n_areas"),
    )


@query("path_column", """
    SELECT dept, family, snapshot, count(*) AS n_rows FROM raw,
      (VALUES ('RR-T-Vent'), ('autres-parametres')) AS f(family) GROUP BY 1, 2, 3""")
def _(spark, sf):
    root = b.stage_daily(spark, sf)
    parts = [
        raw.read_daily_family(spark, root, family, names).select("NUM_POSTE", "snapshot", "_metadata")
        for family, names in (("RR-T-Vent", b.MAIN_TEXT), ("autres-parametres", b.OTHER_TEXT))
    ]
    rows = parts[0].unionByName(parts[1])
    path = F.col("_metadata.file_path")
    return rows.select(
        F.regexp_extract(path, "dept=([^/]+)", 1).alias("dept"),
        F.regexp_extract(path, "family=([^/]+)", 1).alias("family"), "snapshot",
    ).groupBy("dept", "family", "snapshot").agg(F.count("*").alias("n_rows"))


def _layer(spark, sf) -> str:
    """Observations as a stored layer table."""
    def write(folder):
        rows = clean.with_month(b.observations(spark, sf))
        layers.write_partitions(rows, folder, ["source", "year", "month"])
    return b.staged(spark, sf, "observations", write)


LAYER_SCHEMA = {**schemas.OBSERVATIONS, "year": "int", "month": "int"}


@query("scan_parquet_layer", f"""
    SELECT cast(month(obs_date) as integer) AS month, count(*) AS n_rows,
      count(temperature) AS n_temperature FROM obs
    WHERE year(obs_date) = 1998 AND source = 'official' GROUP BY 1""")
def _(spark, sf):
    stored = layers.read_layer(spark, _layer(spark, sf), LAYER_SCHEMA)
    wanted = stored.filter((F.col("source") == "official") & (F.col("year") == 1998))
    return wanted.groupBy("month").agg(
        F.count("*").alias("n_rows"), F.count("temperature").alias("n_temperature")
    )


@query("optional_table", "SELECT dept, count(*) AS n_rows, 1 AS n_skipped FROM obs GROUP BY dept")
def _(spark, sf):
    paths = [_layer(spark, sf), f"{_layer(spark, sf)}-absent"]
    found = [t for p in paths if (t := layers.optional_table(spark, p, LAYER_SCHEMA)) is not None]
    rows = clean.union_sources(*found)
    return layers.counts_by(rows, "dept").withColumn("n_skipped", F.lit(len(paths) - len(found)))


@query("empty_on_missing", "SELECT DISTINCT obs_date, cast(NULL as varchar) AS note FROM obs")
def _(spark, sf):
    """The first table is absent, the second empty, the third has the rows and lacks a column."""
    path, empty = _layer(spark, sf), fresh_folder(spark, "empty")
    layers.write_small_table(layers.empty_table(spark, {"obs_date": "date", "note": "string"}), empty)
    found = layers.first_present(
        spark, [f"{path}-dates", empty, path, empty], {"obs_date": "date", "note": "string"})
    return found.distinct()


def _event_stream(spark, sf):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    # A pattern matches the table whether it is one file or a folder of files.
    return streams.file_source(spark, f"{sf}/events.parque[t]", schema)


@query("stream_source", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, sf):
    folder = fresh_folder(spark, "stream")
    rows = _event_stream(spark, sf).select("event_id", "user_id", "event_type", "value")
    rows.writeStream.format("parquet").option("path", f"{folder}/rows").option(
        "checkpointLocation", f"{folder}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/rows")


@query("list_partitions", "SELECT DISTINCT cast(year(obs_date) as integer) AS year FROM obs")
def _(spark, sf):
    return layers.folder_values(spark, _layer(spark, sf), ["year"])


@query("complete_lots_only", """
    SELECT station_id, strftime(obs_date, '%Y%m%d') AS day, snapshot, l_orderkey FROM raw
    WHERE (cast(dept as integer) + cast(substr(snapshot, 10) as integer)) % 2 = 0""")
def _(spark, sf):
    """Every second lot has its marker, by area and snapshot."""
    family = lots.FAMILIES[0]
    root = b.stage_daily(spark, sf, family)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop_path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for lot in files.globStatus(hadoop_path(f"{root}/dept=*/period=*/family={family}/snapshot=*")):
        folder = lot.getPath().toString()
        area, snapshot = (re.search(f"{k}=([^/]+)", folder)[1] for k in ("dept", "snapshot"))
        if (int(area) + int(snapshot[-1])) % 2 == 0:
            files.create(hadoop_path(f"{folder}/{raw.MARKER}"), True).close()
    rows = raw.read_daily_family(spark, root, family, b.MAIN_TEXT, complete_only=True)
    return b.typed_ties(rows, b.DAILY_TIES).select(
        F.col("NUM_POSTE").alias("station_id"), F.col("AAAAMMJJ").alias("day"), "snapshot", "l_orderkey")


@query("keyed_lots", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def _(spark, sf):
    rows = b.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    markers = b.table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("l_orderkey")
    )
    return lots.complete_lots(rows, markers, ["l_orderkey"])


@query("grid_source_fallback", """
    SELECT d.obs_date,
      CASE WHEN g.n IS NOT NULL THEN 'grid_daily' WHEN m.n IS NOT NULL THEN 'grid_monthly'
        ELSE 'stations' END AS grid_source, coalesce(g.n, m.n, 0) AS n_cells
    FROM (SELECT DISTINCT obs_date FROM obs WHERE elevation <= 6000) d
    LEFT JOIN (SELECT obs_date, count(*) AS n FROM cell_day
        WHERE obs_date >= (SELECT max(obs_date) FROM cell_day) - 60 GROUP BY 1) g ON d.obs_date = g.obs_date
    LEFT JOIN (SELECT year, month, count(*) AS n FROM cell_month GROUP BY 1, 2) m
      ON year(d.obs_date) = m.year AND month(d.obs_date) = m.month""")
def _(spark, sf):
    grid = b.grid(spark, sf)
    window = serve.trailing_days(grid.filter("kind = 'daily'"), "obs_date", 60)
    lowland = rollup.lowland(b.observations(spark, sf), max_elevation=b.MAX_ELEVATION)
    return maps.grid_source_by_day(
        lowland, rollup.cell_day_measures(window),
        rollup.cell_month_measures(grid, "1900-2100"),
    )


# -- sinks ---------------------------------------------------------------------


@query("write_partitions", """
    SELECT source, cast(year(obs_date) as integer) AS year, cast(month(obs_date) as integer) AS month,
      count(*) AS n_rows, cast(sum(cast(temperature as bigint)) as bigint) AS temperature_sum FROM obs GROUP BY 1, 2, 3""")
def _(spark, sf):
    path = fresh_folder(spark, "partitions")
    rows = clean.with_month(b.observations(spark, sf))
    layers.write_partitions(rows, path, ["source", "year", "month"])
    return layers.read_layer(spark, path, LAYER_SCHEMA).groupBy("source", "year", "month").agg(
        F.count("*").alias("n_rows"), F.sum(F.col("temperature").cast("bigint")).alias("temperature_sum")
    )


@query("write_small_table", """
    SELECT year, month, dept, city, mean_gloom, mean_temp, rain_total_mm, mean_sun_min, n_days, gloom_rank
    FROM ranking""")
def _(spark, sf):
    path = fresh_folder(spark, "ranking")
    layers.write_small_table(ranking.monthly_ranking(_daily(spark, sf)), path)
    return layers.read_layer(spark, path)


@query("read_back_counts", "SELECT source, count(*) AS n_rows, count(*) AS n_written FROM obs GROUP BY source")
def _(spark, sf):
    path = fresh_folder(spark, "counted")
    written = layers.write_counted(
        b.observations(spark, sf), lambda df: layers.write_partitions(df, path, ["source"]), "written"
    )
    stored = layers.read_layer(spark, path, schemas.OBSERVATIONS)
    return layers.counts_by(stored, "source").withColumn("n_written", F.lit(written).cast("bigint"))


@query("publish_keyed_json", """
    SELECT m.city AS key, m.city, m.dept, f.lat AS latitude, ingested_at, temperature_2m, weather_code
    FROM messages m JOIN feat f ON m.city = f.city""")
def _(spark, sf):
    blocks = b.live_messages(spark, sf).select(
        "city", F.col("ingested_at").alias("polled_at"), "temperature_2m", "weather_code"
    )
    cities = dimensions.featured(spark).withColumnRenamed("lat", "latitude").drop("lon")
    records = streams.assemble_records(cities, blocks, F.col("polled_at")).drop("polled_at")
    published = streams.keyed_json(records)
    fields = "ingested_at string, city string, dept string, latitude double, temperature_2m double, weather_code int"
    return published.select("key", F.from_json("value", fields).alias("v")).select("key", "v.*")


# -- projections ---------------------------------------------------------------


@query("quality_null", f"SELECT {o.OBS_COLUMNS} FROM obs")
def _(spark, sf):
    return b.observations(spark, sf).select(*OBS)


@query("decimal_comma", """
    SELECT lambx, lamby, strftime(day, '%Y%m%d') AS day, temp, snapshot, o_orderkey FROM mesh""")
def _(spark, sf):
    return b.grid_text(spark, sf, "daily").select(
        F.col("LAMBX").try_cast("int").alias("lambx"), F.col("LAMBY").try_cast("int").alias("lamby"),
        F.col("DATE").alias("day"), numbers.decimal_comma(F.col("T")).alias("temp"),
        "snapshot", "o_orderkey",
    )


@query("rename_cast_project", f"SELECT {o.OBS_COLUMNS} FROM obs_newest")
def _(spark, sf):
    main = b.daily_text(spark, sf, schemas.DAILY_MAIN_COLUMNS)
    other = b.daily_text(spark, sf, schemas.DAILY_OTHER_COLUMNS)
    return clean.official_observations(main, other, b.DAILY_TIES).select(*OBS)


@query("job_path", f"""
    SELECT {o.OBS_COLUMNS} FROM ({o.newest_lot(o.MAIN_COLUMNS)}) m
    JOIN ({o.newest_lot(o.OTHER_COLUMNS)}) x USING (station_id, obs_date)""")
def _(spark, sf):
    """Files to observations as the job does it: header columns, ties by the cleaned columns.

    The files have one column that the model does not have, so the header line counts.
    """
    root = b.stage_daily(spark, sf, ties=["l_linenumber"])
    main, other = (raw.read_daily_family(spark, root, family) for family in lots.FAMILIES)
    return clean.official_observations(main, other).select(*OBS)


@query("unit_convert", """
    SELECT event_id, wind_speed_10m / 3.6e0 AS wind_ms, (wind_speed_10m / 3.6e0) * 3.6e0 AS wind_kmh
    FROM messages""")
def _(spark, sf):
    speed = numbers.kmh_to_ms(F.col("wind_speed_10m"))
    return b.live_messages(spark, sf).select(
        "event_id", speed.alias("wind_ms"), numbers.ms_to_kmh(speed).alias("wind_kmh")
    )


@query("area_from_station", "SELECT dept, count(*) AS n_rows FROM raw GROUP BY dept")
def _(spark, sf):
    station = clean.area_of_station(F.col("NUM_POSTE"))
    return layers.counts_by(b.daily_rows(spark, sf).select(station.alias("dept")), "dept")


@query("code_flag", """
    SELECT event_id, weather_code, CASE WHEN weather_code IN (45, 48) THEN 1e0
      WHEN weather_code IS NOT NULL THEN 0e0 END AS fog FROM messages""")
def _(spark, sf):
    return b.live_messages(spark, sf).select(
        "event_id", "weather_code", numbers.code_flag(F.col("weather_code"), clean.FOG_CODES).alias("fog")
    )


@query("typed_null_pad", """
    SELECT 'daily' AS kind, count(*) AS n_rows, count(wind_ms) AS n_wind, count(ssi) AS n_ssi
    FROM grid WHERE kind = 'daily'
    UNION ALL SELECT 'monthly', count(*), count(wind_ms), count(ssi) FROM grid WHERE kind = 'monthly'""")
def _(spark, sf):
    return b.grid(spark, sf).groupBy("kind").agg(
        F.count("*").alias("n_rows"), F.count("wind_ms").alias("n_wind"), F.count("ssi").alias("n_ssi")
    )


@query("map_lookup", """
    SELECT phenomenon_id, phenomene, city, count(*) AS n_rows
    FROM alerts LEFT JOIN areas ON alerts.dept = areas.dept GROUP BY 1, 2, 3""")
def _(spark, sf):
    rows = rollup.with_city(b.alerts(spark, sf))
    return layers.counts_by(rows, "phenomenon_id", "phenomene", "city")


@query("sum_of_phases", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0
      THEN cast(o_orderkey % 25 + o_orderkey % 3 as double) END AS precip_mm FROM orders""")
def _(spark, sf):
    rows = b.grid_text(spark, sf, "daily")
    both = clean.sum_of_phases(F.col("PRELIQ"), F.col("PRENEI"))
    return rows.select("o_orderkey", both.alias("precip_mm"))


@query("derive_partitions", """
    SELECT cast(year(l_shipdate) as integer) AS year, cast(month(l_shipdate) as integer) AS month,
      count(*) AS n_rows FROM lineitem GROUP BY 1, 2""")
def _(spark, sf):
    rows = b.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("obs_date"))
    return layers.counts_by(clean.with_month(rows), "year", "month")


@query("round_outputs", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, {rnd('l_extendedprice * l_discount', 0)} AS r0,
      {rnd('l_extendedprice * l_discount', 1)} AS r1, {rnd('l_extendedprice * l_discount', 2)} AS r2,
      {rnd('l_extendedprice * l_discount', 3)} AS r3 FROM lineitem""")
def _(spark, sf):
    value = F.col("l_extendedprice") * F.col("l_discount")
    return b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        *[numbers.stable_round(value, n).alias(f"r{n}") for n in range(4)],
    )


# -- filters -------------------------------------------------------------------


@query("source_and_level_filter", f"""
    SELECT {o.OBS_COLUMNS} FROM obs WHERE source = 'official' AND elevation <= {b.MAX_ELEVATION}""")
def _(spark, sf):
    return rollup.lowland(b.observations(spark, sf), max_elevation=b.MAX_ELEVATION).select(*OBS)


@query("date_range", """
    SELECT station_id, obs_date, temperature FROM obs
    WHERE obs_date BETWEEN date '1997-02-01' AND date '1998-02-28'""")
def _(spark, sf):
    rows = layers.month_range(
        b.observations(spark, sf), "obs_date", date(1997, 2, 10), date(1998, 2, 15)
    )
    return rows.select("station_id", "obs_date", "temperature")


@query("not_null_key", """
    SELECT doc_id, cast(strptime(d, '%Y%m%d') as date) AS day FROM (
      SELECT doc_id, cast(19900000 + (doc_id % 14) * 100 + doc_id % 32 as varchar) AS d FROM documents)
    WHERE try_strptime(d, '%Y%m%d') IS NOT NULL""")
def _(spark, sf):
    key = F.col("doc_id")
    text = (F.lit(19900000) + key % 14 * 100 + key % 32).cast("string")
    rows = b.table(spark, sf, "documents").select("doc_id", dates.parse_day(text).alias("day"))
    return clean.not_null_key(rows, "day")


@query("regex_filter", """
    SELECT vig_date, dept, phenomenon_id, color_id FROM alert_orders
    WHERE regexp_matches(dept, '^([0-9]{2}|2A|2B)$')""")
def _(spark, sf):
    rows = clean.mainland_areas(b.alert_orders(spark, sf), "area")
    return rows.select("vig_date", F.col("area").alias("dept"), "phenomenon_id", "color_id")


@query("like_filter", """
    SELECT s_suppkey, s_name, s_name LIKE '%Supplier#%9%' AS exact_case FROM supplier
    WHERE s_name ILIKE '%SUPPLIER#%9%'""")
def _(spark, sf):
    name = F.col("s_name")
    return b.table(spark, sf, "supplier").filter(name.ilike("%SUPPLIER#%9%")).select(
        "s_suppkey", "s_name", name.like("%Supplier#%9%").alias("exact_case")
    )


@query("threshold_flag", "SELECT dept, city, obs_date, type, v AS value FROM flagged")
def _(spark, sf):
    return episodes.flag_days(_daily(spark, sf))


@query("in_years", """
    SELECT kind, year, cellx, celly, temp FROM grid
    WHERE kind = 'monthly' AND (year BETWEEN 1996 AND 1997 OR year = 1999
      OR year = (SELECT max(year) FROM grid WHERE kind = 'monthly'))""")
def _(spark, sf):
    monthly = rollup.cellify(b.grid(spark, sf).filter("kind = 'monthly'"))
    chosen = [rollup.in_years(monthly, years) for years in ("1996-1997", "1999", "")]
    return clean.union_sources(*chosen).select("kind", "year", "cellx", "celly", "temp")


@query("point_lookup_day", f"""
    SELECT {', '.join(serve.DAY_COLUMNS)} FROM daily WHERE obs_date = date '1998-09-02'""")
def _(spark, sf):
    return serve.day_lookup(_daily(spark, sf), "1998-09-02")


@query("trailing_days", f"""
    SELECT {', '.join(serve.CHART_COLUMNS)} FROM daily
    WHERE obs_date >= (SELECT max(obs_date) FROM daily) - 30""")
def _(spark, sf):
    return serve.chart_rows(_daily(spark, sf), 30, _last_day(spark, sf))


@query("latest_month", """
    SELECT year, month, dept, city, mean_gloom, mean_temp, rain_total_mm, mean_sun_min, n_days, gloom_rank
    FROM ranking WHERE year * 100 + month = (SELECT max(year * 100 + month) FROM ranking)""")
def _(spark, sf):
    return serve.month_ranking(ranking.monthly_ranking(_daily(spark, sf)))


@query("given_month", """
    SELECT year, month, dept, city, mean_gloom, mean_temp, rain_total_mm, mean_sun_min, n_days, gloom_rank
    FROM ranking WHERE year = 1995 AND month = 7""")
def _(spark, sf):
    return serve.month_ranking(ranking.monthly_ranking(_daily(spark, sf)), 1995, 7)


@query("echeance_filter", """
    SELECT DISTINCT vig_date, dept FROM alert_orders WHERE term = 'J' AND dept <> 'FRA'""")
def _(spark, sf):
    return clean.alert_rows(b.alert_documents(spark, sf), "J").select("vig_date", "dept").distinct()


@query("selected_entities", """
    SELECT dept, city, obs_date, gloom FROM daily WHERE city IN (SELECT city FROM feat)""")
def _(spark, sf):
    return ranking.selected_cities(_daily(spark, sf)).select("dept", "city", "obs_date", "gloom")


@query("dates_for_year", """
    SELECT cast(year(obs_date) as integer) AS year, min(obs_date) AS first_day, max(obs_date) AS last_day,
      count(DISTINCT obs_date) AS n_days FROM obs GROUP BY 1""")
def _(spark, sf):
    return serve.days_by_year(b.observations(spark, sf))


@query("days_of_year", """
    SELECT cast(year(obs_date) as integer) AS year, min(obs_date) AS first_day, max(obs_date) AS last_day,
      count(DISTINCT obs_date) AS n_days FROM obs WHERE year(obs_date) = 1995 GROUP BY 1""")
def _(spark, sf):
    return serve.days_of_year(b.observations(spark, sf), 1995)


@query("last_batch", """
    SELECT event_id, city, temperature_2m FROM messages
    WHERE strftime(ts, '%Y-%m-%d') = (SELECT max(strftime(ts, '%Y-%m-%d')) FROM messages)""")
def _(spark, sf):
    polled = b.live_messages(spark, sf).withColumn("poll", F.to_date("timestamp"))
    return serve.last_batch(polled, "poll").select("event_id", "city", "temperature_2m")


@query("preview_or_head", """
    SELECT * FROM (SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_name ILIKE '%SUPPLIER#%7%'
      ORDER BY s_suppkey LIMIT 8)
    UNION ALL SELECT * FROM (SELECT s_suppkey, s_name, s_acctbal FROM supplier ORDER BY s_suppkey LIMIT 5)""")
def _(spark, sf):
    stations = b.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    named = serve.preview(stations, "s_name", "SUPPLIER#%7", ["s_suppkey"])
    missing = serve.preview(stations, "s_name", "MONTSOURIS", ["s_suppkey"])
    return named.unionByName(missing)


# -- joins ---------------------------------------------------------------------


@query("left_join_families", """
    SELECT station_id, obs_date, temperature, precipitation_mm, sunshine_min, humidity_pct, fog
    FROM obs_newest""")
def _(spark, sf):
    joined = clean.join_families(
        clean.daily_main(b.daily_text(spark, sf, schemas.DAILY_MAIN_COLUMNS), b.DAILY_TIES),
        clean.daily_other(b.daily_text(spark, sf, schemas.DAILY_OTHER_COLUMNS), b.DAILY_TIES),
    )
    return joined.select(
        "station_id", "obs_date", "temperature", "precipitation_mm", "sunshine_min", "humidity_pct", "fog"
    )


GRID_COLUMNS = "kind, lambx, lamby, obs_date, temp, precip_mm, wind_ms, humidity_pct, ssi, lat, lon"


@query("inner_join_grid_ref", f"SELECT {GRID_COLUMNS} FROM grid")
def _(spark, sf):
    return b.grid(spark, sf).select(*GRID_COLUMNS.split(", "))


@query("inner_join_compare", "SELECT * FROM compared")
def _(spark, sf):
    return _compared(spark, sf)


@query("left_join_rain", f"""
    SELECT 'official' AS side, dept, obs_day, {rnd('temp_off', 4)} AS temp, {rnd('precip_off', 4)} AS precip FROM official
    UNION ALL SELECT 'live', dept, obs_day, {rnd('temp_live', 4)}, {rnd('precip_live', 4)} FROM live_day""")
def _(spark, sf):
    official = compare.official_days(b.hourly_observations(spark, sf), b.MIN_HOURS)
    live = compare.live_days(b.live_observations(spark, sf), b.MIN_POINTS)

    def side(df, name, temp, rain):
        return df.select(
            F.lit(name).alias("side"), "dept", "obs_day",
            numbers.stable_round(F.col(temp), 4).alias("temp"),
            numbers.stable_round(F.col(rain), 4).alias("precip"),
        )

    return side(official, "official", "temp_off", "precip_off").unionByName(
        side(live, "live", "temp_live", "precip_live")
    )


@query("left_join_alerts", """
    SELECT r.dept, type, r.day, r.phenomenon_id, color_id FROM run_days r LEFT JOIN alert_top a
      ON r.day = a.day AND r.dept = a.dept AND r.phenomenon_id = a.phenomenon_id""")
def _(spark, sf):
    days = alerts.run_days(_runs(spark, sf))
    return alerts.join_alerts(days, b.alerts(spark, sf)).select(
        "dept", "type", "day", "phenomenon_id", "color_id"
    )


@query("left_join_evaluable", """
    SELECT dept, type, r.day, CASE WHEN m.day IS NOT NULL THEN 1 END AS evaluable
    FROM run_days r LEFT JOIN map_days m ON r.day = m.day""")
def _(spark, sf):
    days = alerts.run_days(_runs(spark, sf))
    return alerts.join_evaluable(days, b.alerts(spark, sf)).select("dept", "type", "day", "evaluable")


CHECKED = "dept, city, type, start_date, end_date, n_days, intensity, alert_days, coverage_rate, max_color, status"


@query("rejoin_coverage", f"SELECT {CHECKED} FROM checked_runs")
def _(spark, sf):
    return _checked_runs(spark, sf)


@query("groupwise_max_join", """
    SELECT d.city, obs_date, d.gloom, temp_avg, precip_mm, sunshine_min, wind_ms FROM daily d
    JOIN (SELECT city, max(gloom) AS gloom FROM daily GROUP BY city) w ON d.city = w.city AND d.gloom = w.gloom""")
def _(spark, sf):
    return ranking.worst_days(_daily(spark, sf)).select(
        "city", "obs_date", "gloom", "temp_avg", "precip_mm", "sunshine_min", "wind_ms"
    )


ORDERED_LOTS = f"""
    SELECT DISTINCT {o.area('c_nationkey')} AS dept, family, period,
      CASE WHEN snaps THEN least(end_day, run_day) END AS snapshot
    FROM (SELECT c_nationkey, c_custkey, min(cast(o_orderdate as date)) - 20000 AS start_day,
            max(cast(o_orderdate as date)) + 9000 AS end_day, date '2025-06-30' AS run_day
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
    JOIN (VALUES ('avant-1949', 0, 1949, false), ('previous-1950-2024', 1950, 2024, false),
      ('latest-2025-2026', 2025, 9999, true)) AS p(period, y0, y1, snaps)
      ON year(start_day) <= y1 AND year(end_day) >= y0,
    (VALUES ('RR-T-Vent'), ('autres-parametres')) AS f(family)"""


def _planned(spark, sf) -> DataFrame:
    """One request per customer: the span of its orders, stretched over the periods."""
    orders, customers = b.table(spark, sf, "orders"), b.table(spark, sf, "customer")
    spans = orders.groupBy("o_custkey").agg(
        F.min(F.to_date("o_orderdate")).alias("first"), F.max(F.to_date("o_orderdate")).alias("last")
    ).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return lots.daily_lots(spans.select(
        b.area_code(F.col("c_nationkey")).alias("dept"), F.date_sub("first", 20000).alias("start"),
        F.date_add("last", 9000).alias("end"), F.lit(date(2025, 6, 30)).alias("run_day"),
    ))


@query("cross_lots", f"SELECT * FROM ({ORDERED_LOTS})")
def _(spark, sf):
    return _planned(spark, sf)


@query("hourly_lots", f"""
    SELECT DISTINCT f.dept, cast(e.ts as date) AS snapshot FROM events e JOIN feat f ON true""")
def _(spark, sf):
    """The plan of one run day, for each day that has events."""
    planned = lots.plan_hourly_lots(spark, date(2025, 6, 30)).select("dept")
    days = b.table(spark, sf, "events").select(F.to_date("ts").alias("snapshot")).distinct()
    areas = planned.agg(F.collect_set("dept").alias("depts")).scalar()
    return days.select(F.explode(areas).alias("dept"), "snapshot")


@query("grid_lots", """
    WITH last AS (SELECT cast(max(o_orderdate) as date) AS d, cast(min(o_orderdate) as date) AS f FROM orders)
    SELECT 'mens' AS kind, cast(y as integer) AS year, CASE WHEN y = year(d) THEN d END AS snapshot
    FROM (SELECT d, unnest(range(year(f), year(d) + 1)) AS y FROM last)
    UNION ALL SELECT 'grille', NULL, NULL UNION ALL SELECT 'quot_latest', NULL, d FROM last""")
def _(spark, sf):
    first, last = b.table(spark, sf, "orders").agg(
        F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    return lots.plan_grid_lots(spark, first.year, last)


@query("anti_join_lots", f"""
    SELECT * FROM ({ORDERED_LOTS}) p WHERE NOT EXISTS (
      SELECT 1 FROM supplier s WHERE {o.area('s_nationkey')} = p.dept AND p.family = 'RR-T-Vent'
        AND p.period = CASE WHEN s_acctbal < 2000 THEN 'avant-1949' ELSE 'previous-1950-2024' END
        AND p.snapshot IS NULL)""")
def _(spark, sf):
    present = b.table(spark, sf, "supplier").select(
        b.area_code(F.col("s_nationkey")).alias("dept"), F.lit("RR-T-Vent").alias("family"),
        F.when(F.col("s_acctbal") < 2000, "avant-1949").otherwise("previous-1950-2024").alias("period"),
        F.lit(None).cast("date").alias("snapshot"),
    ).distinct()
    return lots.pending_lots(_planned(spark, sf), present, ["dept", "family", "period", "snapshot"])


PRODUCTIONS = """SELECT DISTINCT cast(o_orderdate as date) AS day,
    lpad(cast(o_orderkey % 4 * 6 as varchar), 2, '0') || '0000' AS t, o_orderkey % 3 AS f FROM orders"""


@query("first_production_of_day", f"""
    SELECT day, min(t) AS time FROM ({PRODUCTIONS}) WHERE f = 1 GROUP BY day""")
def _(spark, sf):
    key = F.col("o_orderkey")
    made = b.table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy").alias("y"), F.date_format("o_orderdate", "MM").alias("m"),
        F.date_format("o_orderdate", "dd").alias("d"),
        F.concat(F.lpad((key % 4 * 6).cast("string"), 2, "0"), F.lit("0000")).alias("t"),
        b.pick(["A.json", lots.ALERT_FILE, "B.json"], key % 3).alias("f"),
    ).distinct()
    # At most 4 times with 3 files a day; one tree per year.
    tree = made.groupBy("y", "m", "d", "t").agg(F.collect_list("f").alias("v"))
    for keys, entry in ((["y", "m", "d"], "t"), (["y", "m"], "d"), (["y"], "m")):
        tree = tree.groupBy(*keys).agg(
            F.map_from_entries(F.collect_list(F.struct(entry, "v"))).alias("v")
        )
    trees = tree.select(F.to_json(F.create_map("y", "v")).alias("tree"))
    return lots.first_production(trees)


IDW_ROWS, IDW_COLUMNS = 6, 5


@query("idw_cross_join", f"""
    SELECT obs_date, r AS row, c AS col, {rnd('lat', 4)} AS lat, {rnd('lon', 4)} AS lon,
      {rnd('sum(w * v) / sum(w)', 3)} AS value
    FROM (SELECT *, 1 / pow(sqrt(pow(lat - slat, 2) + pow((lon - slon) * cos(radians(46.5e0)), 2)) + 0.05e0, 2.5e0) AS w
      FROM (SELECT degrees(atan(exp(yn + r / {IDW_ROWS - 1}e0 * (ys - yn)))) * 2 - 90 AS lat,
              -5.6e0 + c / {IDW_COLUMNS - 1}e0 * (10e0 + 5.6e0) AS lon, r, c
            FROM (SELECT cast(i as integer) AS r FROM range({IDW_ROWS}) t(i)), (SELECT cast(i as integer) AS c FROM range({IDW_COLUMNS}) t(i)),
              (SELECT ln(tan(pi() / 4 + radians(51.4e0) / 2)) AS yn, ln(tan(pi() / 4 + radians(41.2e0) / 2)) AS ys)) px,
        (SELECT obs_date, f.lat AS slat, f.lon AS slon, d.temp_avg AS v
         FROM daily d JOIN feat f ON d.city = f.city WHERE d.temp_avg IS NOT NULL) st)
    GROUP BY 1, 2, 3, lat, lon""")
def _(spark, sf):
    points = maps.featured_values(_daily(spark, sf), "temp_avg")
    return maps.interpolate(points, IDW_ROWS, IDW_COLUMNS)


@query("idw_all_stations", f"""
    SELECT obs_date, r AS row, c AS col, {rnd('lat', 4)} AS lat, {rnd('lon', 4)} AS lon, {rnd('sum(w * v) / sum(w)', 3)} AS value
    FROM (SELECT *, 1 / pow(sqrt(pow(lat - slat, 2) + pow((lon - slon) * cos(radians(46.5e0)), 2)) + 0.05e0, 2.5e0) AS w
      FROM (SELECT degrees(atan(exp(yn + r / {IDW_ROWS - 1}e0 * (ys - yn)))) * 2 - 90 AS lat,
              -5.6e0 + c / {IDW_COLUMNS - 1}e0 * (10e0 + 5.6e0) AS lon, r, c
            FROM (SELECT cast(i as integer) AS r FROM range({IDW_ROWS}) t(i)), (SELECT cast(i as integer) AS c FROM range({IDW_COLUMNS}) t(i)),
              (SELECT ln(tan(pi() / 4 + radians(51.4e0) / 2)) AS yn, ln(tan(pi() / 4 + radians(41.2e0) / 2)) AS ys)) px,
        (SELECT obs_date, station_id, any_value(latitude) AS slat, any_value(longitude) AS slon, avg(temperature) AS v
         FROM obs WHERE temperature IS NOT NULL GROUP BY 1, 2) st)
    GROUP BY 1, 2, 3, lat, lon""")
def _(spark, sf):
    """A map of each day from all stations; blocks are small, so that several of each meet."""
    obs = b.observations(spark, sf)
    stations = obs.select(F.col("station_id").alias("station"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon")).distinct()
    readings = obs.select("obs_date", F.col("station_id").alias("station"), F.col("temperature").alias("value"))
    return fields.interpolate_stations(readings, stations, IDW_ROWS, IDW_COLUMNS, pixels=16, per_block=32)


@query("overlap_join", f"""
    SELECT p.o_orderkey AS period_id, c_custkey AS request_id, dept, wanted_from, wanted_to FROM (
      SELECT o_orderkey, {o.area('o_custkey % 25')} AS dept, cast(o_orderdate as date) AS starts,
        CASE WHEN o_orderkey % 97 <> 0 THEN cast(o_orderdate as date) + cast(o_orderkey % 40 as integer) END AS ends FROM orders) p
    JOIN (SELECT c_custkey, {o.area('c_nationkey')} AS dept, date '1993-01-01' + cast(c_custkey * 7 % 2000 as integer) AS wanted_from,
        date '1993-01-01' + cast(c_custkey * 7 % 2000 + c_custkey % 30 as integer) AS wanted_to FROM customer) r USING (dept)
    WHERE starts <= wanted_to AND coalesce(ends, date '9999-12-31') >= wanted_from""")
def _(spark, sf):
    """Periods as a table, one for each order and some of them open, with the requests that they cover in part."""
    orders, customers = b.table(spark, sf, "orders"), b.table(spark, sf, "customer")
    key, start = F.col("o_orderkey"), F.to_date("o_orderdate")
    periods = orders.select(
        key.alias("period_id"), b.area_code(F.col("o_custkey") % 25).alias("dept"), start.alias("starts"),
        F.when(key % 97 != 0, F.date_add(start, (key % 40).cast("int"))).alias("ends"))
    first, shift = F.lit("1993-01-01").cast("date"), F.col("c_custkey") * 7 % 2000
    requests = customers.select(
        F.col("c_custkey").alias("request_id"), b.area_code(F.col("c_nationkey")).alias("dept"),
        F.date_add(first, shift.cast("int")).alias("wanted_from"),
        F.date_add(first, (shift + F.col("c_custkey") % 30).cast("int")).alias("wanted_to"))
    pairs = joins.overlap_join(requests, periods, ("wanted_from", "wanted_to"), ("starts", "ends"), ["dept"])
    return pairs.select("period_id", "request_id", "dept", "wanted_from", "wanted_to")


_VERSIONS = """(SELECT o_orderkey % 12 AS code, cast(o_orderdate as date) AS valid_from, max('symbol ' || cast(o_custkey % 50 as varchar)) AS symbol FROM orders GROUP BY 1, 2)"""


def _symbol_versions(spark, sf):
    orders = b.table(spark, sf, "orders")
    return orders.select((F.col("o_orderkey") % 12).alias("code"), F.to_date("o_orderdate").alias("valid_from"),
        F.concat(F.lit("symbol "), (F.col("o_custkey") % 50).cast("string")).alias("symbol"))


@query("as_of_symbol", f"""
    SELECT l_orderkey, l_linenumber, l.code, day, valid_from, symbol FROM (
      SELECT l_orderkey, l_linenumber, l_partkey % 13 AS code, cast(l_shipdate as date) AS day FROM lineitem) l
    ASOF LEFT JOIN {_VERSIONS} v ON l.code = v.code AND l.day >= v.valid_from""")
def _(spark, sf):
    """The symbol of each reading's code as it was at the time, from a table of codes that change."""
    readings = b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") % 13).alias("code"), F.to_date("l_shipdate").alias("day"))
    return joins.as_of_join(readings, _symbol_versions(spark, sf), "day", "valid_from", ["code"])


@query("step_lookup", """
    SELECT event_id, v.value, bound, label FROM (SELECT event_id, (event_id * 37 % 1000) / 10e0 AS value FROM events) v
    ASOF LEFT JOIN (SELECT cast(c_custkey as double) * 3 % 90 + 5 AS bound, max(c_name) AS label FROM customer GROUP BY 1) s
      ON v.value >= s.bound""")
def _(spark, sf):
    """The label of the highest step reached, from a table of steps."""
    values = b.table(spark, sf, "events").select("event_id", (F.col("event_id") * 37 % 1000 / 10.0).alias("value"))
    steps = b.table(spark, sf, "customer").select((F.col("c_custkey").cast("double") * 3 % 90 + 5).alias("bound"), F.col("c_name").alias("label"))
    return joins.step_lookup(values, steps, "value", "bound", bin_of=F.floor("value"))


# -- a day against its history --------------------------------------------------

TENTHS = "cast(round(cast({} as decimal(28,8)), 1) * 10 as bigint)"


def _year_start(spark, sf):
    """First day of the year of the last day."""
    return F.trunc(_last_day(spark, sf), "year")


@query("history_percentile", f"""
    SELECT t.dept, t.obs_date, t.gloom, nullif(count(h.u), 0) AS n_history,
      {rnd('100e0 * count(CASE WHEN h.u <= t.u THEN 1 END) / nullif(count(h.u), 0)', 2)} AS percentile,
      {rnd('CASE WHEN stddev_pop(h.u) > 1e-6 THEN (t.u - avg(h.u)) / stddev_pop(h.u) END', 3)} AS z_score,
      CASE WHEN t.u > max(h.u) THEN 'high' WHEN t.u < min(h.u) THEN 'low' END AS record
    FROM (SELECT *, {TENTHS.format('gloom')} AS u FROM daily, anchor WHERE year = y) t
      LEFT JOIN (SELECT dept, month, {TENTHS.format('gloom')} AS u FROM daily, anchor WHERE year < y) h
      ON t.dept = h.dept AND t.month = h.month AND t.u IS NOT NULL
    GROUP BY t.dept, t.obs_date, t.gloom, t.u""")
def _(spark, sf):
    """Days of the last year among the days of the same month of all years before. Two parts of the history are merged."""
    daily, start = _daily(spark, sf), _year_start(spark, sf)
    past = daily.filter(F.col("obs_date") < start)
    early, late = past.filter("year % 2 = 0"), past.filter("year % 2 = 1")
    counts = history.merged(history.distribution(early, "gloom"), history.distribution(late, "gloom"))
    days = daily.filter(F.col("obs_date") >= start).select("dept", "month", "obs_date", "gloom")
    return history.standing(days, counts, "gloom").drop("month")


@query("records_broken", f"""
    SELECT t.dept, t.month, t.year, min(d.obs_date) AS obs_date, t.u / 10e0 AS record, t.earlier / 10e0 AS before FROM (
      SELECT n.dept, n.month, n.year, n.u, max(p.u) AS earlier
      FROM (SELECT dept, month, year, max({TENTHS.format('gloom')}) AS u FROM daily GROUP BY 1, 2, 3) n
        JOIN (SELECT dept, month, year, max({TENTHS.format('gloom')}) AS u FROM daily GROUP BY 1, 2, 3) p
        ON n.dept = p.dept AND n.month = p.month AND p.year < n.year
      GROUP BY 1, 2, 3, 4 HAVING n.u > max(p.u)) t
    JOIN daily d ON d.dept = t.dept AND d.month = t.month AND d.year = t.year AND {TENTHS.format('d.gloom')} = t.u
    GROUP BY t.dept, t.month, t.year, t.u, t.earlier""")
def _(spark, sf):
    return history.records_broken(_daily(spark, sf), "gloom")


@query("rolling_rain", f"""
    SELECT dept, obs_date, precip_mm, {', '.join(
        f"{rnd(f'sum(precip_mm) OVER w{n}', 1)} AS sum_{n}d, count(precip_mm) OVER w{n} = {n} AS complete_{n}d" for n in (3, 7, 30))}
    FROM daily WINDOW {', '.join(
        f"w{n} AS (PARTITION BY dept ORDER BY obs_date RANGE BETWEEN INTERVAL {n - 1} DAYS PRECEDING AND CURRENT ROW)" for n in (3, 7, 30))}""")
def _(spark, sf):
    """Rain of the last 3, 7 and 30 calendar days; the series have gaps and are cut into stretches of two years."""
    return history.rolling_totals(_daily(spark, sf), "precip_mm", stretch=730)


_NEXT = """(SELECT a.dept, a.obs_date, a.{0} AS x, a.{0} AS today, b.{0} AS y FROM daily a JOIN daily b
      ON a.dept = b.dept AND b.obs_date = a.obs_date + 1 WHERE a.{0} IS NOT NULL AND b.{0} IS NOT NULL)"""
_COEFFICIENTS = f"""SELECT dept, count(*) AS n, regr_intercept(y, x) AS c0, regr_slope(y, x) AS c1
      FROM {_NEXT.format('temp_avg')}, (SELECT y AS last_year FROM anchor) WHERE year(obs_date + 1) < last_year GROUP BY dept"""


@query("next_day_fit", f"SELECT dept, n, {rnd('c0', 4)} AS intercept, {rnd('c1', 4)} AS slope_0 FROM ({_COEFFICIENTS})")
def _(spark, sf):
    found = forecast.fit(_daily(spark, sf), "temp_avg", ["temp_avg"], _year_start(spark, sf))
    return found.select("dept", "n", *[numbers.stable_round(F.col(c), 4).alias(c) for c in ("intercept", "slope_0")])


@query("next_day_skill", f"""
    SELECT *, mae_fit < mae_persistence AS better FROM (
      SELECT d.dept, count(*) AS n_days, {rnd('avg(abs(c0 + c1 * x - d.y))', 3)} AS mae_fit,
        {rnd('avg(abs(today - d.y))', 3)} AS mae_persistence
      FROM {_NEXT.format('temp_avg')} d JOIN ({_COEFFICIENTS}) c ON d.dept = c.dept, anchor
      WHERE year(obs_date + 1) >= anchor.y GROUP BY d.dept)""")
def _(spark, sf):
    """Tomorrow's mean temperature from today's, judged on the last year against persistence."""
    return forecast.skill(_daily(spark, sf), "temp_avg", ["temp_avg"], _year_start(spark, sf))


# -- aggregates ----------------------------------------------------------------

DAILY0 = "dept, obs_date, temp_min, temp_max, precip_mm, wind_ms, gust_ms, sunshine_min, humidity_pct, fog, n_stations"


@query("daily_rollup", f"SELECT {DAILY0} FROM daily0")
def _(spark, sf):
    return rollup.area_day_measures(b.observations(spark, sf), b.MAX_ELEVATION).select(*DAILY0.split(", "))


MONTHLY = "year, month, dept, city, mean_gloom, mean_temp, rain_total_mm, mean_sun_min, n_days"


@query("monthly_rollup", f"SELECT {MONTHLY} FROM monthly")
def _(spark, sf):
    return ranking.monthly_rollup(_daily(spark, sf))


@query("period_rollup", "SELECT * FROM periods")
def _(spark, sf):
    return ranking.period_rollup(_daily(spark, sf), _last_day(spark, sf))


@query("grid_cell_daily", f"""
    SELECT cellx, celly, obs_date, lat, lon, {rnd('temp', 4)} AS temp, {rnd('precip_mm', 4)} AS precip_mm,
      {rnd('wind_ms', 4)} AS wind_ms, {rnd('humidity_pct', 4)} AS humidity_pct, {rnd('ssi', 4)} AS ssi FROM cell_day0""")
def _(spark, sf):
    cells = rollup.cell_day_measures(b.grid(spark, sf))
    return cells.withColumns({
        c: numbers.stable_round(F.col(c), 4) for c in ("temp", "precip_mm", "wind_ms", "humidity_pct", "ssi")
    })


@query("grid_cell_monthly", f"""
    SELECT cellx, celly, year, month, lat, lon, {rnd('temp', 4)} AS temp, {rnd('precip_mm', 4)} AS precip_mm
    FROM cell_month0""")
def _(spark, sf):
    cells = rollup.cell_month_measures(b.grid(spark, sf), "1900-2100")
    return cells.withColumns({c: numbers.stable_round(F.col(c), 4) for c in ("temp", "precip_mm")})


@query("two_level_official_temp", f"SELECT dept, obs_day, {rnd('temp_off', 4)} AS temp_off, n_hours FROM off_temp")
def _(spark, sf):
    return compare.official_days(b.hourly_observations(spark, sf), b.MIN_HOURS).select(
        "dept", "obs_day", numbers.stable_round(F.col("temp_off"), 4).alias("temp_off"), "n_hours"
    )


@query("two_level_official_rain", f"""
    SELECT t.dept, t.obs_day, {rnd('precip_off', 4)} AS precip_off FROM off_temp t
    JOIN off_rain r ON t.dept = r.dept AND t.obs_day = r.obs_day""")
def _(spark, sf):
    days = compare.official_days(b.hourly_observations(spark, sf), b.MIN_HOURS)
    return days.filter(F.col("precip_off").isNotNull()).select(
        "dept", "obs_day", numbers.stable_round(F.col("precip_off"), 4).alias("precip_off")
    )


@query("live_day", f"""
    SELECT dept, obs_day, {rnd('temp_live', 4)} AS temp_live, n_points, {rnd('precip_live', 4)} AS precip_live
    FROM live_day""")
def _(spark, sf):
    days = compare.live_days(b.live_observations(spark, sf), b.MIN_POINTS)
    return days.withColumns({c: numbers.stable_round(F.col(c), 4) for c in ("temp_live", "precip_live")})


@query("reliability", "SELECT * FROM reliability")
def _(spark, sf):
    return compare.live_reliability(_compared(spark, sf))


@query("max_alert_per_day", "SELECT * FROM alert_top")
def _(spark, sf):
    return alerts.max_alert_per_day(b.alerts(spark, sf))


@query("coverage", """
    SELECT dept, city, type, start_date, end_date, n_days, intensity, alert_days, max_color_id, evaluable_days
    FROM covered""")
def _(spark, sf):
    rows = b.alerts(spark, sf)
    days = alerts.run_days(_runs(spark, sf))
    return alerts.coverage(alerts.join_evaluable(alerts.join_alerts(days, rows), rows))


@query("distinct_dates", "SELECT DISTINCT obs_date FROM daily")
def _(spark, sf):
    return rollup.distinct_days(_daily(spark, sf)).orderBy("obs_date")


@query("duplicate_check", """
    SELECT 'daily' AS checked, count(*) AS n_duplicate_keys
      FROM (SELECT 1 FROM obs GROUP BY station_id, obs_date HAVING count(*) > 1)
    UNION ALL SELECT 'newest', 0
    UNION ALL SELECT 'live', count(*) FROM (SELECT 1 FROM live GROUP BY station_id, obs_time HAVING count(*) > 1)""")
def _(spark, sf):
    newest = clean.daily_main(b.daily_text(spark, sf, schemas.DAILY_MAIN_COLUMNS), b.DAILY_TIES)
    parts = {
        "daily": (b.observations(spark, sf), ["station_id", "obs_date"]),
        "newest": (newest, ["station_id", "obs_date"]),
        "live": (b.live_observations(spark, sf), ["station_id", "obs_time"]),
    }
    checks = [
        dedup.duplicate_keys(df, keys).select(F.lit(name).alias("checked"), "n_duplicate_keys")
        for name, (df, keys) in parts.items()
    ]
    return clean.union_sources(*checks)


@query("count_by_type", "SELECT type, count(*) AS n_runs FROM runs GROUP BY type")
def _(spark, sf):
    return episodes.runs_by_type(_runs(spark, sf))


@query("global_scalars", """
    SELECT max(obs_date) AS last_day, max(year(obs_date)) AS last_year, count(*) AS n_rows FROM obs""")
def _(spark, sf):
    rows = b.observations(spark, sf)
    return rows.agg(
        F.max("obs_date").alias("last_day"), F.max(F.year("obs_date")).cast("bigint").alias("last_year"),
        F.count("*").alias("n_rows"),
    )


@query("table_freshness", """
    SELECT m AS minutes, count(*) AS n_rows, CASE WHEN m <= 20 THEN 'fresh' WHEN m <= 90 THEN 'late' ELSE 'stale' END AS freshness
    FROM (SELECT l_linenumber * 25 AS m FROM lineitem) GROUP BY m""")
def _(spark, sf):
    """Badge of the stored table as seen some minutes after its newest write."""
    written = layers.newest_write(spark, _layer(spark, sf)).scalar()
    looks = b.table(spark, sf, "lineitem").groupBy((F.col("l_linenumber") * 25).alias("minutes")).agg(
        F.count("*").alias("n_rows"))
    seen = looks.withColumn("now", written + F.make_dt_interval(F.lit(0), F.lit(0), F.col("minutes")))
    age = (F.unix_seconds("now") - F.unix_seconds(written)) / 60
    return seen.select("minutes", "n_rows", labels.freshness(F.round(age)).alias("freshness"))


PROFILED = ("temperature", "temp_min", "temp_max", "precipitation_mm", "sunshine_min", "humidity_pct", "fog")


@query("fill_rate", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {rnd(f'100e0 * count({c}) / count(*)', 1)} AS fill_pct FROM obs" for c in PROFILED))
def _(spark, sf):
    return profile.fill_rate(b.observations(spark, sf), PROFILED)


DESCRIBED = ("temperature", "precipitation_mm", "sunshine_min", "wind_gust_ms")


@query("describe", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, {rnd(f'avg({c})', 2)} AS mean, {rnd(f'stddev_samp({c})', 2)} AS std,
      {rnd(f'min({c})', 2)} AS min, {rnd(f'quantile_cont({c}, 0.25)', 2)} AS q1, {rnd(f'quantile_cont({c}, 0.5)', 2)} AS median,
      {rnd(f'quantile_cont({c}, 0.75)', 2)} AS q3, {rnd(f'max({c})', 2)} AS max FROM obs""" for c in DESCRIBED))
def _(spark, sf):
    return profile.describe(b.observations(spark, sf), DESCRIBED)


@query("exact_quantiles", " UNION ALL ".join(
    f"""SELECT 'l_extendedprice' AS "column", {p}e0 AS p, {rnd(f'quantile_cont(l_extendedprice, {p})', 4)} AS quantile
    FROM lineitem""" for p in (0.01, 0.25, 0.5, 0.9, 0.99)))
def _(spark, sf):
    wide = profile.exact_quantiles(
        b.table(spark, sf, "lineitem"), ["l_extendedprice"], (0.01, 0.25, 0.5, 0.9, 0.99)
    )
    return wide.withColumn("quantile", numbers.stable_round(F.col("quantile"), 4))


@query("value_counts", "SELECT qfxi AS quality, count(*) AS n FROM raw GROUP BY 1")
def _(spark, sf):
    codes = b.daily_rows(spark, sf).select(F.col("QFXI").alias("quality"))
    return profile.value_counts(codes, "quality")


@query("distinct_count", """
    SELECT 'all' AS dept, count(DISTINCT station_id) AS n_distinct FROM obs
    UNION ALL SELECT dept, count(DISTINCT station_id) FROM obs GROUP BY dept""")
def _(spark, sf):
    rows = b.observations(spark, sf)
    total = profile.distinct_count(rows, "station_id").select(F.lit("all").alias("dept"), "n_distinct")
    return total.unionByName(profile.distinct_count(rows, "station_id", ["dept"]))


@query("approx_distinct_count", """
    SELECT dept, CASE WHEN count(DISTINCT station_id) <= 100 THEN count(DISTINCT station_id) END AS n_small, true AS near
    FROM obs GROUP BY dept""")
def _(spark, sf):
    """Approximate counts: equal to the exact ones for small groups, within five standard errors for all others."""
    rows = b.observations(spark, sf)
    exact = profile.distinct_count(rows, "station_id", ["dept"])
    found = profile.distinct_count(rows, "station_id", ["dept"], approx=True, error=0.01).withColumnRenamed("n_distinct", "n_near")
    off = F.abs(F.col("n_near") - F.col("n_distinct"))
    return exact.join(found, "dept").select(
        "dept", F.when(F.col("n_distinct") <= 100, F.col("n_near")).alias("n_small"), (off <= 0.05 * F.col("n_distinct")).alias("near"))


@query("area_month_profile", f"""
    SELECT year(obs_date)::integer AS year, month(obs_date)::integer AS month, dept,
      {rnd('avg(temperature)', 1)} AS mean_temp, {rnd('min(temp_min)', 1)} AS lowest_temp,
      {rnd('max(temp_max)', 1)} AS highest_temp,
      {rnd('avg(precipitation_mm) * day(last_day(any_value(obs_date)))', 1)} AS rain_mm,
      sum(CASE WHEN coalesce(frost_min, 0) > 0 THEN 1 ELSE 0 END)::bigint AS frost_days
    FROM obs GROUP BY 1, 2, 3""")
def _(spark, sf):
    return profile.area_month_profile(b.observations(spark, sf))


@query("min_max_nunique", """
    SELECT city, min(temperature_2m) AS lowest, max(temperature_2m) AS highest,
      count(DISTINCT temperature_2m) AS n_distinct FROM messages GROUP BY city""")
def _(spark, sf):
    return profile.min_max_distinct(b.live_messages(spark, sf), "temperature_2m", ["city"])


@query("national_mean_bucket", f"""
    SELECT obs_date, {rnd('m', 2)} AS mean_score, CASE WHEN m IS NOT NULL THEN {o.SKY} END AS sky
    FROM (SELECT obs_date, avg(gloom) AS m FROM daily GROUP BY obs_date)""")
def _(spark, sf):
    return serve.national_mean(_daily(spark, sf), "gloom", ["obs_date"])


@query("min_max_scale", f"""
    SELECT dept, d.obs_date, {rnd('(temp_avg - vmin) / (vmax - vmin)', 4)} AS scaled, vmin, vmax
    FROM daily d JOIN (SELECT obs_date,
        CASE WHEN lo >= 0 THEN greatest(lo - pad, 0e0) ELSE lo - pad END AS vmin, hi + pad AS vmax
      FROM (SELECT obs_date, lo, hi, greatest((hi - lo) * 0.15e0, 0.5e0) AS pad
        FROM (SELECT obs_date, min(temp_avg) AS lo, max(temp_avg) AS hi FROM daily GROUP BY 1))) s
      ON d.obs_date = s.obs_date WHERE temp_avg IS NOT NULL""")
def _(spark, sf):
    scaled = maps.min_max_scale(_daily(spark, sf), ["obs_date"], "temp_avg")
    return scaled.select(
        "dept", "obs_date", numbers.stable_round(F.col("scaled"), 4).alias("scaled"), "vmin", "vmax"
    )


# -- windows -------------------------------------------------------------------


@query("latest_per_key", """
    SELECT station_id, obs_date, snapshot, l_orderkey, l_linenumber, l_partkey FROM newest""")
def _(spark, sf):
    rows = b.daily_rows(spark, sf)
    newest = dedup.latest_per_key(rows, ["NUM_POSTE", "obs_date"], ["snapshot"], b.DAILY_TIES)
    return newest.select(
        F.col("NUM_POSTE").alias("station_id"), "obs_date", "snapshot", "l_orderkey", "l_linenumber", "l_partkey"
    )


LIVE = (
    "station_id, dept, obs_date, obs_time, temperature, precipitation_mm, humidity_pct, pressure_hpa, "
    "wind_speed_ms, wind_gust_ms, fog, snowfall_cm, cloud_cover_pct, weather_code"
)


@query("latest_live_rows", f"SELECT {LIVE} FROM live")
def _(spark, sf):
    return _plain_time(b.live_observations(spark, sf).select(*LIVE.split(", ")), "obs_time")


@query("latest_hourly_rows", """
    SELECT station_id, station_name, dept, elevation, obs_ts, temp, precip_mm, wind_ms, gust_ms, humidity_pct
    FROM hourly""")
def _(spark, sf):
    rows = b.hourly_observations(spark, sf).drop("latitude", "longitude")
    return _plain_time(rows, "obs_ts")


@query("rank_in_partition", f"SELECT {MONTHLY}, gloom_rank FROM ranking")
def _(spark, sf):
    return ranking.monthly_ranking(_daily(spark, sf))


@query("rank_global", """
    SELECT dept, obs_date, gloom, cast(rank() OVER (ORDER BY gloom DESC) as integer) AS place FROM daily""")
def _(spark, sf):
    scores = _daily(spark, sf).select("dept", "obs_date", "gloom")
    return ranking.rank_by_score(scores, "gloom", "place")


RUNS = "dept, city, type, start_date, end_date, n_days, intensity"


@query("islands", f"SELECT {RUNS} FROM runs")
def _(spark, sf):
    return _runs(spark, sf)


@query("rerank_subset", """
    SELECT d.city, obs_date, gloom, cast(row_number() OVER (PARTITION BY obs_date
      ORDER BY gloom DESC NULLS LAST, d.city) as integer) AS place
    FROM daily d JOIN feat f ON d.city = f.city""")
def _(spark, sf):
    return ranking.rerank_selected(_daily(spark, sf)).select("city", "obs_date", "gloom", "place")


@query("neighbour_day", """
    SELECT obs_date, lag(obs_date) OVER (ORDER BY obs_date) AS previous_day,
      lead(obs_date) OVER (ORDER BY obs_date) AS next_day FROM (SELECT DISTINCT obs_date FROM obs)""")
def _(spark, sf):
    return serve.neighbour_days(b.observations(spark, sf))


# -- sorts ---------------------------------------------------------------------


@query("top_episodes", f"""
    SELECT {RUNS} FROM runs ORDER BY end_date DESC, dept, type, start_date LIMIT 30""")
def _(spark, sf):
    return episodes.latest_runs(_runs(spark, sf))


@query("sorted_ranking", "SELECT * FROM podiums")
def _(spark, sf):
    podiums = ranking.period_podiums(_daily(spark, sf), _last_day(spark, sf))
    return podiums.orderBy("period_type", "gloom_rank", "dept")


STATUS = ", ".join(serve.LIVE_COLUMNS[2:])


@query("sorted_live", f"""
    SELECT station_id AS city, dept, {STATUS},
      cast(rank() OVER (ORDER BY gloom_live DESC) as integer) AS gloom_rank_live FROM live_last""")
def _(spark, sf):
    status = serve.live_status(b.live_observations(spark, sf))
    return _plain_time(status, "obs_time").orderBy("gloom_rank_live", "city")


@query("live_cycle", f"""
    SELECT station_id AS city, dept, {STATUS},
      cast(rank() OVER (ORDER BY gloom_live DESC) as integer) AS gloom_rank_live FROM live_last""")
def _(spark, sf):
    """Two live cycles: all messages but those of the last month and late polls, then these."""
    lake = jobs.Lake(fresh_folder(spark, "lake"))
    lines = b.live_messages(spark, sf).withColumn("ingest_date", F.to_date("timestamp"))
    last = lines.agg(F.max("ingest_date")).first()[0]
    since = (last.replace(day=1) - timedelta(days=1)).replace(day=1)
    text = F.to_json(F.struct(*schemas.LIVE_MESSAGE, "event_id")).alias("value")
    new = F.col("ingest_date") >= F.lit(since)
    for part in (~new | (F.col("event_id") % 5 == 0), new & (F.col("event_id") % 5 != 0)):
        lines.filter(part).select(text, "ingest_date").write.mode("append").partitionBy("ingest_date").text(lake.raw("live"))
        first = layers.optional_table(spark, lake.business("live_status")) is None
        jobs.build_observations(spark, lake, ("live",), None if first else since)
        jobs.build_live_tables(spark, lake, since=None if first else since)
    return _plain_time(spark.read.parquet(lake.business("live_status")), "obs_time")


@query("sorted_reliability", f"""
    SELECT *, CASE WHEN mae_temp IS NOT NULL THEN {o.RELIABILITY} END AS badge FROM reliability""")
def _(spark, sf):
    rows = compare.live_reliability(_compared(spark, sf))
    return rows.withColumn("badge", labels.reliability(F.col("mae_temp"))).orderBy("mae_temp", "city")


@query("preview_topk", f"""
    SELECT {RUNS} FROM runs WHERE type = 'rain_spell' ORDER BY n_days DESC, dept, start_date LIMIT 8""")
def _(spark, sf):
    return episodes.longest_runs(_runs(spark, sf), "rain_spell")


@query("podium_split", """
    SELECT period_type, dept, gloom_rank, place, CASE WHEN place <= 3 THEN 'podium'
      WHEN place <= 15 THEN 'listed' ELSE 'others' END AS part
    FROM (SELECT *, cast(row_number() OVER (PARTITION BY period_type ORDER BY gloom_rank, dept) as integer) AS place
      FROM podiums)""")
def _(spark, sf):
    podiums = ranking.period_podiums(_daily(spark, sf), _last_day(spark, sf))
    return ranking.podium_split(podiums).select("period_type", "dept", "gloom_rank", "place", "part")


@query("podium_rest", """
    SELECT period_type, greatest(count(*) - 15, 0) AS n_others FROM podiums GROUP BY period_type""")
def _(spark, sf):
    podiums = ranking.period_podiums(_daily(spark, sf), _last_day(spark, sf))
    return ranking.podium_rest(ranking.podium_split(podiums))


@query("period_title", f"""
    SELECT period_type, period_label, CASE WHEN period_type = 'month' THEN
      list_extract({o.MONTH_NAMES}, cast(split_part(period_label, '-', 2) as integer)) || ' '
        || split_part(period_label, '-', 1) ELSE period_label END AS title, count(*) AS n_areas
    FROM periods GROUP BY 1, 2, 3""")
def _(spark, sf):
    rows = ranking.period_rollup(_daily(spark, sf), _last_day(spark, sf))
    title = labels.period_title(F.col("period_type"), F.col("period_label"))
    return layers.counts_by(
        rows.select("period_type", "period_label", title.alias("title")),
        "period_type", "period_label", "title",
    ).withColumnRenamed("n_rows", "n_areas")


@query("age_text", """
    SELECT event_id, CASE WHEN m < 1 THEN 'à l''instant' WHEN m < 60 THEN 'il y a ' || cast(m as varchar) || ' min'
      ELSE 'il y a ' || cast(m // 60 as varchar) || ' h ' || lpad(cast(m % 60 as varchar), 2, '0') END AS age,
      CASE WHEN m <= 20 THEN 'fresh' WHEN m <= 90 THEN 'late' ELSE 'stale' END AS freshness
    FROM (SELECT event_id, datediff('minute', date_trunc('minute', ts),
            (SELECT date_trunc('minute', max(ts)) FROM events)) AS m FROM events)""")
def _(spark, sf):
    """Age of each reading at the time of the last one."""
    events = b.table(spark, sf, "events")
    minute = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 60)
    last = events.agg(F.max(minute).alias("last")).scalar()
    aged = events.select("event_id", (last - minute).alias("m"))
    return aged.select(
        "event_id", labels.age_text(F.col("m")).alias("age"), labels.freshness(F.col("m")).alias("freshness")
    )


@query("series_order", "SELECT city, obs_day, diff_temp FROM compared WHERE obs_day >= (SELECT max(obs_day) FROM compared) - 14")
def _(spark, sf):
    recent = serve.trailing_days(_compared(spark, sf), "obs_day", 14)
    return recent.select("city", "obs_day", "diff_temp").orderBy("city", "obs_day")


# -- set operations ------------------------------------------------------------


@query("union_sources", f"""
    SELECT 'official' AS source, station_id, obs_date, temperature, cloud_cover_pct FROM
      (SELECT *, cast(NULL as double) AS cloud_cover_pct FROM obs_newest)
    UNION ALL SELECT 'live', station_id, obs_date, temperature, cloud_cover_pct FROM live""")
def _(spark, sf):
    official = clean.official_observations(
        b.daily_text(spark, sf, schemas.DAILY_MAIN_COLUMNS),
        b.daily_text(spark, sf, schemas.DAILY_OTHER_COLUMNS), b.DAILY_TIES,
    )
    rows = clean.union_sources(official, b.live_observations(spark, sf))
    return rows.select("source", "station_id", "obs_date", "temperature", "cloud_cover_pct")


@query("union_kinds", """
    SELECT kind, year, month, count(*) AS n_rows, sum(temp) AS temp_sum FROM grid GROUP BY 1, 2, 3""")
def _(spark, sf):
    return b.grid(spark, sf).groupBy("kind", "year", "month").agg(
        F.count("*").alias("n_rows"), F.sum("temp").alias("temp_sum")
    )


@query("union_periods", "SELECT period_type, period_label, count(*) AS n_areas, sum(n_days)::bigint AS n_days FROM periods GROUP BY 1, 2")
def _(spark, sf):
    rows = ranking.period_rollup(_daily(spark, sf), _last_day(spark, sf))
    return rows.groupBy("period_type", "period_label").agg(
        F.count("*").alias("n_areas"), F.sum("n_days").alias("n_days")
    )


@query("union_episodes", "SELECT type, count(*) AS n_runs, sum(n_days)::bigint AS n_days, max(n_days) AS longest FROM runs GROUP BY type")
def _(spark, sf):
    return _runs(spark, sf).groupBy("type").agg(
        F.count("*").alias("n_runs"), F.sum("n_days").alias("n_days"), F.max("n_days").alias("longest")
    )


@query("concat_partitions", """
    SELECT source, dept, count(*) AS n_rows FROM obs
    WHERE year(obs_date) >= (SELECT max(year(obs_date)) FROM obs) - 1 GROUP BY 1, 2""")
def _(spark, sf):
    stored = layers.read_layer(spark, _layer(spark, sf), LAYER_SCHEMA)
    last = stored.agg(F.max("year").alias("last")).scalar()
    return layers.counts_by(stored.filter(F.col("year") >= last - 1), "source", "dept")


# -- expressions ---------------------------------------------------------------


@query("clamp01", f"""
    SELECT l_orderkey, l_linenumber, l_partkey,
      {o.clamp("CASE WHEN l_returnflag <> 'N' THEN (l_quantity - 10) / 30 END")} AS share FROM lineitem""")
def _(spark, sf):
    value = F.when(F.col("l_returnflag") != "N", (F.col("l_quantity") - 10) / 30)
    return b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", numbers.clamp01(value).alias("share")
    )


GLOOM = "dept, city, obs_date, c_cold, c_dark, c_rain, c_wind, c_humid, gloom, year, month"


@query("gloom_daily", f"SELECT {GLOOM} FROM daily")
def _(spark, sf):
    return _daily(spark, sf).select(*GLOOM.split(", "))


@query("gloom_daily_renormalised", f"""
    SELECT dept, obs_date, {rnd('''(0.3e0 * CASE WHEN temp_avg IS NOT NULL THEN c_cold ELSE 0 END
      + 0.25e0 * CASE WHEN coalesce(sunshine_min, fog) IS NOT NULL THEN c_dark ELSE 0 END
      + 0.25e0 * CASE WHEN precip_mm IS NOT NULL THEN c_rain ELSE 0 END
      + 0.1e0 * CASE WHEN wind_ms IS NOT NULL THEN c_wind ELSE 0 END
      + 0.1e0 * CASE WHEN humidity_pct IS NOT NULL THEN c_humid ELSE 0 END) * 100 / nullif(
        CASE WHEN temp_avg IS NOT NULL THEN 0.3e0 ELSE 0 END
      + CASE WHEN coalesce(sunshine_min, fog) IS NOT NULL THEN 0.25e0 ELSE 0 END
      + CASE WHEN precip_mm IS NOT NULL THEN 0.25e0 ELSE 0 END
      + CASE WHEN wind_ms IS NOT NULL THEN 0.1e0 ELSE 0 END
      + CASE WHEN humidity_pct IS NOT NULL THEN 0.1e0 ELSE 0 END, 0)''', 1)} AS gloom FROM daily1""")
def _(spark, sf):
    rows = rollup.area_daily(
        b.observations(spark, sf), max_elevation=b.MAX_ELEVATION, renormalise_missing=True
    )
    return rows.select("dept", "obs_date", "gloom")


@query("mean_temp_fallback", "SELECT dept, obs_date, temp_avg FROM daily0")
def _(spark, sf):
    measures = rollup.area_day_measures(b.observations(spark, sf), b.MAX_ELEVATION)
    filled = rollup.mean_temp(F.col("temp_avg"), F.col("temp_min"), F.col("temp_max"))
    return measures.select("dept", "obs_date", filled.alias("temp_avg"))


@query("gloom_live", """
    SELECT station_id, obs_time, c_cold, c_dark, c_rain, c_wind, c_humid, gloom_live FROM live_scored""")
def _(spark, sf):
    rows = _live(spark, sf).select(
        "station_id", "obs_time", "c_cold", "c_dark", "c_rain", "c_wind", "c_humid", "gloom_live"
    )
    return _plain_time(rows, "obs_time")


@query("gloom_grid", "SELECT * FROM cell_day")
def _(spark, sf):
    return rollup.cell_daily(b.grid(spark, sf))


@query("gloom_partial", "SELECT * FROM cell_month WHERE year = (SELECT max(year) FROM grid WHERE kind = 'monthly')")
def _(spark, sf):
    return rollup.cell_monthly(b.grid(spark, sf))


@query("idw", f"""
    SELECT obs_date, city, {rnd('sum(w * v) / sum(w)', 3)} AS value FROM (
      SELECT q.obs_date, q.city, s.v, 1 / pow(sqrt(pow(q.lat - s.lat, 2)
        + pow((q.lon - s.lon) * cos(radians(46.5e0)), 2)) + 0.05e0, 2.5e0) AS w
      FROM (SELECT d.obs_date, d.city, f.lat, f.lon FROM daily d JOIN feat f ON d.city = f.city) q
      JOIN (SELECT d.obs_date, f.lat, f.lon, d.gloom AS v FROM daily d JOIN feat f ON d.city = f.city) s
        ON q.obs_date = s.obs_date) GROUP BY 1, 2""")
def _(spark, sf):
    """Smoothed index at each featured city, from the featured cities of its day."""
    points = maps.featured_values(_daily(spark, sf), "gloom")
    days = maps.stations_by_day(points)
    placed = days.withColumn("target", F.explode("stations"))
    value = maps.idw_value(F.col("target.lat"), F.col("target.lon"), "stations")
    return placed.select(
        "obs_date", F.col("target.city").alias("city"), numbers.stable_round(value, 3).alias("value")
    )


@query("cellify", "SELECT kind, lambx, lamby, obs_date, cellx, celly FROM grid")
def _(spark, sf):
    return rollup.cellify(b.grid(spark, sf)).select("kind", "lambx", "lamby", "obs_date", "cellx", "celly")


@query("mercator_rows", f"""
    SELECT lambx, lamby, {rnd('ln(tan(pi() / 4 + radians(lat) / 2))', 6)} AS y,
      {rnd('degrees(atan(exp(ln(tan(pi() / 4 + radians(lat) / 2))))) * 2 - 90', 6)} AS lat_back,
      {rnd('lat - 0.072e0', 6)} AS south, {rnd('lon + 0.144e0 / cos(radians(lat)) / 2', 6)} AS east FROM gridref""")
def _(spark, sf):
    cells = clean.grid_reference(b.grid_reference_text(spark, sf))
    y = geo.mercator(F.col("lat"))
    edges = geo.cell_bounds(F.col("lat"), F.col("lon"))
    values = {"y": y, "lat_back": geo.inverse_mercator(y), "south": edges["south"], "east": edges["east"]}
    return cells.select(
        "lambx", "lamby", *[numbers.stable_round(v, 6).alias(n) for n, v in values.items()]
    )


@query("annualised_sum", f"""
    SELECT period_type, dept, rain_total_mm, CASE WHEN period_type = 'month' THEN rain_total_mm
      ELSE {rnd('rain_total_mm / greatest(n_days / 365.25e0, 1e-6)', 0)} END AS rain_shown_mm FROM periods""")
def _(spark, sf):
    rows = ranking.annual_rain(ranking.period_rollup(_daily(spark, sf), _last_day(spark, sf)))
    return rows.select("period_type", "dept", "rain_total_mm", "rain_shown_mm")


@query("diffs", "SELECT dept, obs_day, diff_temp, diff_precip FROM compared")
def _(spark, sf):
    return _compared(spark, sf).select("dept", "obs_day", "diff_temp", "diff_precip")


@query("coverage_rate", "SELECT dept, type, start_date, alert_days, n_days, coverage_rate FROM checked_runs")
def _(spark, sf):
    return _checked_runs(spark, sf).select(
        "dept", "type", "start_date", "alert_days", "n_days", "coverage_rate"
    )


@query("episode_status", "SELECT status, type, count(*) AS n_runs FROM checked_runs GROUP BY 1, 2")
def _(spark, sf):
    return _checked_runs(spark, sf).groupBy("status", "type").agg(F.count("*").alias("n_runs"))


@query("score_buckets", f"SELECT dept, obs_date, {o.SCORE_COLOR} AS color, {o.MOOD} AS mood FROM daily")
def _(spark, sf):
    score = F.col("gloom")
    return _daily(spark, sf).select(
        "dept", "obs_date", labels.score_color(score).alias("color"), labels.mood(score).alias("mood")
    )


@query("weather_symbol", f"SELECT event_id, weather_code, {o.SYMBOL} AS symbol FROM messages")
def _(spark, sf):
    return b.live_messages(spark, sf).select(
        "event_id", "weather_code", labels.weather_symbol(F.col("weather_code")).alias("symbol")
    )


@query("day_symbol", """
    SELECT dept, obs_date, CASE WHEN precip_mm >= 10 THEN '🌧️' WHEN precip_mm >= 1 THEN '🌦️'
      WHEN temp_min <= 0 THEN '❄️' WHEN sunshine_min >= 300 THEN '☀️' WHEN sunshine_min >= 120 THEN '⛅'
      ELSE '☁️' END AS symbol FROM daily""")
def _(spark, sf):
    symbol = labels.day_symbol(F.col("precip_mm"), F.col("temp_min"), F.col("sunshine_min"))
    return _daily(spark, sf).select("dept", "obs_date", symbol.alias("symbol"))


@query("episode_badge", f"""
    SELECT dept, type, start_date, CASE status WHEN 'confirmed' THEN '{o.BADGE_SEEN}' || coalesce(max_color, '')
        || ' (' || cast(cast({rnd('coverage_rate * 100', 0)} as integer) as varchar) || ' %)'
      WHEN 'not_confirmed' THEN '{o.BADGE_NOT_SEEN}' ELSE '' END AS badge,
      CASE type WHEN 'wind_gust' THEN 'rafales ' || cast(cast({rnd('intensity * 3.6e0', 0)} as integer) as varchar) || ' km/h'
        WHEN 'rain_spell' THEN regexp_replace(cast(cast(intensity as decimal(18,1)) as varchar), '\\.0$', '') || ' mm cumulés'
        ELSE 'min ' || regexp_replace(cast(cast(intensity as decimal(18,1)) as varchar), '\\.0$', '') || '°C' END AS detail
    FROM checked_runs""")
def _(spark, sf):
    return _checked_runs(spark, sf).select(
        "dept", "type", "start_date",
        labels.alert_badge(F.col("status"), F.col("coverage_rate"), F.col("max_color")).alias("badge"),
        labels.intensity_text(F.col("type"), F.col("intensity")).alias("detail"),
    )


# -- dates ---------------------------------------------------------------------


@query("parse_dates", """
    SELECT event_id, cast(ts as date) AS day, cast(date_trunc('month', ts) as date) AS month_start,
      date_trunc('hour', ts) AS hour, time_bucket(interval 15 minutes, ts) AS quarter FROM events""")
def _(spark, sf):
    at = F.col("ts")
    rows = b.table(spark, sf, "events").select(
        "event_id", dates.parse_day(F.date_format(at, "yyyyMMdd")).alias("day"),
        dates.parse_month(F.date_format(at, "yyyyMM")).alias("month_start"),
        dates.parse_hour(F.date_format(at, "yyyyMMddHH")).alias("hour"),
        dates.parse_quarter(F.date_format(dates.quarter_floor(at.cast("timestamp")), "yyyy-MM-dd'T'HH:mm")).alias("quarter"),
    )
    return _plain_time(rows, "hour", "quarter")


@query("met_day", """
    SELECT station_id, obs_ts, cast(obs_ts - interval 1 minute as date) AS temp_day,
      cast(obs_ts - interval 361 minutes as date) AS rain_day FROM hourly""")
def _(spark, sf):
    ts = F.col("obs_ts")
    rows = b.hourly_observations(spark, sf).select(
        "station_id", "obs_ts", dates.met_day_temp(ts).alias("temp_day"), dates.met_day_rain(ts).alias("rain_day")
    )
    return _plain_time(rows, "obs_ts")


@query("date_minus_int", """
    SELECT dept, type, obs_date, cast(datediff('day', date '1970-01-01', obs_date) as integer) AS day_number
    FROM flagged""")
def _(spark, sf):
    return episodes.flag_days(_daily(spark, sf)).select(
        "dept", "type", "obs_date", F.unix_date("obs_date").alias("day_number")
    )


@query("datediff", """
    SELECT l_orderkey, l_linenumber, l_partkey,
      cast(datediff('day', cast(o_orderdate as date), cast(l_shipdate as date)) as integer) AS days
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def _(spark, sf):
    items, orders = b.table(spark, sf, "lineitem"), b.table(spark, sf, "orders")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", dates.days_between("o_orderdate", "l_shipdate").alias("days")
    )


@query("date_sequence", "SELECT dept, type, start_date, day FROM run_days")
def _(spark, sf):
    return alerts.run_days(_runs(spark, sf)).select("dept", "type", "start_date", "day")


@query("period_labels", """
    SELECT strftime(d, '%Y-%m') AS month, cast(year(d) as varchar) AS year,
      cast(year(d) - 4 as varchar) || '-' || cast(year(d) as varchar) AS years5,
      cast(year(d) - 9 as varchar) || '-' || cast(year(d) as varchar) AS years10, d
    FROM (SELECT DISTINCT obs_date AS d FROM obs)""")
def _(spark, sf):
    day = F.col("obs_date")
    return rollup.distinct_days(b.observations(spark, sf)).select(
        dates.month_label(day).alias("month"), dates.years_label(day, 1).alias("year"),
        dates.years_label(day, 5).alias("years5"), dates.years_label(day, 10).alias("years10"), day.alias("d"),
    )


@query("date_to_string", """
    SELECT station_id, strftime(obs_ts, '%Y-%m-%d %H:%M:%S') AS obs_ts, temp FROM hourly""")
def _(spark, sf):
    return serve.as_records(b.hourly_observations(spark, sf).select("station_id", "obs_ts", "temp"))


# -- nested data ---------------------------------------------------------------


@query("flatten_alerts", "SELECT vig_date, dept, dept_max_color_id, phenomenon_id, color_id, phenomene FROM alerts")
def _(spark, sf):
    return clean.alert_rows(raw.read_alert_documents(spark, b.stage_alerts(spark, sf), "*.txt"))


@query("compact_rows", """
    SELECT obs_date, cellx, celly, array_to_string([coalesce(cast(x as varchar), 'null') for x in
      [lat, lon, temp, precip_mm, wind_ms, humidity_pct, ssi, gloom]], ',') AS cell FROM cell_day
    UNION ALL SELECT make_date(year, month, 1), cellx, celly, array_to_string([coalesce(cast(x as varchar), 'null') for x in
      [lat, lon, temp, precip_mm, NULL, NULL, NULL, gloom_partial]], ',') FROM cell_month""")
def _(spark, sf):
    grid = b.grid(spark, sf)
    daily = maps.compact_cells(rollup.cell_daily(grid), ["obs_date", "cellx", "celly"], maps.CELL_DAY)
    first = F.make_date("year", "month", F.lit(1)).alias("obs_date")
    monthly = maps.compact_cells(
        rollup.cell_monthly(grid, "1900-2100").withColumn("obs_date", first),
        ["obs_date", "cellx", "celly"], maps.CELL_MONTH,
    )
    return daily.unionByName(monthly).withColumn(
        "cell", F.array_join(F.col("cell").cast("array<string>"), ",", "null")
    )


@query("grid_day_cells", """
    SELECT obs_date, array_to_string([coalesce(cast(x as varchar), 'null') for x in
      [lat, lon, temp, precip_mm, wind_ms, humidity_pct, ssi, gloom]], ',') AS cell
    FROM cell_day WHERE obs_date = date '1997-06-15'""")
def _(spark, sf):
    cells = maps.cells_of_day(rollup.cell_daily(b.grid(spark, sf)), "1997-06-15")
    return cells.withColumn("cell", F.array_join(F.col("cell").cast("array<string>"), ",", "null"))


@query("grid_dates", """
    SELECT DISTINCT 'day' AS kind, strftime(obs_date, '%Y-%m-%d') AS value FROM cell_day0
    UNION ALL SELECT DISTINCT 'year', cast(year as varchar) FROM cell_month0""")
def _(spark, sf):
    grid = b.grid(spark, sf)
    return maps.grid_dates(rollup.cell_day_measures(grid), rollup.cell_month_measures(grid, "1900-2100"))


@query("series_pivot", """
    SELECT obs_date, """ + ", ".join(
    f"max(CASE WHEN city = '{c}' THEN gloom END) AS \"{c}\"" for c in dimensions.CHART_CITIES) + """
    FROM daily GROUP BY obs_date""")
def _(spark, sf):
    return serve.series_pivot(_daily(spark, sf))


def _layer_sql(table: str, keys: str, values: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, '{name}' AS layer, {value} AS value FROM {table}" for name, value in values.items()
    )


@query("column_pick_by_layer", _layer_sql("daily", "dept, obs_date", {
    "temp": "temp_avg", "wind": "wind_ms * 3.6e0", "humid": "humidity_pct", "rain": "precip_mm",
    "sun": "sunshine_min", "gloom": "gloom"}))
def _(spark, sf):
    return maps.daily_layers(_daily(spark, sf))


@query("live_layers", _layer_sql("live_scored", "station_id, obs_time", {
    "temp": "temperature", "wind": "wind_speed_ms * 3.6e0", "humid": "humidity_pct",
    "rain": "precipitation_mm", "sun": "100 - cloud_cover_pct", "clouds": "cloud_cover_pct",
    "gloom": "gloom_live"}))
def _(spark, sf):
    return _plain_time(maps.live_layers(_live(spark, sf), ("station_id", "obs_time")), "obs_time")


@query("grid_layers", _layer_sql("cell_month", "cellx, celly, year, month", {
    "temp": "temp", "rain": "precip_mm", "gloom": "gloom_partial"}))
def _(spark, sf):
    return maps.grid_layers(rollup.cell_monthly(b.grid(spark, sf), "1900-2100"), monthly=True)


@query("flatten_current", """
    SELECT ingested_at, city, dept, strftime(obs_time, '%Y-%m-%dT%H:%M') AS time, temperature_2m, weather_code,
      cast(event_id % 1000 as integer) AS poll FROM messages""")
def _(spark, sf):
    measures = F.struct("time", *schemas.CURRENT)
    lines = b.live_messages(spark, sf).select(F.to_json(F.struct(
        "ingested_at", (F.col("event_id") % 1000).alias("poll"), "city", "dept", "latitude", "longitude",
        "elevation", measures.alias("current"),
    )).alias("value"))
    return raw.parse_nested_messages(lines).select(
        "ingested_at", "city", "dept", "time", "temperature_2m", "weather_code", "poll"
    )


@query("json_field", "SELECT event_id, cast(json_extract(props, '$.k') as integer) AS k FROM events")
def _(spark, sf):
    return b.table(spark, sf, "events").select("event_id", raw.json_field("props", "k", "INT").alias("k"))


@query("bom_strip", """
    SELECT event_id, cast(json_extract(props, '$.k') as integer) AS k FROM events WHERE event_id % 3 <> 0""")
def _(spark, sf):
    """Every third line is blank, every other third starts with a byte-order mark."""
    event = F.col("event_id")
    body = F.concat(F.lit('{"id": '), event.cast("string"), F.lit(", "), F.expr("substring(props, 2)"))
    line = F.when(event % 3 == 0, "  ").when(event % 3 == 1, F.concat(F.lit("﻿"), body)).otherwise(body)
    clean_lines = raw.strip_bom(b.table(spark, sf, "events").select(line.alias("value")))
    parsed = clean_lines.select(F.from_json("value", "id BIGINT, k INT").alias("v"))
    return parsed.select(F.col("v.id").alias("event_id"), F.col("v.k").alias("k"))


@query("null_to_json_null", """
    SELECT city, strftime(obs_time, '%Y-%m-%d %H:%M:%S') AS obs_time, temperature IS NULL AS has_null
    FROM (SELECT station_id AS city, * FROM live)""")
def _(spark, sf):
    rows = b.live_observations(spark, sf).select(F.col("station_id").alias("city"), "obs_time", "temperature")
    body = serve.json_records(rows)
    fields = F.from_json("value", "city string, obs_time string")
    return body.select(
        fields["city"].alias("city"), fields["obs_time"].alias("obs_time"),
        F.col("value").contains('"temperature":null').alias("has_null"),
    )


@query("file_name_fields", f"""
    SELECT split_part('Q_' || {o.area('c_nationkey')} || '_latest_RR-T-Vent.csv.gz', '_', 2) AS dept,
      count(*) AS n_files FROM customer GROUP BY 1""")
def _(spark, sf):
    path = F.concat(
        F.lit("/raw/Q_"), b.area_code(F.col("c_nationkey")), F.lit("_latest_RR-T-Vent.csv.gz")
    )
    files = b.table(spark, sf, "customer").select(raw.area_of_file(path).alias("dept"))
    return files.groupBy("dept").agg(F.count("*").alias("n_files"))


# -- streaming -----------------------------------------------------------------


def _lines_as_messages(lines: DataFrame) -> DataFrame:
    sent = F.get_json_object("value", "$.ingested_at").cast("timestamp")
    return lines.select("value", sent.alias("timestamp"))


#: Messages of a file of a feed: a larger feed has more files in a batch, not larger ones.
FILE_MESSAGES = 250_000


def _files_per_batch(spark, sf) -> int:
    """Files of each of the four batches of a feed, from the number of its messages."""
    return max(2, -(-b.table(spark, sf, "events").count() // (4 * FILE_MESSAGES)))


def _message_stream(spark, sf) -> DataFrame:
    """Message lines as a stream of value and timestamp, in four batches.

    The lines are dealt over the files without regard to time, so each later batch
    brings late messages of the days before.
    """
    files = _files_per_batch(spark, sf)

    def write(folder):
        lines = b.message_lines(spark, sf).select("value").repartition(4 * files, F.xxhash64("value"))
        lines.write.option("compression", "gzip").text(folder)
    dealt = b.staged(spark, sf, "dealt-messages", write)
    return _lines_as_messages(streams.file_source(spark, dealt, "value string", "text", files_per_batch=files))


@query("stream_land_raw", """
    SELECT cast(ts as date) AS ingest_date, count(*) AS n_rows FROM events GROUP BY 1""")
def _(spark, sf):
    folder = fresh_folder(spark, "landed")
    streams.land_raw(_message_stream(spark, sf), f"{folder}/raw", f"{folder}/checkpoint", available_now=True)
    landed = spark.read.text(f"{folder}/raw")
    return layers.counts_by(landed, "ingest_date")


@query("stream_checkpoint_resume", "SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_messages FROM events")
def _(spark, sf):
    """Messages come in thirds; the stream starts anew after each, and once more without any.

    A third comes in at least two files, and in about two batches.
    """
    folder = fresh_folder(spark, "resumed")
    lines = spark.read.text(f"{b.stage_messages(spark, sf)}/*")
    files = _files_per_batch(spark, sf)
    for third in (0, 1, 2, None):
        if third is not None:
            part = F.pmod(F.xxhash64("value"), F.lit(3)) == third
            lines.filter(part).coalesce(2 * files).write.mode("append").text(f"{folder}/inbox")
        inbox = streams.file_source(spark, f"{folder}/inbox", "value string", "text", files_per_batch=files)
        streams.land_raw(_lines_as_messages(inbox), f"{folder}/raw", f"{folder}/checkpoint", available_now=True)
    landed = spark.read.text(f"{folder}/raw")
    event = F.get_json_object("value", "$.event_id").cast("bigint")
    return landed.agg(F.count("*").alias("n_rows"), F.count_distinct(event).alias("n_messages"))


@query("stream_trigger", "SELECT count(*) AS n_rows FROM events")
def _(spark, sf):
    folder = fresh_folder(spark, "timed")
    running = streams.land_raw(
        _message_stream(spark, sf), f"{folder}/raw", f"{folder}/checkpoint", trigger="1 second"
    )
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    landed = spark.read.text(f"{folder}/raw")
    return landed.agg(F.count("*").alias("n_rows"))


@query("stream_latest", """
    SELECT station_id, obs_time, ingested_at, gloom_live FROM (
      SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY obs_time DESC, ingested_at DESC, gloom_live DESC) AS rn
      FROM stream_scored) WHERE rn = 1""")
def _(spark, sf):
    """Live status kept up to date batch by batch: one row per city."""
    folder = fresh_folder(spark, "live")
    rows = streams.live_rows(_message_stream(spark, sf)).select(
        "station_id", "obs_time", "ingested_at", "gloom_live"
    )
    streams.upsert_latest(
        rows, f"{folder}/table", f"{folder}/checkpoint", ["station_id"], ["obs_time", "ingested_at"],
        available_now=True,
    )
    latest = streams.current_version(spark, f"{folder}/table", dict(rows.dtypes))
    return _plain_time(latest, "obs_time")


@query("stream_dedup", """
    SELECT station_id, obs_time, gloom_live FROM (
      SELECT *, row_number() OVER (PARTITION BY station_id, obs_time ORDER BY ingested_at DESC, gloom_live DESC) AS rn
      FROM stream_scored) WHERE rn = 1""")
def _(spark, sf):
    """Newest poll per city and quarter hour, from a log of the changes of each batch."""
    folder = fresh_folder(spark, "log")
    keys, newest = ["station_id", "obs_time"], ["ingested_at"]
    rows = streams.live_rows(_message_stream(spark, sf)).select(*keys, *newest, "gloom_live")
    rows = rows.withColumn("obs_day", F.to_date("obs_time"))
    streams.log_latest(
        rows, f"{folder}/log", f"{folder}/checkpoint", keys, newest, available_now=True, day="obs_day")
    log = spark.read.schema(schemas.ddl(dict(rows.dtypes))).parquet(f"{folder}/log")
    latest = dedup.latest_per_key(log.select(*rows.columns), keys, newest)
    return _plain_time(latest.select(*keys, "gloom_live"), "obs_time")


def _timed_stream(spark, sf, end: bool = False):
    """Messages as a stream in four batches by time, and the time that it must wait for late rows.

    A tenth of the messages of each batch comes with the next one, and a tenth comes in both. With ``end``, a row of a
    far day closes the feed.
    """
    ends = b.table(spark, sf, "events").agg(F.min("ts").cast("timestamp").alias("a"), F.max("ts").cast("timestamp").alias("z")).first()
    quarter = int((ends.z - ends.a).total_seconds() / 4) + 1
    files = _files_per_batch(spark, sf)

    def write(folder):
        lines = b.message_lines(spark, sf)
        own = F.floor((F.unix_timestamp("timestamp") - F.unix_timestamp(F.lit(ends.a))) / quarter).cast("int")
        late = F.pmod(F.xxhash64("value"), F.lit(10))
        turns = F.when(late == 0, F.array(F.least(own + 1, F.lit(3)))).when(
            late == 1, F.array_distinct(F.array(own, F.least(own + 1, F.lit(3))))).otherwise(F.array(own))
        dealt = lines.select("value", F.explode(turns).alias("turn"))
        for turn in range(4):  # one write after the other, as files are read by age
            dealt.filter(F.col("turn") == turn).select("value").repartition(files, "value").write.mode("append").option("compression", "gzip").text(f"{folder}/feed")
        last = spark.sql("""SELECT '{"ingested_at": "9000-01-01T00:00:00Z", "time": "9000-01-01T00:00"}' AS value""")
        last.coalesce(1).write.text(f"{folder}/end")

    folder = b.staged(spark, sf, "timed-messages", write)
    path = f"{folder}/{{feed,end}}" if end else f"{folder}/feed"
    lines = streams.file_source(spark, path, "value string", "text", files_per_batch=files)
    # A message of the quarter before may be as old as that quarter's start.
    return _lines_as_messages(lines), f"{quarter + 3600} seconds"


def _live_columns(messages: DataFrame) -> DataFrame:
    return streams.live_rows(messages).select("station_id", "obs_time", "ingested_at", "gloom_live")


@query("stream_state_dedup", """
    SELECT station_id, obs_time, gloom_live FROM (
      SELECT *, row_number() OVER (PARTITION BY station_id, obs_time ORDER BY ingested_at DESC, gloom_live DESC) AS rn
      FROM stream_scored) WHERE rn = 1""")
def _(spark, sf):
    """Newest poll per city and quarter hour from a stream that sends each once, when it is over."""
    folder = fresh_folder(spark, "closed")
    messages, late = _timed_stream(spark, sf, end=True)
    closed = stream_state.closed_newest(_live_columns(messages), ["station_id", "obs_time"], ["ingested_at"], "obs_time", late)
    stream_state.append_closed(closed, f"{folder}/table", f"{folder}/checkpoint", available_now=True)
    table = spark.read.schema(schemas.ddl(dict(closed.dtypes))).parquet(f"{folder}/table")
    return _plain_time(table.select("station_id", "obs_time", "gloom_live"), "obs_time")


@query("stream_repeats", """
    SELECT cast(ts as date) AS ingest_date, count(*) AS n_rows FROM events GROUP BY 1""")
def _(spark, sf):
    """Messages of a stream without the repeated deliveries, counted by day."""
    folder = fresh_folder(spark, "once")
    messages, late = _timed_stream(spark, sf)
    once = stream_state.drop_repeats(messages, ["value"], "timestamp", late)
    stream_state.append_closed(once, f"{folder}/table", f"{folder}/checkpoint", available_now=True)
    table = spark.read.schema(schemas.ddl(dict(once.dtypes))).parquet(f"{folder}/table")
    return layers.counts_by(table.select(F.to_date("timestamp").alias("ingest_date")), "ingest_date")


@query("stream_state_latest", """
    SELECT station_id, obs_time, ingested_at, gloom_live FROM (
      SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY obs_time DESC, ingested_at DESC, gloom_live DESC) AS rn
      FROM stream_scored) WHERE rn = 1""")
def _(spark, sf):
    """Live status from keyed state: a batch writes the cities that it changes, the log of changes is compacted."""
    folder = fresh_folder(spark, "newest")
    messages, late = _timed_stream(spark, sf)
    changes = stream_state.newest_per_key(_live_columns(messages), "station_id", ["obs_time", "ingested_at"], "obs_time", late, "36500 days")
    stream_log.write_log(
        changes, f"{folder}/log", f"{folder}/checkpoint", ["station_id"], by_batch=True, mode="update", compact_every=2, available_now=True)
    latest = stream_log.current_rows(spark, f"{folder}/log", dict(changes.dtypes), ["station_id"], by_batch=True)
    return _plain_time(latest, "obs_time")


@query("stream_compacted", """
    SELECT station_id, obs_time, gloom_live FROM (
      SELECT *, row_number() OVER (PARTITION BY station_id, obs_time ORDER BY ingested_at DESC, gloom_live DESC) AS rn
      FROM stream_scored) WHERE rn = 1""")
def _(spark, sf):
    """Newest poll per city and quarter hour from a log that is folded into snapshots; one batch fails before its commit."""
    folder = fresh_folder(spark, "folded")
    keys, newest = ["station_id", "obs_time"], ["ingested_at"]
    rows = streams.live_rows(_message_stream(spark, sf)).select(*keys, *newest, "gloom_live")
    failed = []

    def fail_once(number):
        if number == 1 and not failed:
            failed.append(number)
            raise RuntimeError("stopped before the commit")

    for _ in range(2):
        try:
            stream_log.write_log(
                rows, f"{folder}/log", f"{folder}/checkpoint", keys, newest, compact_every=2, after=fail_once, available_now=True)
        except StreamingQueryException:
            if failed != [1]:
                raise
    latest = stream_log.current_rows(spark, f"{folder}/log", dict(rows.dtypes), keys, newest)
    return _plain_time(latest.select(*keys, "gloom_live"), "obs_time")


@query("stream_rate", """
    SELECT time_bucket(interval 5 minutes, ts) AS window_start, count(*) AS n, count(*) / 300e0 AS per_second
    FROM events GROUP BY 1""")
def _(spark, sf):
    folder = fresh_folder(spark, "rate")
    # The dealt files are years out of order, and nothing may count as too late.
    rate = streams.message_rate(_message_stream(spark, sf), late="36500 days")
    streams.log_updates(rate, f"{folder}/updates", f"{folder}/checkpoint", available_now=True)
    changes = spark.read.schema(schemas.ddl(dict(rate.dtypes))).parquet(f"{folder}/updates")
    # Counts of a window only grow, so its last update is its largest.
    latest = changes.groupBy("window_start").agg(F.max("n").alias("n"), F.max("per_second").alias("per_second"))
    return _plain_time(latest, "window_start")


@query("error_line_filter", """
    SELECT event_id, event_type FROM events WHERE event_type = 'error' OR event_type = 'purchase'""")
def _(spark, sf):
    word = F.when(F.col("event_type") == "error", "ERROR").when(
        F.col("event_type") == "purchase", "Traceback"
    ).otherwise("ok")
    lines = b.table(spark, sf, "events").select(
        "event_id", "event_type", F.concat(F.col("ts").cast("string"), F.lit(" "), word).alias("value"), "ts"
    )
    return streams.error_lines(lines).orderBy(F.desc("ts")).select("event_id", "event_type")
