"""The star-schema tables seen as weather inputs.

Line items are station days, events are live and hourly readings, orders are
mesh values and alerts. All bindings are plain projections and equi-joins over
whole tables; the SQL twins repeat them in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wxlake import schemas
from wxlake.dimensions import FEATURED
from wxlake.functions.dates import quarter_floor
from wxlake.operators import clean
from wxlake.operators.lots import FAMILIES
from wxlake.session import fresh_folder

# Order columns that make the newest row unique.
DAILY_TIES = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
EVENT_TIES = ("event_id",)
ORDER_TIES = ("o_orderkey",)
MAX_ELEVATION = 6000.0
MIN_HOURS = 3
MIN_POINTS = 10
ARCHIVE_START = "1996-06-01"
WEATHER_CODES = (0, 1, 2, 3, 45, 48, 51, 61, 71, 80, 95, 99)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def area_code(nation: Column) -> Column:
    return F.lpad(((nation * 8 + 10) % 95 + 1).cast("string"), 2, "0")


def pick(values, position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (position + 1).cast("int"))


def snapshot_day(key: Column) -> Column:
    return F.date_add(F.lit("2002-01-01").cast("date"), (key % 3).cast("int")).cast("string")


# -- station days -------------------------------------------------------------

def _daily_items(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    stations = table(spark, sf, "supplier")
    return items.join(stations, items.l_suppkey == stations.s_suppkey)


def daily_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Raw daily columns of both families, numbers not yet text."""
    return _daily_columns(_daily_items(spark, sf))


def _daily_columns(rows: DataFrame) -> DataFrame:
    line, part = F.col("l_linenumber"), F.col("l_partkey")
    low = F.col("l_quantity") - 15
    return rows.select(
        F.concat(area_code(F.col("s_nationkey")), F.col("l_suppkey").cast("string")).alias("NUM_POSTE"),
        F.col("s_name").alias("NOM_USUEL"),
        (F.lit(42.0) + F.col("s_nationkey") % 9).alias("LAT"),
        (F.col("s_nationkey") % 13 - 5).cast("double").alias("LON"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("ALTI"),
        F.replace(F.to_date("l_shipdate").cast("string"), F.lit("-"), F.lit("")).alias("AAAAMMJJ"),
        (F.round(F.col("l_discount") * 100) * 2).alias("RR"), (line % 5).alias("QRR"),
        low.alias("TN"), ((line + 1) % 8).alias("QTN"),
        (F.col("l_quantity") - 4).alias("TX"), ((line + 1) % 8).alias("QTX"),
        (F.col("l_quantity") - 10).alias("TM"), line.alias("QTM"),
        F.when(low <= 0, (part % 600).cast("double")).otherwise(0.0).alias("DG"), line.alias("QDG"),
        (F.round(F.col("l_tax") * 100) * 1.5).alias("FFM"), line.alias("QFFM"),
        (part % 40).cast("double").alias("FXI"), F.nullif(line, F.lit(7)).alias("QFXI"),
        F.when(F.col("l_returnflag") != "N", (part % 720).cast("double")).alias("INST"),
        line.alias("QINST"),
        F.when(F.col("l_linestatus") != "F", (part % 61 + 40).cast("double")).alias("UM"),
        line.alias("QUM"),
        (part % 60 + 980).cast("double").alias("PMERM"), line.alias("QPMERM"),
        F.when(F.col("l_returnflag") == "R", F.lit(1.0)).alias("BROU"), line.alias("QBROU"),
        (part % 7).cast("double").alias("HNEIGEF"), line.alias("QHNEIGEF"),
        snapshot_day(F.col("l_orderkey")).alias("snapshot"),
        F.to_date("l_shipdate").alias("obs_date"),
        *DAILY_TIES,
    )


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """Official daily observations, quality-checked; repeated station days kept."""
    measures = {**clean.DAILY_MAIN_MEASURES, **clean.DAILY_OTHER_MEASURES}
    rows = daily_rows(spark, sf)
    return schemas.conform(
        rows.select(
            F.lit("official").alias("source"), F.lit("daily").alias("granularity"),
            F.col("NUM_POSTE").alias("station_id"), F.col("NOM_USUEL").alias("station_name"),
            clean.area_of_station(F.col("NUM_POSTE")).alias("dept"),
            F.col("LAT").alias("latitude"), F.col("LON").alias("longitude"),
            F.col("ALTI").alias("elevation"), "obs_date", *clean.checked_measures(measures),
        ),
        schemas.OBSERVATIONS,
    )


def _text(df: DataFrame, names) -> DataFrame:
    return df.select(*[F.col(f"`{n}`").cast("string").alias(n) for n in names])


MAIN_TEXT = (*schemas.DAILY_MAIN_COLUMNS, *DAILY_TIES)
OTHER_TEXT = (*schemas.DAILY_OTHER_COLUMNS, *DAILY_TIES)
# Ties are compared as numbers, so their text is turned back after reading.
TIE_TYPES = {
    "l_orderkey": "bigint", "l_linenumber": "int", "l_partkey": "bigint",
    "l_extendedprice": "double", "event_id": "bigint", "o_orderkey": "bigint",
}


def typed_ties(df: DataFrame, ties) -> DataFrame:
    return df.withColumns({t: F.col(t).cast(TIE_TYPES[t]) for t in ties})


def daily_text(spark: SparkSession, sf: str, columns) -> DataFrame:
    """One daily family as text columns with its snapshot."""
    return typed_ties(_text(daily_rows(spark, sf), (*columns, "snapshot", *DAILY_TIES)), DAILY_TIES)


# -- live and hourly readings -------------------------------------------------

def _event_rows(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return events.withColumns({
        "k": F.from_json("props", "k INT")["k"],
        "who": (F.col("user_id") % 10).cast("int"),
        "at": F.col("ts").cast("timestamp"),
    })


def live_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Live messages with the fields of the stream, plus the event id."""
    rows = _event_rows(spark, sf)
    event = F.col("event_id")
    values = {
        "temperature_2m": F.when(F.col("event_type") != "error", F.col("k") * 0.5 - 10),
        "relative_humidity_2m": (event % 61 + 40).cast("double"),
        "precipitation": (event % 9) * 0.25,
        "snowfall": (event % 3).cast("double"),
        "weather_code": F.when(F.col("event_type") != "purchase", pick(WEATHER_CODES, event % 12)),
        "cloud_cover": (event % 101).cast("double"),
        "pressure_msl": (event % 60 + 980).cast("double"),
        "wind_speed_10m": (event % 50).cast("double"),
        "wind_gusts_10m": (event % 120).cast("double"),
    }
    return rows.select(
        F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ingested_at"),
        pick([c[0] for c in FEATURED], F.col("who")).alias("city"),
        pick([c[1] for c in FEATURED], F.col("who")).alias("dept"),
        pick([c[2] for c in FEATURED], F.col("who")).alias("latitude"),
        pick([c[3] for c in FEATURED], F.col("who")).alias("longitude"),
        (F.col("who") * 20).cast("double").alias("elevation"),
        F.date_format(quarter_floor(F.col("at")), "yyyy-MM-dd'T'HH:mm").alias("time"),
        *[values.get(n, F.lit(None)).cast(t).alias(n) for n, t in schemas.CURRENT.items()],
        "event_id", F.col("at").alias("timestamp"),
    )


def live_observations(spark: SparkSession, sf: str) -> DataFrame:
    return clean.live_observations(live_messages(spark, sf), EVENT_TIES)


def hourly_text(spark: SparkSession, sf: str) -> DataFrame:
    """Raw hourly rows as text with their snapshot."""
    event, who = F.col("event_id"), F.col("who")
    rows = _event_rows(spark, sf).select(
        F.concat(pick([c[1] for c in FEATURED], who), F.col("user_id").cast("string")).alias("NUM_POSTE"),
        F.concat(F.lit("station "), F.col("user_id").cast("string")).alias("NOM_USUEL"),
        (F.lit(42.0) + who).alias("LAT"), (who - 5).cast("double").alias("LON"),
        (F.col("user_id") % 20 * 20).cast("double").alias("ALTI"),
        F.date_format("at", "yyyyMMddHH").alias("AAAAMMJJHH"),
        (F.col("k") * 0.5 - 9).alias("T"), (event % 4).alias("QT"),
        ((event % 7) * 0.5).alias("RR1"), (event % 5).alias("QRR1"),
        (event % 20).cast("double").alias("FF"), (event % 3).alias("QFF"),
        (event % 35).cast("double").alias("FXI"), F.lit(None).cast("int").alias("QFXI"),
        (event % 61 + 40).cast("double").alias("U"), (event % 6).alias("QU"),
        F.date_format("at", "yyyy-MM-dd").alias("snapshot"), "event_id",
    )
    return typed_ties(_text(rows, (*schemas.HOURLY_COLUMNS, "snapshot", *EVENT_TIES)), EVENT_TIES)


def hourly_observations(spark: SparkSession, sf: str) -> DataFrame:
    return clean.hourly_observations(hourly_text(spark, sf), EVENT_TIES)


# -- grid ---------------------------------------------------------------------

def grid_text(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Raw mesh values as text with decimal commas, ``kind`` daily or monthly."""
    orders = table(spark, sf, "orders")
    key = F.col("o_orderkey")
    temp = F.concat((key % 40 - 10).cast("string"), F.lit(",5"))
    # Every thirteenth mesh lies east of all reference points.
    outside = F.when(key % 13 == 0, 4000).otherwise(0)
    base = [
        (F.col("o_custkey") % 40 * 80 + outside).cast("string").alias("LAMBX"),
        (F.floor(F.col("o_custkey") / 40) * 80).cast("string").alias("LAMBY"),
    ]
    if kind == "monthly":
        values = [
            F.date_format("o_orderdate", "yyyyMM").alias("DATE"), temp.alias("T"),
            (key % 700).cast("string").alias("PRETOTM"),
        ]
    else:
        values = [
            F.date_format("o_orderdate", "yyyyMMdd").alias("DATE"), temp.alias("T"),
            (key % 25).cast("string").alias("PRELIQ"),
            F.when(key % 7 != 0, (key % 3).cast("string")).alias("PRENEI"),
            (key % 12).cast("string").alias("FF"), (key % 61 + 40).cast("string").alias("HU"),
            (key % 2100).cast("string").alias("SSI"),
        ]
    return orders.select(*base, *values, snapshot_day(key).alias("snapshot"), "o_orderkey")


def grid_reference_text(spark: SparkSession, sf: str) -> DataFrame:
    """Raw mesh coordinates with decimal commas, one mesh for each customer."""
    customers = table(spark, sf, "customer")
    row = F.floor(F.col("c_custkey") / 40)
    lat, lon = row % 100 + 410, F.col("c_custkey") % 40

    def comma(tenths: Column) -> Column:
        return F.concat(F.floor(tenths / 10).cast("string"), F.lit(","), (tenths % 10).cast("string"))

    return customers.select(
        (F.col("c_custkey") % 40 * 80).cast("string").alias("LAMBX (hm)"),
        (row * 80).cast("string").alias("LAMBY (hm)"),
        comma(lat).alias("LAT_DG"), comma(lon).alias("LON_DG"),
    )


def grid(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly and daily mesh values with coordinates, year and month."""
    values = clean.union_sources(
        clean.grid_monthly(grid_text(spark, sf, "monthly"), ORDER_TIES),
        clean.grid_daily(grid_text(spark, sf, "daily"), ORDER_TIES),
    )
    reference = clean.grid_reference(grid_reference_text(spark, sf))
    return clean.with_month(clean.grid_table(values, reference))


# -- alerts -------------------------------------------------------------------

def alert_orders(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order: day, term, area, phenomenon (may be missing), color."""
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    rows = orders.join(customers, orders.o_custkey == customers.c_custkey)
    key, code = F.col("o_orderkey"), area_code(F.col("c_nationkey"))
    area = (
        F.when(F.col("c_nationkey") == 24, "FRA")
        .when((code == "20") & (key % 2 == 0), "2A")
        .when(code == "20", "2B")
        .otherwise(code)
    )
    return rows.select(
        F.to_date("o_orderdate").alias("vig_date"),
        F.when(F.col("o_orderpriority").startswith("1"), "J1").otherwise("J").alias("term"),
        area.alias("area"),
        F.when(key % 11 != 0, (key % 9 + 1).cast("int")).alias("phenomenon_id"),
        (key % 4 + 1).cast("int").alias("color_id"),
    )


def alert_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One nested alert map per day.

    Rows are first reduced to one per day, term, area and phenomenon, so a map
    holds at most two terms of 28 areas with nine phenomena.
    """
    top = alert_orders(spark, sf).groupBy("vig_date", "term", "area", "phenomenon_id").agg(
        F.max("color_id").alias("color_id")
    )
    item = F.struct(
        F.col("phenomenon_id").cast("string").alias("phenomenon_id"),
        F.col("color_id").cast("string").alias("phenomenon_max_color_id"),
    )
    areas = top.groupBy("vig_date", "term", "area").agg(
        F.max("color_id").cast("string").alias("max_color_id"),
        F.collect_list(F.when(F.col("phenomenon_id").isNotNull(), item)).alias("phenomenon_items"),
    )
    periods = areas.groupBy("vig_date", "term").agg(
        F.collect_list(
            F.struct(F.col("area").alias("domain_id"), "max_color_id", "phenomenon_items")
        ).alias("domain_ids")
    )
    maps = periods.groupBy("vig_date").agg(
        F.collect_list(
            F.struct(F.col("term").alias("echeance"), F.struct("domain_ids").alias("timelaps"))
        ).alias("periods")
    )
    return maps.select("vig_date", F.struct("periods").alias("product"))


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    return clean.alert_rows(alert_documents(spark, sf))


# -- raw files written once per session ---------------------------------------

_STAGED: dict[tuple[str, str, str], str] = {}


def staged(spark: SparkSession, sf: str, name: str, write) -> str:
    """Folder of raw files derived from the tables, written on first use."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STAGED:
        folder = fresh_folder(spark, name)
        write(folder)
        _STAGED[key] = folder
    return _STAGED[key]


def _write_lots(df: DataFrame, folder: str, columns) -> None:
    (
        df.hint("rebalance", *columns).write.option("header", True).option("sep", ";")
        .option("compression", "gzip").partitionBy(*columns).csv(folder)
    )


#: Setting for the files that a writing task may hold open at once; beyond them it sorts.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def stage_daily(spark: SparkSession, sf: str, *families: str, ties=DAILY_TIES) -> str:
    """Lots of the given families, by default of both, in a folder of their own.

    They hold the columns of the model and the given columns of the tables.
    """
    names = {FAMILIES[0]: (*schemas.DAILY_MAIN_COLUMNS, *ties), FAMILIES[1]: (*schemas.DAILY_OTHER_COLUMNS, *ties)}
    wanted = families or FAMILIES

    def write(folder: str) -> None:
        keys = ["dept", "period", "family", "snapshot"]
        for family in wanted:
            # Each task writes its part of every lot, so nothing is shuffled. The writer turns numbers to the same text as a
            # cast does, without a row of texts in between.
            lots = _daily_columns(_daily_items(spark, sf)).select(
                *names[family], "snapshot", F.substring("NUM_POSTE", 1, 2).alias("dept"),
                F.lit("latest").alias("period"), F.lit(family).alias("family"),
            )
            # One folder tree holds the families: the second is added to the first. An area has three lots, so a
            # task's files are open side by side and its rows need no sort.
            before = spark.conf.get(OPEN_FILES)
            spark.conf.set(OPEN_FILES, "100")
            try:
                (
                    lots.write.mode("append").option("header", True).option("sep", ";").option("compression", "gzip")
                    .option("zlib.compress.level", "BEST_SPEED").partitionBy(*keys).csv(folder)
                )
            finally:
                spark.conf.set(OPEN_FILES, before)
    return staged(spark, sf, "-".join(["daily", *wanted, *ties]), write)


def stage_hourly(spark: SparkSession, sf: str) -> str:
    def write(folder: str) -> None:
        lots = _text(
            hourly_text(spark, sf), (*schemas.HOURLY_COLUMNS, *EVENT_TIES, "snapshot")
        ).select("*", F.substring("NUM_POSTE", 1, 2).alias("dept"), F.lit("latest").alias("period"))
        _write_lots(lots, folder, ["dept", "period", "snapshot"])
    return staged(spark, sf, "hourly", write)


def stage_grid(spark: SparkSession, sf: str) -> str:
    def write(folder: str) -> None:
        for kind, name in (("monthly", "mens"), ("daily", "quot_latest")):
            _write_lots(_text(grid_text(spark, sf, kind), grid_text(spark, sf, kind).columns),
                        f"{folder}/kind={name}", ["snapshot"])
        grid_reference_text(spark, sf).write.option("header", True).option("sep", ";").csv(
            f"{folder}/kind=grille"
        )
    return staged(spark, sf, "grid", write)


def message_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Live messages as JSON lines, with their timestamp."""
    fields = [*schemas.LIVE_MESSAGE, "event_id"]
    return live_messages(spark, sf).select(F.to_json(F.struct(*fields)).alias("value"), "timestamp")


def stage_messages(spark: SparkSession, sf: str) -> str:
    def write(folder: str) -> None:
        message_lines(spark, sf).select(
            "value", F.to_date("timestamp").alias("ingest_date"),
        ).hint("rebalance", "ingest_date").write.partitionBy("ingest_date").text(folder)
    return staged(spark, sf, "messages", write)


def stage_alerts(spark: SparkSession, sf: str) -> str:
    def write(folder: str) -> None:
        documents = alert_documents(spark, sf).select(
            F.to_json(F.struct("product")).alias("value"),
            F.date_format("vig_date", "yyyy-MM-dd").alias("date"),
        )
        # One small file per day: spread over all cores instead of rebalanced by size.
        tasks = spark.sparkContext.defaultParallelism * 4
        documents.repartition(tasks, "date").write.partitionBy("date").text(folder)
    return staged(spark, sf, "alerts", write)
