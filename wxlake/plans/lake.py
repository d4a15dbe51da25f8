"""Jobs from the raw layer to the business tables of one lake folder."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wxlake import schemas
from wxlake.functions.index import SPEC
from wxlake.operators import alerts as alert_ops
from wxlake.operators import clean, compare, dedup, episodes, ranking, rollup, serve
from wxlake.session import fresh_folder
from wxlake.sources import layers, raw
from wxlake.spec import ALERT_ARCHIVE_START, MAX_ELEVATION, MIN_HOURS, MIN_POINTS, IndexSpec
from wxlake.streaming import live, log, state

YEAR_MONTH = {"year": "int", "month": "int"}
SOURCES = ("official", "live")


@dataclass(frozen=True)
class Lake:
    """Folders of one lake."""

    root: str

    def raw(self, source: str) -> str:
        return f"{self.root}/raw/source={source}"

    def layer(self, table: str) -> str:
        return f"{self.root}/layer/{table}"

    def business(self, table: str) -> str:
        return f"{self.root}/business/{table}"

    def checkpoint(self, stream: str) -> str:
        return f"{self.root}/checkpoints/{stream}"


@dataclass(frozen=True)
class Limits:
    """Thresholds a job can be run with."""

    max_elevation: float = MAX_ELEVATION
    min_hours: int = MIN_HOURS
    min_points: int = MIN_POINTS
    archive_start: str = ALERT_ARCHIVE_START


def observations(spark: SparkSession, lake: Lake) -> DataFrame | None:
    schema = {**schemas.OBSERVATIONS, **YEAR_MONTH}
    return layers.optional_table(spark, lake.layer("observations"), schema)


def build_observations(
    spark: SparkSession, lake: Lake, sources=SOURCES, start: date | None = None,
    end: date | None = None, complete_only: bool = False,
) -> int:
    """Raw daily files and live messages to the common observation table.

    Only the folders of the chosen sources are replaced, and a range of days is
    widened to whole months first. A range also prunes what is read: the file
    periods that overlap it, and the messages landed since the day before it.
    """
    first, last = layers.whole_months(start, end)
    parts = []
    if "official" in sources:
        root = lake.raw("official")
        main, other = (
            raw.read_daily_family(spark, root, family, None, complete_only, first, last)
            for family in ("RR-T-Vent", "autres-parametres")
        )
        parts.append(clean.official_observations(main, other))
    if "live" in sources:
        messages = raw.read_live_messages(spark, lake.raw("live"), first)
        parts.append(clean.live_observations(messages))
    rows = clean.not_null_key(clean.union_sources(*parts), "obs_date")
    rows = clean.with_month(layers.month_range(rows, "obs_date", start, end))
    return layers.write_counted(
        rows,
        lambda df: layers.write_partitions(
            df, lake.layer("observations"), ["source", "year", "month"]
        ),
        "observations",
    )


def build_hourly(spark: SparkSession, lake: Lake, complete_only: bool = False) -> int:
    rows = clean.hourly_observations(
        raw.read_hourly(spark, lake.raw("official_hourly"), complete_only=complete_only)
    )
    return layers.write_counted(
        clean.with_month(rows, "obs_ts"),
        lambda df: layers.write_partitions(df, lake.layer("hourly"), ["year", "month"]),
        "hourly",
    )


def build_grid(spark: SparkSession, lake: Lake, complete_only: bool = False) -> int:
    root = lake.raw("grid")
    reference = clean.grid_reference(raw.read_grid_reference(spark, f"{root}/kind=grille"))
    values = clean.union_sources(
        clean.grid_monthly(raw.read_grid_values(spark, root, "mens", complete_only=complete_only)),
        clean.grid_daily(
            raw.read_grid_values(spark, root, "quot_latest", complete_only=complete_only)
        ),
    )
    return layers.write_counted(
        clean.with_month(clean.grid_table(values, reference)),
        lambda df: layers.write_partitions(df, lake.layer("grid"), ["kind", "year", "month"]),
        "grid",
    )


def build_alerts(spark: SparkSession, lake: Lake) -> int:
    rows = clean.alert_rows(raw.read_alert_documents(spark, lake.raw("alerts")))
    return layers.write_counted(
        rows.withColumn("year", F.year("vig_date")),
        lambda df: layers.write_partitions(df, lake.layer("alerts"), ["year"]),
        "alerts",
    )


def build_live_tables(
    spark: SparkSession, lake: Lake, spec: IndexSpec = SPEC, since: date | None = None
) -> list[str]:
    """The live status alone.

    With ``since``, the first day that the cycle has replaced: only the month
    folders from there on are read, and cities without rows in them keep their
    stored row. Without it, or without a stored status, everything is read.
    """
    obs = observations(spark, lake)
    if obs is None:
        return []
    path = lake.business("live_status")
    schema = {**serve.LIVE_TYPES, "gloom_rank_live": "int"}
    stored = layers.optional_table(spark, path, schema) if since else None
    if stored is None:
        status = serve.live_status(obs, spec=spec)
    else:
        status = serve.renewed_status(obs, stored, layers.whole_months(since, None)[0], spec)
        # The table is read and replaced: its rows, one per city, are put aside first.
        aside = fresh_folder(spark, "live-status")
        layers.write_small_table(status, aside)
        status = layers.read_layer(spark, aside, schema)
    layers.write_small_table(status, path)
    return ["live_status"]


def build_business_tables(
    spark: SparkSession, lake: Lake, scope: str = "full", limits: Limits = Limits(),
    spec: IndexSpec = SPEC, renormalise_missing: bool = False, since: date | None = None,
) -> list[str]:
    """Daily index, rankings, podiums, runs and days; ``scope="live"`` only the status.

    ``since`` is the first day that changed, for the live status.

    The daily table is written first and the others read it back: the shared
    work is done once and survives the loss of executors.
    """
    built = build_live_tables(spark, lake, spec, since)
    obs = observations(spark, lake)
    if scope == "live" or obs is None:
        return built
    daily_path = lake.business("gloom_daily")
    daily = rollup.area_daily(obs, spec, limits.max_elevation, renormalise_missing)
    layers.write_partitions(daily, daily_path, ["year"])
    stored = layers.read_layer(spark, daily_path, dict(daily.dtypes))
    tables = {
        "gloom_ranking": ranking.monthly_ranking(stored),
        "gloom_podiums": ranking.period_podiums(stored),
        "episodes": episodes.detect_runs(stored),
        "gloom_dates": rollup.distinct_days(stored),
    }
    for name, table in tables.items():
        layers.write_small_table(table, lake.business(name))
    return [*built, "gloom_daily", *tables]


def build_grid_tables(
    spark: SparkSession, lake: Lake, years: str = "", spec: IndexSpec = SPEC
) -> list[str]:
    """Daily cells in full; monthly cells of the given or the latest year."""
    schema = {**schemas.GRID, "lat": "double", "lon": "double", **YEAR_MONTH}
    grid = layers.optional_table(spark, lake.layer("grid"), schema)
    if grid is None:
        return []
    layers.write_partitions(
        rollup.cell_daily(grid, spec), lake.business("grid_daily"), ["year", "month"]
    )
    layers.write_partitions(
        rollup.cell_monthly(grid, years, spec), lake.business("grid_monthly"), ["year"]
    )
    return ["grid_daily", "grid_monthly"]


def build_comparison(spark: SparkSession, lake: Lake, limits: Limits = Limits()) -> list[str]:
    """Live against official, and runs against alerts; parts without input are skipped."""
    built = []
    obs = observations(spark, lake)
    hourly = layers.optional_table(
        spark, lake.layer("hourly"), {**schemas.OBSERVATIONS_HOURLY, **YEAR_MONTH}
    )
    if obs is not None and hourly is not None:
        compared = compare.live_vs_official(
            compare.live_days(obs, limits.min_points),
            compare.official_days(hourly, limits.min_hours, limits.max_elevation),
        )
        path = lake.business("live_vs_official")
        layers.write_small_table(compared, path)
        stored = layers.read_layer(spark, path, dict(compared.dtypes))
        layers.write_small_table(
            compare.live_reliability(stored), lake.business("live_reliability")
        )
        built += ["live_vs_official", "live_reliability"]
    runs = layers.optional_table(spark, lake.business("episodes"), schemas.EPISODES)
    alert_rows = layers.optional_table(
        spark, lake.layer("alerts"), {**schemas.ALERTS, "year": "int"}
    )
    if runs is not None and alert_rows is not None:
        checked = alert_ops.check_runs(runs, alert_rows, limits.archive_start)
        layers.write_small_table(checked, lake.business("episodes_alerts"))
        built.append("episodes_alerts")
    return built


def start_landing(
    lake: Lake, messages: DataFrame, available_now: bool = False, trigger: str = live.TRIGGER
) -> StreamingQuery:
    """Land a stream of messages (value, timestamp) in the raw layer."""
    return live.land_raw(
        messages, lake.raw("live"), lake.checkpoint("landing"), available_now, trigger
    )


def start_live_table(
    lake: Lake, messages: DataFrame, available_now: bool = False, trigger: str = live.TRIGGER
) -> StreamingQuery:
    """Keep the newest scored row of each city, straight from the messages."""
    return live.upsert_latest(
        live.live_rows(messages), lake.business("live_latest"), lake.checkpoint("live_latest"),
        ["station_id"], ["obs_time", "ingested_at"], available_now, trigger,
    )


def start_live_changes(
    lake: Lake, messages: DataFrame, late: str = "1 day", silent: str = "2 days", available_now: bool = False,
    trigger: str = live.TRIGGER,
) -> StreamingQuery:
    """Log the cities whose newest scored row changes, from state kept by city; see ``live_changes``.

    A batch costs its own cities. A city without readings for ``silent`` leaves the table.
    """
    changes = state.newest_per_key(live.live_rows(messages), "station_id", ["obs_time", "ingested_at"], "obs_time", late, silent)
    return log.write_log(
        changes, lake.business("live_changes"), lake.checkpoint("live_changes"), ["station_id"], by_batch=True, mode="update",
        available_now=available_now, trigger=trigger)


def live_changes(spark: SparkSession, lake: Lake) -> DataFrame:
    """The newest scored row of each city that is not silent, from the log of changes."""
    empty = live.live_rows(layers.empty_table(spark, {"value": "string"}))
    schema = {**dict(empty.dtypes), state.GONE: "boolean"}
    return log.current_rows(spark, lake.business("live_changes"), schema, ["station_id"], by_batch=True)


def table_counts(spark: SparkSession, lake: Lake, tables: list[str]) -> DataFrame:
    """Row count of each business table; absent tables are left out."""
    stored = {t: layers.optional_table(spark, lake.business(t)) for t in tables}
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        for name, df in stored.items() if df is not None
    ]
    none = layers.empty_table(spark, {"table": "string", "n_rows": "bigint"})
    return clean.union_sources(none, *counts)


def layer_report(spark: SparkSession, lake: Lake, name: str = "MONTSOURIS") -> dict[str, DataFrame]:
    """Sample rows and duplicate counts of the observation table."""
    obs = observations(spark, lake)
    if obs is None:
        return {}
    by_source = {s: obs.filter(F.col("source") == s) for s in SOURCES}
    return {
        "named station": serve.preview(
            by_source["official"], "station_name", name, ["obs_date", "station_id"]
        ),
        "last live rows": by_source["live"].orderBy(F.desc("obs_time"), "station_id").limit(5),
        "rows per source": layers.counts_by(obs, "source"),
        "duplicate station days": dedup.duplicate_keys(
            by_source["official"], ["station_id", "obs_date"]
        ),
        "duplicate quarter hours": dedup.duplicate_keys(
            by_source["live"], ["station_id", "obs_time"]
        ),
    }


def business_report(spark: SparkSession, lake: Lake, n: int = 12) -> dict[str, DataFrame]:
    """Last month's ranking, longest cold spells, runs per type, live status, worst days."""
    names = ("gloom_ranking", "episodes", "live_status", "gloom_daily")
    tables = {t: layers.optional_table(spark, lake.business(t)) for t in names}
    out = {}
    if tables["gloom_ranking"] is not None:
        out["ranking"] = serve.month_ranking(tables["gloom_ranking"]).limit(n)
    if tables["episodes"] is not None:
        out["longest cold spells"] = episodes.longest_runs(tables["episodes"], "cold_spell")
        out["runs per type"] = episodes.runs_by_type(tables["episodes"])
    if tables["live_status"] is not None:
        out["live"] = tables["live_status"].orderBy("gloom_rank_live", "city").limit(n)
    daily = tables["gloom_daily"]
    if daily is not None:
        worst = ranking.worst_days(rollup.in_years(daily))
        out["worst days of the last year"] = worst.orderBy(F.desc("gloom"), "city").limit(n)
    return out


def served_episodes(spark: SparkSession, lake: Lake, n: int = 30) -> DataFrame:
    """Latest runs, with alert coverage where it was computed."""
    paths = [lake.business("episodes_alerts"), lake.business("episodes")]
    return episodes.latest_runs(layers.first_present(spark, paths, schemas.EPISODES_ALERTS), n)


def served_days(spark: SparkSession, lake: Lake) -> DataFrame:
    """Sorted available days, from the small table or else the daily table."""
    paths = [lake.business("gloom_dates"), lake.business("gloom_daily")]
    found = layers.first_present(spark, paths, {"obs_date": "date"})
    return rollup.distinct_days(found).orderBy("obs_date")
