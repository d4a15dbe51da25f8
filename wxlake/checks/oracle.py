"""SQL twins of the registered queries, for DuckDB on the same tables.

Written from the definitions, not generated from the DataFrame code. Shared parts
are common table expressions; ``sql`` adds those a text needs.
"""

from __future__ import annotations

import re

from wxlake.checks.bindings import ARCHIVE_START, MAX_ELEVATION, MIN_HOURS, MIN_POINTS, WEATHER_CODES
from wxlake.dimensions import ALERT_COLORS, AREA_CITY, FEATURED, PHENOMENA, values_sql


def rnd(value: str, digits: int) -> str:
    return f"cast(round(cast({value} as decimal(28,8)), {digits}) as double)"


def clamp(value: str) -> str:
    return f"least(greatest({value}, 0e0), 1e0)"


def checked(value: str, code: str) -> str:
    return f"CASE WHEN {code} IS NULL OR {code} <> 2 THEN {value} END"


def case_map(value: str, mapping) -> str:
    return f"CASE {value} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in mapping.items()) + " END"


def texts(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v!r}" for v in values) + "]"


def area(nation: str) -> str:
    return f"lpad(cast(({nation} * 8 + 10) % 95 + 1 as varchar), 2, '0')"


def snap(key: str) -> str:
    return f"strftime(date '2002-01-01' + cast({key} % 3 as integer), '%Y-%m-%d')"


NEWEST_DAILY = "snapshot DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC"
GLOOM_SUM = "0.3e0*c_cold + 0.25e0*c_dark + 0.25e0*c_rain + 0.1e0*c_wind + 0.1e0*c_humid"
COLD = "(15e0 - {t}) / 20e0"

CTES: dict[str, str] = {
    "areas": f"SELECT * FROM ({values_sql(AREA_CITY.items())}) AS t(dept, city)",
    "feat": f"SELECT * FROM ({values_sql(FEATURED)}) AS t(city, dept, lat, lon)",
    "raw": f"""
        SELECT {area('s_nationkey')} || cast(l_suppkey as varchar) AS station_id,
          s_name AS station_name, {area('s_nationkey')} AS dept,
          42e0 + s_nationkey % 9 AS latitude, cast(s_nationkey % 13 - 5 as double) AS longitude,
          CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS elevation,
          cast(l_shipdate as date) AS obs_date, {snap('l_orderkey')} AS snapshot,
          l_orderkey, l_linenumber, l_partkey, l_extendedprice,
          round(l_discount * 100) * 2 AS rr, l_linenumber % 5 AS qrr,
          l_quantity - 15 AS tn, (l_linenumber + 1) % 8 AS qtn,
          l_quantity - 4 AS tx, (l_linenumber + 1) % 8 AS qtx,
          l_quantity - 10 AS tm, l_linenumber AS q,
          CASE WHEN l_quantity - 15 <= 0 THEN cast(l_partkey % 600 as double) ELSE 0e0 END AS dg,
          round(l_tax * 100) * 1.5e0 AS ffm,
          cast(l_partkey % 40 as double) AS fxi, nullif(l_linenumber, 7) AS qfxi,
          CASE WHEN l_returnflag <> 'N' THEN cast(l_partkey % 720 as double) END AS inst,
          CASE WHEN l_linestatus <> 'F' THEN cast(l_partkey % 61 + 40 as double) END AS um,
          cast(l_partkey % 60 + 980 as double) AS pmerm,
          CASE WHEN l_returnflag = 'R' THEN 1e0 END AS brou,
          cast(l_partkey % 7 as double) AS hneigef
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "newest": f"""
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_id, obs_date
          ORDER BY {NEWEST_DAILY}) AS rn FROM raw) WHERE rn = 1""",
    "obs_all": None,  # filled below
    "obs": None,
    "obs_newest": None,
    "daily0": f"""
        SELECT dept, obs_date, coalesce(avg(temperature), (min(temp_min) + max(temp_max)) / 2) AS temp_avg,
          min(temp_min) AS temp_min, max(temp_max) AS temp_max, avg(precipitation_mm) AS precip_mm,
          avg(wind_speed_ms) AS wind_ms, max(wind_gust_ms) AS gust_ms,
          avg(sunshine_min) AS sunshine_min, avg(humidity_pct) AS humidity_pct, max(fog) AS fog,
          count(*) AS n_stations
        FROM obs WHERE elevation <= {MAX_ELEVATION} GROUP BY dept, obs_date""",
    "daily1": f"""
        SELECT *, {clamp(COLD.format(t='temp_avg'))} AS c_cold,
          {clamp('coalesce(1 - sunshine_min / 360e0, fog, 0.5e0)')} AS c_dark,
          {clamp('precip_mm / 20e0')} AS c_rain, {clamp('wind_ms / 10e0')} AS c_wind,
          {clamp('(humidity_pct - 60e0) / 40e0')} AS c_humid FROM daily0""",
    "daily": f"""
        SELECT d.*, a.city, {rnd(f'({GLOOM_SUM}) * 100', 1)} AS gloom,
          cast(year(obs_date) as integer) AS year, cast(month(obs_date) as integer) AS month
        FROM daily1 d LEFT JOIN areas a ON d.dept = a.dept""",
    "monthly": f"""
        SELECT year, month, dept, city, {rnd('avg(gloom)', 1)} AS mean_gloom,
          {rnd('avg(temp_avg)', 1)} AS mean_temp, {rnd('sum(precip_mm)', 1)} AS rain_total_mm,
          {rnd('avg(sunshine_min)', 0)} AS mean_sun_min, count(*) AS n_days
        FROM daily GROUP BY year, month, dept, city""",
    "ranking": """
        SELECT *, cast(rank() OVER (PARTITION BY year, month ORDER BY mean_gloom DESC) as integer)
          AS gloom_rank FROM monthly""",
    "anchor": "SELECT max(obs_date) AS d, cast(year(max(obs_date)) as integer) AS y FROM daily",
    "period_days": """
        SELECT 'month' AS period_type, strftime(d, '%Y-%m') AS period_label, daily.* FROM daily, anchor
          WHERE year = y AND month = month(d)
        UNION ALL SELECT 'year', cast(y as varchar), daily.* FROM daily, anchor WHERE year = y
        UNION ALL SELECT '5years', cast(y - 4 as varchar) || '-' || cast(y as varchar), daily.*
          FROM daily, anchor WHERE year >= y - 4
        UNION ALL SELECT '10years', cast(y - 9 as varchar) || '-' || cast(y as varchar), daily.*
          FROM daily, anchor WHERE year >= y - 9""",
    "periods": f"""
        SELECT dept, city, period_type, period_label, {rnd('avg(gloom)', 1)} AS mean_gloom,
          {rnd('avg(temp_avg)', 1)} AS mean_temp, {rnd('sum(precip_mm)', 1)} AS rain_total_mm,
          count(*) AS n_days
        FROM period_days GROUP BY dept, city, period_type, period_label""",
    "podiums": """
        SELECT *, cast(rank() OVER (PARTITION BY period_type ORDER BY mean_gloom DESC) as integer)
          AS gloom_rank FROM periods""",
    "flagged": """
        SELECT dept, city, obs_date, 'cold_spell' AS type, temp_min AS v FROM daily WHERE temp_min <= 0
        UNION ALL SELECT dept, city, obs_date, 'rain_spell', precip_mm FROM daily WHERE precip_mm >= 5
        UNION ALL SELECT dept, city, obs_date, 'wind_gust', gust_ms FROM daily WHERE gust_ms >= 20""",
    "runs": f"""
        SELECT dept, city, type, min(obs_date) AS start_date, max(obs_date) AS end_date,
          count(*) AS n_days,
          {rnd("CASE type WHEN 'cold_spell' THEN min(v) WHEN 'rain_spell' THEN sum(v) ELSE max(v) END", 1)}
            AS intensity
        FROM (SELECT *, datediff('day', date '1970-01-01', obs_date)
                - row_number() OVER (PARTITION BY dept, type ORDER BY obs_date) AS g FROM flagged)
        GROUP BY dept, city, type, g
        HAVING count(*) >= CASE type WHEN 'wind_gust' THEN 1 ELSE 3 END""",
    "messages": f"""
        SELECT event_id, ts, user_id, event_type, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ingested_at,
          list_extract({texts([c[0] for c in FEATURED])}, cast(user_id % 10 + 1 as integer)) AS city,
          list_extract({texts([c[1] for c in FEATURED])}, cast(user_id % 10 + 1 as integer)) AS dept,
          time_bucket(interval 15 minutes, ts) AS obs_time,
          CASE WHEN event_type <> 'error' THEN cast(json_extract(props, '$.k') as integer) * 0.5e0 - 10 END AS temperature_2m,
          cast(event_id % 61 + 40 as double) AS relative_humidity_2m,
          (event_id % 9) * 0.25e0 AS precipitation, cast(event_id % 3 as double) AS snowfall,
          CASE WHEN event_type <> 'purchase' THEN
            cast(list_extract({texts(WEATHER_CODES)}, cast(event_id % 12 + 1 as integer)) as integer) END AS weather_code,
          cast(event_id % 101 as double) AS cloud_cover,
          cast(event_id % 60 + 980 as double) AS pressure_msl,
          cast(event_id % 50 as double) AS wind_speed_10m,
          cast(event_id % 120 as double) AS wind_gusts_10m
        FROM events""",
    "live": """
        SELECT city AS station_id, dept, cast(obs_time as date) AS obs_date, obs_time,
          temperature_2m AS temperature, precipitation AS precipitation_mm,
          relative_humidity_2m AS humidity_pct, pressure_msl AS pressure_hpa,
          wind_speed_10m / 3.6e0 AS wind_speed_ms, wind_gusts_10m / 3.6e0 AS wind_gust_ms,
          CASE WHEN weather_code IN (45, 48) THEN 1e0 WHEN weather_code IS NOT NULL THEN 0e0 END AS fog,
          snowfall AS snowfall_cm, cloud_cover AS cloud_cover_pct, weather_code, ingested_at, event_id
        FROM (SELECT *, row_number() OVER (PARTITION BY city, obs_time
                ORDER BY ingested_at DESC, event_id DESC) AS rn FROM messages) WHERE rn = 1""",
    "live_scored": f"""
        SELECT *, {rnd(f'({GLOOM_SUM}) * 100', 1)} AS gloom_live FROM (
          SELECT *, {clamp(COLD.format(t='temperature'))} AS c_cold,
            {clamp('cloud_cover_pct / 100')} AS c_dark, {clamp('precipitation_mm / 2e0')} AS c_rain,
            {clamp('wind_speed_ms / 10e0')} AS c_wind, {clamp('(humidity_pct - 60e0) / 40e0')} AS c_humid
          FROM live)""",
    "live_last": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY obs_time DESC) AS rl
          FROM live_scored) WHERE rl = 1""",
    "stream_scored": f"""
        SELECT *, {rnd(f'({GLOOM_SUM}) * 100', 1)} AS gloom_live FROM (
          SELECT city AS station_id, obs_time, ingested_at,
            {clamp(COLD.format(t='temperature_2m'))} AS c_cold,
            {clamp('cloud_cover / 100')} AS c_dark, {clamp('precipitation / 2e0')} AS c_rain,
            {clamp('wind_speed_10m / 3.6e0 / 10e0')} AS c_wind,
            {clamp('(relative_humidity_2m - 60e0) / 40e0')} AS c_humid FROM messages)""",
    "hourly": f"""
        SELECT * FROM (
          SELECT list_extract({texts([c[1] for c in FEATURED])}, cast(user_id % 10 + 1 as integer)) AS dept,
            list_extract({texts([c[1] for c in FEATURED])}, cast(user_id % 10 + 1 as integer))
              || cast(user_id as varchar) AS station_id,
            'station ' || cast(user_id as varchar) AS station_name,
            cast(user_id % 20 * 20 as double) AS elevation,
            date_trunc('hour', ts) AS obs_ts,
            {checked("cast(json_extract(props, '$.k') as integer) * 0.5e0 - 9", 'event_id % 4')} AS temp,
            {checked('(event_id % 7) * 0.5e0', 'event_id % 5')} AS precip_mm,
            {checked('cast(event_id % 20 as double)', 'event_id % 3')} AS wind_ms,
            cast(event_id % 35 as double) AS gust_ms,
            {checked('cast(event_id % 61 + 40 as double)', 'event_id % 6')} AS humidity_pct,
            row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts)
              ORDER BY strftime(ts, '%Y-%m-%d') DESC, event_id DESC) AS rn
          FROM events) WHERE rn = 1""",
    "off_temp": f"""
        SELECT dept, obs_day, avg(t) AS temp_off, max(nh) AS n_hours FROM (
          SELECT dept, station_id, cast(obs_ts - interval 1 minute as date) AS obs_day,
            avg(temp) AS t, count(temp) AS nh FROM hourly WHERE elevation <= 300
          GROUP BY 1, 2, 3 HAVING count(temp) >= {MIN_HOURS}) GROUP BY dept, obs_day""",
    "off_rain": f"""
        SELECT dept, obs_day, avg(p) AS precip_off FROM (
          SELECT dept, station_id, cast(obs_ts - interval 361 minutes as date) AS obs_day,
            sum(precip_mm) AS p FROM hourly WHERE elevation <= 300
          GROUP BY 1, 2, 3 HAVING count(precip_mm) >= {MIN_HOURS}) GROUP BY dept, obs_day""",
    "official": """
        SELECT t.*, r.precip_off FROM off_temp t LEFT JOIN off_rain r
          ON t.dept = r.dept AND t.obs_day = r.obs_day""",
    "live_temp": f"""
        SELECT dept, cast(obs_time - interval 1 minute as date) AS obs_day, avg(temperature) AS temp_live,
          count(temperature) AS n_points FROM live GROUP BY 1, 2 HAVING count(temperature) >= {MIN_POINTS}""",
    "live_rain": """
        SELECT dept, cast(obs_time - interval 361 minutes as date) AS obs_day,
          sum(precipitation_mm) / 4 AS precip_live FROM live GROUP BY 1, 2""",
    "live_day": """
        SELECT t.*, r.precip_live FROM live_temp t LEFT JOIN live_rain r
          ON t.dept = r.dept AND t.obs_day = r.obs_day""",
    "compared": f"""
        SELECT a.city, l.dept, l.obs_day, {rnd('temp_live', 2)} AS temp_live,
          {rnd('temp_off', 2)} AS temp_off, {rnd('temp_live - temp_off', 2)} AS diff_temp,
          {rnd('precip_live', 2)} AS precip_live, {rnd('precip_off', 2)} AS precip_off,
          {rnd('precip_live - precip_off', 2)} AS diff_precip, n_hours, n_points
        FROM live_day l JOIN official o ON l.dept = o.dept AND l.obs_day = o.obs_day
          LEFT JOIN areas a ON l.dept = a.dept""",
    "reliability": f"""
        SELECT city, dept, {rnd('avg(abs(diff_temp))', 2)} AS mae_temp,
          {rnd('avg(diff_temp)', 2)} AS bias_temp, {rnd('avg(abs(diff_precip))', 2)} AS mae_precip,
          count(*) AS n_days_compared FROM compared GROUP BY city, dept""",
    "mesh": f"""
        SELECT cast(o_custkey % 40 * 80 + CASE WHEN o_orderkey % 13 = 0 THEN 4000 ELSE 0 END as integer) AS lambx, cast(o_custkey // 40 * 80 as integer) AS lamby,
          cast(o_orderdate as date) AS day, cast(date_trunc('month', o_orderdate) as date) AS first_day,
          cast(cast(o_orderkey % 40 - 10 as varchar) || '.5' as double) AS temp,
          o_orderkey, {snap('o_orderkey')} AS snapshot FROM orders""",
    "gridref": """
        SELECT cast(c_custkey % 40 * 80 as integer) AS lambx, cast(c_custkey // 40 * 80 as integer) AS lamby,
          cast(cast((c_custkey // 40 % 100 + 410) // 10 as varchar) || '.' ||
            cast((c_custkey // 40 % 100 + 410) % 10 as varchar) as double) AS lat,
          cast(cast(c_custkey % 40 // 10 as varchar) || '.' || cast(c_custkey % 40 % 10 as varchar) as double) AS lon
        FROM customer""",
    "mesh_day": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lambx, lamby, day
          ORDER BY snapshot DESC, o_orderkey DESC) AS rn FROM mesh) WHERE rn = 1""",
    "mesh_month": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lambx, lamby, first_day
          ORDER BY snapshot DESC, o_orderkey DESC) AS rn FROM mesh) WHERE rn = 1""",
    "grid_values": """
        SELECT 'monthly' AS kind, lambx, lamby, first_day AS obs_date, temp,
          cast(o_orderkey % 700 as double) AS precip_mm, cast(NULL as double) AS wind_ms,
          cast(NULL as double) AS humidity_pct, cast(NULL as double) AS ssi FROM mesh_month
        UNION ALL
        SELECT 'daily', lambx, lamby, day, temp,
          CASE WHEN o_orderkey % 7 <> 0 THEN cast(o_orderkey % 25 + o_orderkey % 3 as double) END,
          cast(o_orderkey % 12 as double), cast(o_orderkey % 61 + 40 as double),
          cast(o_orderkey % 2100 as double) FROM mesh_day""",
    "grid": """
        SELECT v.*, r.lat, r.lon, cast(year(obs_date) as integer) AS year,
          cast(month(obs_date) as integer) AS month,
          cast(floor(v.lambx / 160) * 160 + 80 as bigint) AS cellx,
          cast(floor(v.lamby / 160) * 160 + 80 as bigint) AS celly
        FROM grid_values v JOIN gridref r ON v.lambx = r.lambx AND v.lamby = r.lamby""",
    "cell_day0": f"""
        SELECT cellx, celly, obs_date, {rnd('avg(lat)', 3)} AS lat, {rnd('avg(lon)', 3)} AS lon,
          avg(temp) AS temp, avg(precip_mm) AS precip_mm, avg(wind_ms) AS wind_ms,
          avg(humidity_pct) AS humidity_pct, avg(ssi) AS ssi
        FROM grid WHERE kind = 'daily' GROUP BY 1, 2, 3""",
    "cell_day": f"""
        SELECT cellx, celly, obs_date, lat, lon, {rnd('temp', 1)} AS temp, {rnd('precip_mm', 1)} AS precip_mm,
          {rnd('wind_ms', 1)} AS wind_ms, {rnd('humidity_pct', 0)} AS humidity_pct, {rnd('ssi', 0)} AS ssi,
          c_cold, c_dark, c_rain, c_wind, c_humid, {rnd(f'({GLOOM_SUM}) * 100', 1)} AS gloom,
          cast(year(obs_date) as integer) AS year, cast(month(obs_date) as integer) AS month
        FROM (SELECT *, {clamp(COLD.format(t='temp'))} AS c_cold, {clamp('1 - ssi / 2000e0')} AS c_dark,
            {clamp('precip_mm / 20e0')} AS c_rain, {clamp('wind_ms / 10e0')} AS c_wind,
            {clamp('(humidity_pct - 60e0) / 40e0')} AS c_humid FROM cell_day0)""",
    "cell_month0": f"""
        SELECT cellx, celly, year, month, {rnd('avg(lat)', 3)} AS lat, {rnd('avg(lon)', 3)} AS lon,
          avg(temp) AS temp, avg(precip_mm) AS precip_mm
        FROM grid WHERE kind = 'monthly' GROUP BY 1, 2, 3, 4""",
    "cell_month": f"""
        SELECT cellx, celly, year, month, lat, lon, {rnd('temp', 1)} AS temp, {rnd('precip_mm', 1)} AS precip_mm,
          c_cold, c_rain, {rnd('(0.3e0*c_cold + 0.25e0*c_rain) * 100 / 0.55e0', 1)} AS gloom_partial
        FROM (SELECT *, {clamp(COLD.format(t='temp'))} AS c_cold, {clamp('precip_mm / 600e0')} AS c_rain
          FROM cell_month0)""",
    "alert_orders": f"""
        SELECT cast(o_orderdate as date) AS vig_date,
          CASE WHEN o_orderpriority LIKE '1%' THEN 'J1' ELSE 'J' END AS term,
          CASE WHEN c_nationkey = 24 THEN 'FRA'
            WHEN {area('c_nationkey')} = '20' AND o_orderkey % 2 = 0 THEN '2A'
            WHEN {area('c_nationkey')} = '20' THEN '2B' ELSE {area('c_nationkey')} END AS dept,
          CASE WHEN o_orderkey % 11 <> 0 THEN cast(o_orderkey % 9 + 1 as integer) END AS phenomenon_id,
          cast(o_orderkey % 4 + 1 as integer) AS color_id
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "alerts": f"""
        SELECT vig_date, dept, dept_max_color_id, phenomenon_id,
          CASE WHEN phenomenon_id IS NOT NULL THEN color_id END AS color_id,
          {case_map('phenomenon_id', PHENOMENA)} AS phenomene
        FROM (SELECT *, max(color_id) OVER (PARTITION BY vig_date, dept) AS dept_max_color_id,
                count(phenomenon_id) OVER (PARTITION BY vig_date, dept) AS n_items
              FROM (SELECT vig_date, dept, phenomenon_id, max(color_id) AS color_id FROM alert_orders
                    WHERE term = 'J' AND dept <> 'FRA' GROUP BY 1, 2, 3))
        WHERE phenomenon_id IS NOT NULL OR n_items = 0""",
    "alert_top": """
        SELECT vig_date AS day, CASE WHEN dept IN ('2A', '2B') THEN '20' ELSE dept END AS dept,
          phenomenon_id, max(color_id) AS color_id FROM alerts GROUP BY 1, 2, 3""",
    "map_days": "SELECT DISTINCT vig_date AS day FROM alerts",
    "run_days": """
        SELECT *, CASE type WHEN 'wind_gust' THEN 1 WHEN 'rain_spell' THEN 2 ELSE 7 END AS phenomenon_id,
          cast(unnest(generate_series(start_date, end_date, interval 1 day)) as date) AS day FROM runs""",
    "covered": """
        SELECT r.dept, city, type, start_date, end_date, n_days, intensity,
          count(CASE WHEN color_id >= 2 THEN 1 END) AS alert_days, max(color_id) AS max_color_id,
          count(m.day) AS evaluable_days
        FROM run_days r
          LEFT JOIN alert_top a ON r.day = a.day AND r.dept = a.dept AND r.phenomenon_id = a.phenomenon_id
          LEFT JOIN map_days m ON r.day = m.day
        GROUP BY 1, 2, 3, 4, 5, 6, 7""",
    "checked_runs": f"""
        SELECT dept, city, type, start_date, end_date, n_days, intensity, alert_days, coverage_rate,
          {case_map('max_color_id', ALERT_COLORS)} AS max_color,
          CASE WHEN end_date < date '{ARCHIVE_START}' THEN 'out_of_archive'
            WHEN evaluable_days = 0 THEN 'not_evaluated'
            WHEN coverage_rate >= 0.5e0 THEN 'confirmed' ELSE 'not_confirmed' END AS status
        FROM (SELECT *, {rnd('alert_days / n_days', 2)} AS coverage_rate FROM covered)""",
}

_OBS = f"""
    SELECT 'official' AS source, 'daily' AS granularity, station_id, station_name, dept, latitude,
      longitude, elevation, obs_date,
      {checked('tm', 'q')} AS temperature, {checked('tn', 'qtn')} AS temp_min,
      {checked('tx', 'qtx')} AS temp_max, {checked('rr', 'qrr')} AS precipitation_mm,
      {checked('um', 'q')} AS humidity_pct, {checked('pmerm', 'q')} AS pressure_hpa,
      {checked('ffm', 'q')} AS wind_speed_ms, {checked('fxi', 'qfxi')} AS wind_gust_ms,
      {checked('inst', 'q')} AS sunshine_min, {checked('dg', 'q')} AS frost_min,
      {checked('brou', 'q')} AS fog, {checked('hneigef', 'q')} AS snowfall_cm
    FROM """
CTES["obs"] = _OBS + "raw"
CTES["obs_lots"] = _OBS.replace("obs_date,", "obs_date, snapshot,", 1) + "raw"
CTES["obs_newest"] = _OBS + "newest"
del CTES["obs_all"]


def _used(text: str) -> set[str]:
    """Shared parts a text reads from."""
    found = re.findall(r"(?:FROM|JOIN)\s+(\w+)|,\s*(anchor)\b", text)
    return {name for pair in found for name in pair} & set(CTES)


def sql(body: str) -> str:
    """The text preceded by the shared parts it needs."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for other in sorted(_used(CTES[name])):
                visit(other)
            ordered.append(name)

    for name in sorted(_used(body)):
        visit(name)
    parts = ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered)
    return f"WITH {parts}\n{body}" if parts else body


MAIN_COLUMNS = (
    "elevation", "frost_min", "latitude", "longitude", "precipitation_mm", "station_name",
    "temp_max", "temp_min", "temperature", "wind_gust_ms", "wind_speed_ms",
)
OTHER_COLUMNS = ("fog", "humidity_pct", "pressure_hpa", "snowfall_cm", "sunshine_min")


def newest_lot(columns) -> str:
    """Newest row per station and day; ties by the cleaned columns, in the order of their names."""
    ties = ", ".join(f"{c} DESC NULLS LAST" for c in columns)
    return f"""SELECT * FROM (SELECT station_id, obs_date, {', '.join(columns)}, row_number() OVER (
      PARTITION BY station_id, obs_date ORDER BY snapshot DESC, {ties}) AS rn FROM obs_lots) WHERE rn = 1"""


OBS_COLUMNS = (
    "station_id, obs_date, temperature, temp_min, temp_max, precipitation_mm, humidity_pct, "
    "pressure_hpa, wind_speed_ms, wind_gust_ms, sunshine_min, frost_min, fog, snowfall_cm"
)
# Display bounds, written out so that the twins don't share the tables under test.
SCORE_COLOR = """CASE WHEN gloom >= 65 THEN '#6b4fae' WHEN gloom >= 45 THEN '#ec835a'
  WHEN gloom >= 25 THEN '#fab219' ELSE '#0ca30c' END"""
MOOD = """CASE WHEN gloom >= 80 THEN '🫠 misère totale' WHEN gloom >= 60 THEN '🌧️ sortez les plaids'
  WHEN gloom >= 40 THEN '😶‍🌫️ bof bof' WHEN gloom >= 20 THEN '🌤️ ça passe' ELSE '☀️ tout va bien !' END"""
SKY = """CASE WHEN m >= 65 THEN 'sky-misere' WHEN m >= 45 THEN 'sky-gris'
  WHEN m >= 25 THEN 'sky-nuageux' ELSE 'sky-soleil' END"""
RELIABILITY = "CASE WHEN mae_temp >= 1.5 THEN 'douteux' WHEN mae_temp >= 0.5 THEN 'correct' ELSE 'fiable' END"
SYMBOL = """CASE WHEN weather_code >= 82 THEN '⛈️' WHEN weather_code >= 80 THEN '🌧️' WHEN weather_code >= 75 THEN '❄️'
  WHEN weather_code >= 71 THEN '🌨️' WHEN weather_code >= 61 THEN '🌧️' WHEN weather_code >= 55 THEN '🌧️'
  WHEN weather_code >= 51 THEN '🌦️' WHEN weather_code >= 45 THEN '🌫️' WHEN weather_code >= 3 THEN '☁️'
  WHEN weather_code >= 2 THEN '⛅' WHEN weather_code >= 1 THEN '🌤️' WHEN weather_code >= 0 THEN '☀️' ELSE '🌡️' END"""
MONTH_NAMES = """['janvier', 'février', 'mars', 'avril', 'mai', 'juin', 'juillet', 'août', 'septembre',
  'octobre', 'novembre', 'décembre']"""
BADGE_SEEN, BADGE_NOT_SEEN = "✔ vigilance ", "✖ non vu par la vigilance"
