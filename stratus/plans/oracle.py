"""DuckDB SQL for the driver's parity check: the same models written as plain SQL over the driver views.

The oracle is deliberately written differently from the Spark plans: typed measures instead of a JSON
round-trip, ``DISTINCT ON`` instead of windows, a closed-form square distance over an areas x stations
cross join instead of the grid search, ``row_number()`` ids, ranked counts for modes. Spec values are
shared (they are fixed values, not logic).
"""

from __future__ import annotations

from stratus.functions import spec

ROUND_DIGITS = 6


def r(col: str, alias: str | None = None) -> str:
    """Rounded double, -0.0 folded to 0.0 (mirrors ``round_doubles`` on the Spark side)."""
    return f"(ROUND({col}, {ROUND_DIGITS}) + 0.0) AS {alias or col}"


def _d(x) -> str:
    return f"CAST({x} AS DOUBLE)"


# ------------------------------------------------------------------------------------------ raw stand-ins
MEASURE_SQL = {
    "temperature": f"CASE WHEN k % 25 = 0 THEN NULL ELSE value - {_d(60.0)} END",
    "precipitation": f"CASE WHEN k % 10 = 3 THEN NULL ELSE {_d('k')} * {_d(2.5)} END",
    "wind_speed": f"{_d('k')} * {_d(1.25)}",
    "wind_direction": f"{_d('k')} * {_d(3.7)} + {_d(1.3)}",
    "pressure_msl": f"{_d(790.0)} + {_d('k')} * {_d(3.5)}",
    "relative_humidity": f"{_d('k')} * {_d(1.1)}",
    "cloud_cover": f"{_d('k')} * {_d(1.02)}",
    "visibility": f"{_d('k')} * {_d(1025.0)}",
    "dew_point": f"value - {_d(55.0)}",
    "solar": f"{_d('k')} / {_d(90.0)}",
    "sunshine": f"{_d('k')} * {_d(0.625)}",
    "wind_gust_speed": f"{_d('k')} * {_d(1.6)}",
    "wind_gust_direction": f"{_d('k')} * {_d(3.8)} + {_d(0.9)}",
    "precipitation_probability": f"{_d('k')} * {_d(1.05)}",
    "precipitation_probability_6h": f"{_d('k')} * {_d(1.03)}",
}

WMO = "lpad(CAST(user_id AS VARCHAR), 5, '0')"


def raw_weather_cte(kind: str) -> str:
    ts = ("date_trunc('hour', ts)" if kind == "observed"
          else "TIMESTAMP '2024-02-01 00:00:00' + to_hours(k % 24)")
    measures = ",\n    ".join(f"{v} AS {k}" for k, v in MEASURE_SQL.items())
    batch = ",\n    CAST(ts AS DATE) AS batch_id" if kind == "forecast" else ""
    return f"""raw_{kind} AS (
  SELECT {WMO} AS wmo_station_id,
    {ts} AS timestamp_utc,
    '{{"id":' || CAST(user_id AS VARCHAR) || ',"wmo_station_id":"' || {WMO} || '"}}' AS bright_sky_source_mapping,
    'events' AS record_source,
    ts AS load_dts,
    {measures},
    event_type AS condition,
    event_type || '-' || CAST(k % 3 AS VARCHAR) AS icon{batch}
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) e
)"""


def _oor(x: str, m) -> str:
    return f"({x} < {_d(m.lo)} OR {x} > {_d(m.hi)})"


def staged_select(src: str, extra: str = "") -> str:
    cols = ["wmo_station_id", "timestamp_utc"]
    for m in spec.MEASURES:
        cols.append(f"CASE WHEN {_oor(m.name, m)} THEN NULL ELSE {m.name} END AS {m.name}")
    cols += ["condition AS weather_condition", "icon AS weather_icon", "bright_sky_source_mapping", "record_source",
             "load_dts"]
    flag = " ".join(f"WHEN {_oor(m.name, m)} THEN '{m.flag}'" for m in spec.MEASURES)
    cols.append(f"CASE {flag} ELSE NULL END AS outlier_flag")
    outs = " OR ".join(_oor(n, spec.BY_NAME[n]) for n in spec.CONFIDENCE_MEASURES)
    nulls = " OR ".join(f"{n} IS NULL" for n in spec.CONFIDENCE_MEASURES)
    cols.append(f"CASE WHEN {outs} THEN {_d(spec.CONFIDENCE_OUTLIER)} WHEN {nulls} THEN {_d(spec.CONFIDENCE_MISSING)} "
                f"ELSE {_d(spec.CONFIDENCE_OK)} END AS confidence_score")
    if extra:
        cols.append(extra)
    return "SELECT " + ",\n    ".join(cols) + f"\n  FROM {src}"


def stg_weather_cte(kind: str, batch_key: bool = False) -> str:
    keys = "wmo_station_id, timestamp_utc" + (", batch_id" if batch_key else "")
    name = f"stg_{kind}" + ("_batches" if batch_key else "")
    return f"""dedup_{name} AS (
  SELECT DISTINCT ON ({keys}) * FROM raw_{kind} WHERE temperature IS NOT NULL
  ORDER BY {keys}, load_dts DESC NULLS FIRST
),
{name} AS (
  {staged_select('dedup_' + name, 'batch_id' if batch_key else '')}
)"""


STATION_CTES = """station_raw AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS wmo_station_id, c_name AS station_name,
         CAST(4700 + (c_custkey * 37) % 800 AS DOUBLE) AS lat, CAST(600 + (c_custkey * 53) % 900 AS DOUBLE) AS lon,
         '{"c_custkey":' || CAST(c_custkey AS VARCHAR) || ',"segment":"' || c_mktsegment || '"}' AS properties,
         'customer' AS record_source, TIMESTAMP '2023-12-31 00:00:00' AS load_dts
  FROM customer
  UNION ALL
  SELECT lpad(CAST(c_custkey AS VARCHAR), 5, '0'), c_name || ' (reloaded)',
         CAST(4700 + (c_custkey * 37) % 800 AS DOUBLE), CAST(600 + (c_custkey * 53) % 900 AS DOUBLE),
         '{"c_custkey":' || CAST(c_custkey AS VARCHAR) || ',"segment":"' || c_mktsegment || '"}',
         'customer', TIMESTAMP '2024-01-01 00:00:00'
  FROM customer WHERE c_mktsegment = 'BUILDING'
),
stg_station AS (
  SELECT wmo_station_id, station_name, lat, lon, properties, record_source, load_dts FROM (
    SELECT *, row_number() OVER (PARTITION BY wmo_station_id ORDER BY load_dts DESC NULLS FIRST, station_name,
                                 properties) AS rn
    FROM station_raw
    WHERE wmo_station_id IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL AND station_name IS NOT NULL
  ) t WHERE rn = 1
),
dim_station AS (
  SELECT row_number() OVER (ORDER BY wmo_station_id) AS id, * FROM stg_station
)"""

POSTAL_CTES = """postal_raw AS (
  SELECT CAST(10000 + s_suppkey AS VARCHAR) AS plz,
         'MULTIPOLYGON(((' || CAST(cx - 40 AS VARCHAR) || ' ' || CAST(cy - 40 AS VARCHAR) || ', '
                          || CAST(cx + 40 AS VARCHAR) || ' ' || CAST(cy - 40 AS VARCHAR) || ', '
                          || CAST(cx + 40 AS VARCHAR) || ' ' || CAST(cy + 40 AS VARCHAR) || ', '
                          || CAST(cx - 40 AS VARCHAR) || ' ' || CAST(cy + 40 AS VARCHAR) || ', '
                          || CAST(cx - 40 AS VARCHAR) || ' ' || CAST(cy - 40 AS VARCHAR) || ')))' AS wkt,
         'supplier' AS record_source, TIMESTAMP '2024-01-01 00:00:00' AS load_dts, cx, cy
  FROM (SELECT s_suppkey, 600 + (s_suppkey * 71) % 900 AS cx, 4700 + (s_suppkey * 29) % 800 AS cy FROM supplier) s
),
stg_postal_area AS (
  SELECT plz, wkt, record_source, load_dts, cx, cy FROM (
    SELECT *, row_number() OVER (PARTITION BY plz ORDER BY load_dts DESC NULLS FIRST, wkt) AS rn
    FROM postal_raw WHERE plz IS NOT NULL AND wkt IS NOT NULL
  ) t WHERE rn = 1
),
dim_postal_area AS (
  SELECT row_number() OVER (ORDER BY plz) AS id, * FROM stg_postal_area
)"""


def changed_stations(known: str, moved: str, by: int) -> str:
    """The stations of the customers that ``known`` holds for, with another longitude where ``moved`` does."""
    text = STATION_CTES.replace("FROM customer", f"FROM (SELECT * FROM customer WHERE {known}) customer")
    return text.replace("(c_custkey * 53) % 900", f"(c_custkey * 53 + CASE WHEN {moved} THEN {by} ELSE 0 END) % 900")


def changed_areas(known: str) -> str:
    return POSTAL_CTES.replace("FROM supplier)", f"FROM supplier WHERE {known})")


def link_cte(k: int = 1) -> str:
    return f"""link_ranked AS (
  SELECT a.id AS postal_area_id, s.id AS station_id,
         sqrt(d.dx * d.dx + d.dy * d.dy) AS distance,
         row_number() OVER (PARTITION BY a.id ORDER BY d.dx * d.dx + d.dy * d.dy, s.id) AS rank
  FROM dim_postal_area a CROSS JOIN dim_station s,
       LATERAL (SELECT greatest(abs(s.lon - a.cx) - 40, 0) AS dx, greatest(abs(s.lat - a.cy) - 40, 0) AS dy) d
),
link AS (
  SELECT postal_area_id, station_id, TIMESTAMP '2024-02-01 00:00:00' AS created_at, rank, distance
  FROM link_ranked WHERE rank <= {k}
)"""


def fact_cte(kind: str, stg: str) -> str:
    """Staged rows once per served area; ``served`` looks the station's code up per link."""
    cols = ", ".join(f"served.{c}" if c in ("station_id", "postal_area_id") else c for c in spec.FACT_COLUMNS)
    return f"""fact_{kind} AS (
  WITH served AS (
    SELECT postal_area_id, station_id,
           (SELECT any_value(wmo_station_id) FROM dim_station WHERE dim_station.id = link.station_id) AS code
    FROM link WHERE postal_area_id IN (SELECT id FROM dim_postal_area)
  )
  SELECT {cols} FROM served, {stg} WHERE code = wmo_station_id
)"""


def mart_cte(kind: str, outlier_rule: str = "faithful") -> str:
    parts = []
    for m in spec.MEASURES:
        for a in m.aggs:
            name = f"{m.name}_{'avg' if a == 'circavg' else a}"
            if a == "circavg":
                s = f"AVG(SIN(RADIANS({m.name})))"
                c = f"AVG(COS(RADIANS({m.name})))"
                e = f"CASE WHEN {s} >= 0 THEN DEGREES(ATAN2({s}, {c})) ELSE DEGREES(ATAN2({s}, {c})) + 360 END"
            elif a == "std":
                e = f"STDDEV_SAMP({m.name})"
            else:
                e = f"{a.upper()}({m.name})"
            parts.append(f"{e} AS {name}")
    cond = "outlier_flag = 'outlier'" if outlier_rule == "faithful" else "outlier_flag IS NOT NULL"
    parts += ["COUNT(*) AS station_count",
              "CAST(COUNT(CASE WHEN temperature IS NOT NULL THEN 1 END) AS DOUBLE) / COUNT(*) AS data_completeness",
              f"COUNT(CASE WHEN {cond} THEN 1 END) AS outlier_count",
              "AVG(confidence_score) AS confidence_score_avg",
              "'aggregated_matview' AS record_source",
              "MAX(load_dts) AS load_dts"]
    body = ",\n    ".join(parts)

    def mode(col: str) -> str:
        return f"""SELECT plz, timestamp_utc, {col} AS {col}_mode FROM (
      SELECT plz, timestamp_utc, {col},
             row_number() OVER (PARTITION BY plz, timestamp_utc ORDER BY count(*) DESC, {col}) AS rn
      FROM mart_in_{kind} WHERE {col} IS NOT NULL GROUP BY plz, timestamp_utc, {col}) t WHERE rn = 1"""

    return f"""mart_in_{kind} AS (
  SELECT f.*, pa.plz FROM fact_{kind} f JOIN dim_postal_area pa ON pa.id = f.postal_area_id
  WHERE f.temperature IS NOT NULL
),
mart_agg_{kind} AS (
  SELECT plz, timestamp_utc,
    {body}
  FROM mart_in_{kind} GROUP BY plz, timestamp_utc
),
mart_{kind} AS (
  SELECT a.*, c.weather_condition_mode, i.weather_icon_mode
  FROM mart_agg_{kind} a
  LEFT JOIN ({mode('weather_condition')}) c USING (plz, timestamp_utc)
  LEFT JOIN ({mode('weather_icon')}) i USING (plz, timestamp_utc)
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def final_select(src: str, cols, doubles=(), where: str = "") -> str:
    sel = ", ".join(r(c) if c in doubles else c for c in cols)
    return f"SELECT {sel} FROM {src}" + (f" WHERE {where}" if where else "")


def union_checks(src: str, checks, cols: str = "*") -> str:
    """The reference's check style: one SELECT per check glued with UNION ALL."""
    return "\nUNION ALL\n".join(f"SELECT '{name}' AS check_name, {cols} FROM {src} WHERE {pred}" for name, pred in checks)


def sql_outside(c: str, lo, hi) -> str:
    return f"{c} IS NOT NULL AND ({c} < {lo} OR {c} > {hi})"


def sql_negative(c: str) -> str:
    return f"{c} IS NOT NULL AND {c} < 0"


OBSERVED_CHECKS_SQL = [
    ("temperature_out_of_range", sql_outside("temperature", -50, 50)),
    ("negative_precipitation", sql_negative("precipitation")),
    ("negative_wind_speed", sql_negative("wind_speed")),
    ("wind_direction_out_of_range", sql_outside("wind_direction", 0, 360)),
    ("humidity_out_of_range", sql_outside("relative_humidity", 0, 100)),
    ("pressure_out_of_range", sql_outside("pressure_msl", 800, 1100)),
    ("confidence_score_out_of_range", sql_outside("confidence_score", 0, 1)),
]
FORECAST_CHECKS_SQL = OBSERVED_CHECKS_SQL + [
    ("precipitation_probability_out_of_range", sql_outside("precipitation_probability", 0, 100)),
    ("precipitation_probability_6h_out_of_range", sql_outside("precipitation_probability_6h", 0, 100)),
]


def _mm(a: str, b: str) -> str:
    return f"{a} IS NOT NULL AND {b} IS NOT NULL AND {a} > {b}"


MART_CHECKS_SQL = [
    ("non_positive_station_count", "station_count <= 0"),
    ("temperature_min_greater_than_max", _mm("temperature_min", "temperature_max")),
    ("negative_precipitation_sum", sql_negative("precipitation_sum")),
    ("negative_wind_speed_max", sql_negative("wind_speed_max")),
    ("pressure_min_greater_than_max", _mm("pressure_msl_min", "pressure_msl_max")),
    ("humidity_min_greater_than_max", _mm("relative_humidity_min", "relative_humidity_max")),
    ("visibility_min_greater_than_max", _mm("visibility_min", "visibility_max")),
    ("negative_solar_max", sql_negative("solar_max")),
    ("negative_sunshine_max", sql_negative("sunshine_max")),
    ("negative_wind_gust_speed_max", sql_negative("wind_gust_speed_max")),
    ("negative_outlier_count", sql_negative("outlier_count")),
    ("invalid_postal_code_format", "plz IS NOT NULL AND (length(plz) != 5 OR NOT regexp_full_match(plz, '[0-9]{5}'))"),
    ("confidence_score_avg_out_of_range", sql_outside("confidence_score_avg", 0, 1)),
]

STATION_CHECKS_SQL = [
    ("null_geometry", "lat IS NULL OR lon IS NULL"),
    ("null_wmo_station_id", "wmo_station_id IS NULL"),
    ("null_station_name", "station_name IS NULL"),
    ("invalid_wmo_station_id_format", "wmo_station_id IS NOT NULL AND NOT regexp_full_match(wmo_station_id, '[0-9]+')"),
]

POSTAL_CHECKS_SQL = [
    ("null_geometry", "wkt IS NULL"),
    ("null_postal_codes", "plz IS NULL"),
    ("invalid_postal_code_format", "plz IS NOT NULL AND (length(plz) != 5 OR NOT regexp_full_match(plz, '[0-9]{5}'))"),
    ("postal_codes_out_of_range", "plz IS NOT NULL AND (TRY_CAST(plz AS INTEGER) < 1000 OR TRY_CAST(plz AS INTEGER) > 99999)"),
]

def missing_parent(check: str, child: str, key: str, parent: str, parent_key: str, out: str) -> str:
    return (f"SELECT '{check}' AS check_name, {out} FROM {child} WHERE NOT EXISTS "
            f"(SELECT 1 FROM {parent} WHERE {parent}.{parent_key} = {child}.{key})")


def breaking(check: str, table: str, predicate: str, out: str) -> str:
    return f"SELECT '{check}' AS check_name, {out} FROM {table} WHERE {predicate}"


# Check names are fixed values.
def link_suite_sql(link: str = "link") -> str:
    out = "postal_area_id, station_id, created_at"
    return "\nUNION ALL ".join([
        breaking("null_station_ids", link, "station_id IS NULL", out),
        breaking("null_postal_area_ids", link, "postal_area_id IS NULL", out),
        breaking("null_created_at", link, "created_at IS NULL", out),
        missing_parent("invalid_station_ids", link, "station_id", "dim_station", "id", out),
        missing_parent("invalid_postal_area_ids", link, "postal_area_id", "dim_postal_area", "id", out)])


def integrity_sql(obs: str = "stg_observed", fc: str = "stg_forecast_batches", mart: str = "mart_forecast",
                  link: str = "link") -> str:
    def out(a: str, b: str) -> str:
        return f"CAST({a} AS VARCHAR) AS key1, CAST({b} AS VARCHAR) AS key2"

    hour, area = out("wmo_station_id", "timestamp_utc"), out("plz", "timestamp_utc")
    now = "TIMESTAMP '2024-02-01 00:00:00'"
    # (check, child, its key, parent, its key, reported keys)
    orphans = (
        ("weather_observed_invalid_station_ids", obs, "wmo_station_id", "stg_station", "wmo_station_id", hour),
        ("weather_forecast_invalid_station_ids", fc, "wmo_station_id", "stg_station", "wmo_station_id", hour),
        ("aggregated_invalid_postal_codes", mart, "plz", "dim_postal_area", "plz", area),
        ("link_table_invalid_postal_area_ids", link, "postal_area_id", "dim_postal_area", "id", out("postal_area_id", "station_id")),
        ("link_table_invalid_station_ids", link, "station_id", "dim_station", "id", out("station_id", "postal_area_id")),
    )
    bounds = (
        ("forecast_timestamps_too_far_future", fc, f"epoch(timestamp_utc) - epoch({now}) > 7 * 86400", hour),
        ("observed_timestamps_too_old", obs, f"epoch({now}) - epoch(timestamp_utc) > 30 * 86400", hour),
        ("aggregated_unreasonable_station_counts", mart, "NOT station_count BETWEEN 1 AND 100", area),
    )
    return "\nUNION ALL ".join([missing_parent(*o) for o in orphans] + [breaking(*b) for b in bounds])


LINK_SUITE_SQL, INTEGRITY_SQL = link_suite_sql(), integrity_sql()
