"""Dirt for the quality checks: rules that make rows of clean tables break them, as SQL text that both Spark and
the oracle run. A rule ``(column, remainder, value)`` replaces the column where the row's number leaves that remainder.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.functions import spec
from stratus.operators import quality as Q
from stratus.plans import oracle as O

_HOUR = "day(timestamp_utc) * 24 + hour(timestamp_utc)"
_STATION_HOUR = f"(CAST(wmo_station_id AS BIGINT) + {_HOUR})"


def _double(x: float) -> str:
    return f"CAST({x} AS DOUBLE)"


def _nulls(*columns: str, start: int = 1) -> list:
    return [(c, start + i, "NULL") for i, c in enumerate(columns)]


_RAW = ("wmo_station_id", "timestamp_utc", "raw", "load_dts")
_TOO_FAR = [(m, i, _double(2 * spec.BY_NAME[m].hi)) for i, m in enumerate(
    ("temperature", "wind_direction", "relative_humidity", "pressure_msl", "precipitation_probability",
     "precipitation_probability_6h"), 1)]
_STAGED = _TOO_FAR + [("precipitation", 7, _double(-1)), ("wind_speed", 8, _double(-1)), ("confidence_score", 9, _double(2)),
                      ("wmo_station_id", 10, "'orphan'"), ("timestamp_utc", 11, "timestamp_utc - INTERVAL 400 DAY"),
                      ("timestamp_utc", 12, "timestamp_utc + INTERVAL 400 DAY"),
                      *_nulls("wmo_station_id", "timestamp_utc", "load_dts", start=13)]
_FACT = _nulls("wmo_station_id", "timestamp_utc", "load_dts", "station_id", "postal_area_id") + [("confidence_score", 6, _double(2))]
_MART = ([(f"{m}_min", i, f"{m}_max + 1") for i, m in enumerate(("temperature", "pressure_msl", "relative_humidity", "visibility"), 1)]
         + [(c, i, _double(-1)) for i, c in enumerate(("precipitation_sum", "wind_speed_max", "solar_max", "sunshine_max",
                                                       "wind_gust_speed_max"), 5)]
         + [("outlier_count", 10, "-1"), ("station_count", 11, "0"), ("station_count", 12, "500"), ("plz", 13, "'12ab5'"),
            ("confidence_score_avg", 14, _double(2)), ("data_completeness", 15, _double(2)),
            *_nulls("plz", "timestamp_utc", "station_count", start=16)])

# table: (row number, modulus, rules)
RULES = {
    "raw_observed": (_STATION_HOUR, 31, _nulls(*_RAW)),
    "raw_forecast": (_STATION_HOUR, 31, _nulls(*_RAW)),
    "station_raw": ("CAST(wmo_station_id AS BIGINT)", 7, _nulls("wmo_station_id", "station_name", "lat", "lon", "load_dts")),
    "postal_raw": ("CAST(plz AS BIGINT)", 7, _nulls("plz", "geometry", "load_dts")),
    "stg_station": ("CAST(wmo_station_id AS BIGINT)", 7, [("wmo_station_id", 4, "'x1'"), ("lat", 3, "NULL"),
                                                          *_nulls("wmo_station_id", "station_name", "geometry")]),
    "stg_postal_area": ("CAST(plz AS BIGINT)", 7, [("plz", 1, "'12ab5'"), ("plz", 2, "'00123'"), ("wkt", 4, "NULL"),
                                                   *_nulls("plz", "geometry", start=3)]),
    "stg_observed": (_STATION_HOUR, 31, _STAGED),
    "stg_forecast": (_STATION_HOUR, 31, _STAGED),
    "dim_postal_area": ("id", 7, [("plz", 3, "'twice'"), *_nulls("plz", "geometry")]),
    "dim_station": ("id", 7, [("id", 5, "2"), ("wmo_station_id", 6, "'twice'"),
                              *_nulls("id", "wmo_station_id", "station_name", "geometry")]),
    "link": ("postal_area_id", 7, [("station_id", 4, "-1"), ("postal_area_id", 5, "-1"),
                                   *_nulls("postal_area_id", "station_id", "created_at")]),
    "fact_observed": (_STATION_HOUR, 31, _FACT),
    "fact_forecast": (_STATION_HOUR, 31, _FACT),
    "mart_observed": (f"(CAST(plz AS BIGINT) + {_HOUR})", 31, _MART),
    "mart_forecast": (f"(CAST(plz AS BIGINT) + {_HOUR})", 31, _MART),
}

# the oracle's names, and what stands for columns its tables do not have
SOURCE = {"stg_forecast": "stg_forecast_batches"}
STAND_IN = {"raw": "'{}'", "geometry": "'shape'"}


def _replaced(table: str, stand_in: dict[str, str], keep: tuple[str, ...] = ()) -> dict[str, str]:
    number, modulus, rules = RULES[table]
    rules = [r for r in rules if r[0] not in keep]
    return {c: "CASE " + " ".join(f"WHEN {number} % {modulus} = {at} THEN {value}" for name, at, value in rules if name == c)
            + f" ELSE {stand_in.get(c, c)} END" for c in dict.fromkeys(r[0] for r in rules)}


def dirty(df: DataFrame, table: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep``: columns that stay as they are."""
    new = _replaced(table, {}, keep)
    return df.select(*[F.expr(new[f.name]).cast(f.dataType).alias(f.name) if f.name in new else F.col(f.name)
                       for f in df.schema.fields])


def dirty_cte(table: str, keep: tuple[str, ...] = ()) -> str:
    new = _replaced(table, STAND_IN, keep)
    inside = ", ".join(f"{e} AS {c}" for c, e in new.items() if c not in STAND_IN)
    added = "".join(f", {e} AS {c}" for c, e in new.items() if c in STAND_IN)
    return f"dirty_{table} AS (SELECT * REPLACE ({inside}){added} FROM {SOURCE.get(table, table)})"


def summary_sql() -> str:
    """Failures per suite and check over the dirty tables: ``suite, check_name, failures``."""
    suites = {"station": O.union_checks("stg_station", O.STATION_CHECKS_SQL, "1 AS x"),
              "postal": O.union_checks("stg_postal_area", O.POSTAL_CHECKS_SQL, "1 AS x"),
              "observed": O.union_checks("stg_observed", O.OBSERVED_CHECKS_SQL, "1 AS x"),
              "forecast": O.union_checks("stg_forecast", O.FORECAST_CHECKS_SQL, "1 AS x"),
              "mart_observed": O.union_checks("mart_observed", O.MART_CHECKS_SQL, "1 AS x"),
              "mart_forecast": O.union_checks("mart_forecast", O.MART_CHECKS_SQL, "1 AS x"),
              "link": O.link_suite_sql(), "integrity": O.integrity_sql(fc="stg_forecast")}
    condition = {"not_null": "{c} IS NULL", "range": "NOT {c} BETWEEN 0 AND 1"}
    for table, columns in Q.DECLARED_TESTS.items():
        suites[f"declared_{table}"] = " UNION ALL ".join(
            f"SELECT 'unique_{c}' AS check_name, 1 AS x FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1"
            if test == "unique" else
            f"SELECT '{test}_{c}' AS check_name, 1 AS x FROM {table} WHERE {condition[test].format(c=c)}"
            for c, tests in columns.items() for test in tests)
    tables = re.compile(r"\b(" + "|".join(RULES) + r")\b(?=[\s.)]|$)")
    return "\nUNION ALL ".join(
        f"SELECT '{suite}' AS suite, check_name, COUNT(*) AS failures FROM ({tables.sub(r'dirty_\1', sql)}) t GROUP BY check_name"
        for suite, sql in suites.items())
