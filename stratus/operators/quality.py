"""Data-quality checks. Each returns the failing rows; zero rows means the check passes.

A suite of N row-level checks over one table is one scan: every row gets the array of names of the
checks it fails, which is exploded (instead of N filtered scans glued by UNION ALL).
"""

from __future__ import annotations

import os
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratus.functions import spec
from stratus.functions.timeutil import hour_floor, seconds_between
from stratus.operators.dedup import duplicate_keys
from stratus.operators.incremental import KeyedLog
from stratus.session import materialize

Check = tuple[str, Column]  # (check name, predicate that is TRUE on a failing row)


# ------------------------------------------------------------------------------------------ predicates
def outside(col: str, lo: float, hi: float) -> Column:
    """Fails when ``col < lo OR col > hi``; NULL passes."""
    c = F.col(col)
    return c.isNotNull() & ((c < F.lit(lo)) | (c > F.lit(hi)))


def negative(col: str) -> Column:
    c = F.col(col)
    return c.isNotNull() & (c < F.lit(0))


def not_digits(col: str, exact: int | None = None) -> Column:
    c = F.col(col)
    if exact is None:
        return c.isNotNull() & ~c.rlike(r"^[0-9]+$")
    return c.isNotNull() & ((F.length(c) != exact) | ~c.rlike(rf"^[0-9]{{{exact}}}$"))


# ------------------------------------------------------------------------------------------ generic checks
def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Values occurring more than once (NULLs ignored); counting pre-aggregates map-side."""
    return duplicate_keys(df.filter(F.col(col).isNotNull()), [col], "n_records")


def check_accepted_range(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    return df.filter(outside(col, lo, hi))


def check_temperature_range(df: DataFrame, col: str = "temperature", lo: float = -50, hi: float = 50) -> DataFrame:
    return df.filter(outside(col, lo, hi))


def check_pressure_range(df: DataFrame, col: str = "pressure_msl", lo: float = 800, hi: float = 1100) -> DataFrame:
    return df.filter(outside(col, lo, hi))


def check_non_negative(df: DataFrame, col: str) -> DataFrame:
    return df.filter(negative(col))


def check_direction_range(df: DataFrame, col: str) -> DataFrame:
    return df.filter(outside(col, 0, 360))


def check_humidity_range(df: DataFrame, col: str) -> DataFrame:
    return df.filter(outside(col, 0, 100))


def check_confidence_range(df: DataFrame, col: str = "confidence_score") -> DataFrame:
    return df.filter(outside(col, 0, 1))


def check_completeness(df: DataFrame, col: str, threshold: float = 0.8) -> DataFrame:
    """One row (completeness_ratio) when the non-null share of ``col`` is below ``threshold``.
    An empty table has no ratio (the reference divides by zero) and yields no row."""
    ratio = F.try_divide(F.count(F.col(col)).cast("double"), F.count(F.lit(1)).cast("double"))
    return df.agg(ratio.alias("completeness_ratio")).filter(F.col("completeness_ratio") < F.lit(threshold))


def check_no_duplicates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return duplicate_keys(df, cols, "record_count")


def check_timestamp_continuity(df: DataFrame, ts: str, max_gap_seconds: float = 3600.0,
                               partition_by: Sequence[str] = (), bucket: str | None = None) -> DataFrame:
    """Timestamps whose distance to the previous distinct timestamp (per ``partition_by`` group) exceeds
    the allowed gap. Output: (partition cols..., ts, prev_timestamp, gap_seconds).

    Duplicate timestamps change no gap, so the work runs on distinct values. The lag is taken inside
    (group, bucket) buckets, so no task holds a whole group's history, and the last value of a bucket is carried over
    to the next one by a lag over one summary row per (group, bucket). ``bucket``:
    * ``"range"`` (default without groups): ranges of the values themselves, sampled to be of one size, however
      dense a day is; there are as many summary rows as ranges. The ranges are written once, as sampling twice might
      cut them elsewhere;
    * ``"day"`` (default with groups), ``"hour"``: calendar buckets; the summary is bounded by the time span.
    """
    keys = list(partition_by)
    bucket = bucket or ("day" if keys else "range")
    # buckets are computed on the NTZ wall clock: no time zone involved
    d = df.select(*keys, F.col(ts).alias("_t")).filter(F.col("_t").isNotNull()).distinct()
    if bucket == "range":
        # more ranges than tasks, so that their hashes spread evenly
        ranges = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        d = materialize(d.repartitionByRange(ranges, *keys, "_t").withColumn("_b", F.spark_partition_id()), "ranges")
    elif bucket == "day":
        d = d.withColumn("_b", F.to_date("_t"))
    elif bucket == "hour":
        d = d.withColumn("_b", hour_floor(F.col("_t").cast("timestamp_ntz")))
    else:
        raise ValueError(bucket)
    inner = d.withColumn("_p", F.lag("_t").over(Window.partitionBy(*keys, "_b").orderBy("_t")))
    edges = d.groupBy(*keys, "_b").agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"))
    edge_w = Window.partitionBy(*keys).orderBy("_b") if keys else Window.orderBy("_b")
    edges = edges.select(*keys, "_b", "_first", F.lag("_last").over(edge_w).alias("_prev_last"))
    g = (inner.join(edges, [*keys, "_b"], "left")
         .withColumn("_p", F.when(F.col("_t") == F.col("_first"), F.col("_prev_last")).otherwise(F.col("_p"))))
    gap = seconds_between(F.col("_t"), F.col("_p"))
    return (g.filter(F.col("_p").isNotNull() & (gap > F.lit(float(max_gap_seconds))))
            .select(*keys, F.col("_t").alias(ts), F.col("_p").alias("prev_timestamp"), gap.alias("gap_seconds")))


class KeptCounts:
    """Rows per key of a table that runs append to, kept beside it, so that the duplicate, unique and completeness
    checks after a run cost what the run brought and not what the table holds.

    ``columns``: their non-null values are counted too. Without keys the whole table is one key. Keys with a
    ``timestamp_utc`` are kept by event date, and a run reads the counts of its dates only. A retried run counts once.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = (), columns: Sequence[str] = ()):
        self.keys, self.columns = list(keys) or ["_all"], list(columns)
        self.by_day = "timestamp_utc" in self.keys
        self.log = KeyedLog(spark, root, self.keys, ("event_date",) if self.by_day else (), merge_schema=False, newest="run")

    def add(self, rows: DataFrame, run: int) -> None:
        if self.keys == ["_all"]:
            rows = rows.withColumn("_all", F.lit(True))
        named = {"_n": F.count(F.lit(1)), **{f"_n_{c}": F.count(F.col(c)) for c in self.columns}}
        new = materialize(rows.groupBy(*self.keys).agg(*[c.alias(n) for n, c in named.items()]), "counts")
        days = None
        if self.by_day:
            days = [r.d for r in new.select(F.to_date("timestamp_utc").alias("d")).distinct().collect()]
        old = self.log.current(days=days, before=run)
        if old is not None:
            same = [F.col(f"new.{k}").eqNullSafe(F.col(f"old.{k}")) for k in self.keys]
            new = new.alias("new").join(old.alias("old"), same, "left").select(
                *(F.col(f"new.{k}").alias(k) for k in self.keys),
                *((F.col(f"new.{n}") + F.coalesce(F.col(f"old.{n}"), F.lit(0))).alias(n) for n in named))
        self.log.append(new, run)

    def duplicates(self, count_col: str = "record_count") -> DataFrame | None:
        """Keys with more than one row."""
        now = self.log.current()
        return None if now is None else now.filter(F.col("_n") > 1).select(*self.keys, F.col("_n").alias(count_col))

    def incomplete(self, col: str, threshold: float = 0.8) -> DataFrame | None:
        """As ``check_completeness`` over all rows so far."""
        now = self.log.current()
        if now is None:
            return None
        ratio = F.try_divide(F.sum(f"_n_{col}").cast("double"), F.sum("_n").cast("double"))
        return now.agg(ratio.alias("completeness_ratio")).filter(F.col("completeness_ratio") < F.lit(threshold))


class KeptFailures:
    """Rows of a keyed log that fail checks now, kept beside it: a run costs what it wrote, reading costs what fails.

    ``log``: a table with hours whose later runs win. ``checks``: (suite, check name, predicate that is TRUE on a failing
    row). ``view`` makes the checked rows of the log's rows (the mart of its states); they keep the log's keys. After each
    run, retried or not, ``follow`` asks the checks of what its newest attempt wrote. A key recorded before that fails
    no more, or left the table, gets a delete mark.
    """

    def __init__(self, log: KeyedLog, root: str, checks: Iterable[tuple[str, str, Column]], view=None):
        if log.newest != "run":
            raise ValueError("a load may lose to an earlier run's: its failures would replace those of the rows that stay")
        self.table, self.checks, self.view = log, list(checks), view
        self.log = KeyedLog(log.spark, root, log.keys, ("event_date",), merge_schema=False, newest="run")

    def follow(self, run: int) -> None:
        wrote = self.table.written_by(run)
        if wrote is None:
            return
        keys, live = self.table.keys, wrote.filter(~F.col("_gone")).drop("_gone")
        found = F.array(*[F.when(pred, F.struct(F.lit(suite).alias("suite"), F.lit(name).alias("check_name")))
                          for suite, name, pred in self.checks])
        live = (live if self.view is None else self.view(live)).select(*keys, F.filter(found, lambda x: x.isNotNull()).alias("failed"))
        marks = wrote.filter("_gone").select(*keys, F.array().cast(live.schema["failed"].dataType).alias("failed"))
        rows = materialize(live.unionByName(marks), "failed")
        days = [r.d for r in rows.select(F.to_date("timestamp_utc").alias("d")).distinct().collect()]
        known, gone = self.log.rows(days), None
        if known is not None:
            cleared = rows.filter(F.size("failed") == 0).select(*keys).distinct().alias("cleared")
            same = [F.col(f"cleared.{k}").eqNullSafe(F.col(f"known.{k}")) for k in keys]
            gone = cleared.join(known.select(*keys).distinct().alias("known"), same, "left_semi")
        self.log.append(rows.filter(F.size("failed") > 0), run, gone=gone)

    def failures(self) -> DataFrame | None:
        """``suite, check_name`` and the keys, a row for each failing row and check; None before any failed."""
        now = self.log.current()
        return None if now is None else now.select(F.explode("failed").alias("f"), *self.table.keys).select("f.*", *self.table.keys)


# ------------------------------------------------------------------------------------------ suites
def check_suite(df: DataFrame, checks: Iterable[Check], cols: Sequence[str] | None = None) -> DataFrame:
    """Tagged failing rows of many row-level checks, one scan: (check_name, cols...)."""
    checks = list(checks)
    tags = F.filter(F.array(*[F.when(pred, F.lit(name)) for name, pred in checks]), lambda x: x.isNotNull())
    keep = [F.col(c) for c in (cols if cols is not None else df.columns)]
    return df.select(F.explode(tags).alias("check_name"), *keep)


def suite_summary(failures: DataFrame) -> DataFrame:
    return failures.groupBy("check_name").agg(F.count(F.lit(1)).alias("failures"))


def station_checks() -> list[Check]:
    return [
        ("null_geometry", F.col("geometry").isNull()),
        ("null_wmo_station_id", F.col("wmo_station_id").isNull()),
        ("null_station_name", F.col("station_name").isNull()),
        ("invalid_wmo_station_id_format", not_digits("wmo_station_id")),
    ]


def postal_checks() -> list[Check]:
    return [
        ("null_geometry", F.col("geometry").isNull()),
        ("null_postal_codes", F.col("plz").isNull()),
        ("invalid_postal_code_format", not_digits("plz", 5)),
        ("postal_codes_out_of_range", F.col("plz").isNotNull()
         & ((F.col("plz").try_cast("int") < 1000) | (F.col("plz").try_cast("int") > 99999))),
    ]


def _bounds(measure: str) -> Column:
    m = spec.BY_NAME[measure]
    return outside(measure, m.lo, m.hi)


# Check names are fixed values: they are output values.
def observed_checks() -> list[Check]:
    return [
        ("temperature_out_of_range", _bounds("temperature")),
        ("negative_precipitation", negative("precipitation")),
        ("negative_wind_speed", negative("wind_speed")),
        ("wind_direction_out_of_range", _bounds("wind_direction")),
        ("humidity_out_of_range", _bounds("relative_humidity")),
        ("pressure_out_of_range", _bounds("pressure_msl")),
        ("confidence_score_out_of_range", outside("confidence_score", 0, 1)),
    ]


def forecast_checks() -> list[Check]:
    return [*observed_checks(),
            ("precipitation_probability_out_of_range", _bounds("precipitation_probability")),
            ("precipitation_probability_6h_out_of_range", _bounds("precipitation_probability_6h"))]


def _min_gt_max(a: str, b: str) -> Column:
    return F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) > F.col(b))


def mart_checks() -> list[Check]:
    return [
        ("non_positive_station_count", F.col("station_count") <= 0),
        ("temperature_min_greater_than_max", _min_gt_max("temperature_min", "temperature_max")),
        ("negative_precipitation_sum", negative("precipitation_sum")),
        ("negative_wind_speed_max", negative("wind_speed_max")),
        ("pressure_min_greater_than_max", _min_gt_max("pressure_msl_min", "pressure_msl_max")),
        ("humidity_min_greater_than_max", _min_gt_max("relative_humidity_min", "relative_humidity_max")),
        ("visibility_min_greater_than_max", _min_gt_max("visibility_min", "visibility_max")),
        ("negative_solar_max", negative("solar_max")),
        ("negative_sunshine_max", negative("sunshine_max")),
        ("negative_wind_gust_speed_max", negative("wind_gust_speed_max")),
        ("negative_outlier_count", negative("outlier_count")),
        ("invalid_postal_code_format", not_digits("plz", 5)),
        ("confidence_score_avg_out_of_range", outside("confidence_score_avg", 0, 1)),
    ]


def with_presence(child: DataFrame, parents: Iterable[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """``child`` with a flag per parent (flag name, parent, child key, parent key): is its key there? One join each on
    the distinct keys (broadcast where they are small, split where a key is skewed), instead of an anti-join and scan a check."""
    for flag, parent, key, parent_key in parents:
        keys = parent.select(F.col(parent_key).alias(f"_{flag}")).filter(F.col(f"_{flag}").isNotNull()).distinct()
        child = child.join(keys.withColumn(flag, F.lit(True)), F.col(key) == F.col(f"_{flag}"), "left").drop(f"_{flag}")
        child = child.withColumn(flag, F.coalesce(flag, F.lit(False)))
    return child


def link_suite(link: DataFrame, dim_st: DataFrame, dim_area: DataFrame) -> DataFrame:
    flagged = with_presence(link, [("_st", dim_st, "station_id", "id"), ("_ar", dim_area, "postal_area_id", "id")])
    return check_suite(flagged, [("null_station_ids", F.col("station_id").isNull()),
                                 ("null_postal_area_ids", F.col("postal_area_id").isNull()),
                                 ("null_created_at", F.col("created_at").isNull()),
                                 ("invalid_station_ids", ~F.col("_st")), ("invalid_postal_area_ids", ~F.col("_ar"))], link.columns)


def _tagged_keys(df: DataFrame, checks: Iterable[tuple[str, Column, str, str]]) -> DataFrame:
    """(check_name, key1, key2) of every check (name, predicate, the two reported keys) a row fails, in one pass."""
    found = F.array(*[F.when(pred, F.struct(F.lit(name).alias("check_name"), F.col(k1).cast("string").alias("key1"),
                                            F.col(k2).cast("string").alias("key2"))) for name, pred, k1, k2 in checks])
    return df.select(F.explode(F.filter(found, lambda x: x.isNotNull())).alias("f")).select("f.*")


# Check names are fixed values.
def integrity_suite(stg_obs: DataFrame, stg_fc: DataFrame, stg_st: DataFrame, mart_fc: DataFrame,
                    link: DataFrame, dim_st: DataFrame, dim_area: DataFrame, as_of: str,
                    future_days: int = 7, past_days: int = 30) -> DataFrame:
    """Cross-model integrity: (check_name, key1, key2) with keys as text (the reference's union mixes
    text and bigint keys and cannot compile; this keeps its intent). Each of the four checked tables is read once: its
    rows get the presence flags of their keys, and all its checks are asked of the row."""
    now = F.lit(as_of).cast("timestamp_ntz")
    hour, area = ("wmo_station_id", "timestamp_utc"), ("plz", "timestamp_utc")
    observed = with_presence(stg_obs.select(*hour), [("_st", stg_st, "wmo_station_id", "wmo_station_id")])
    forecast = with_presence(stg_fc.select(*hour), [("_st", stg_st, "wmo_station_id", "wmo_station_id")])
    mart = with_presence(mart_fc.select(*area, "station_count"), [("_ar", dim_area, "plz", "plz")])
    linked = with_presence(link.select("postal_area_id", "station_id"),
                           [("_ar", dim_area, "postal_area_id", "id"), ("_st", dim_st, "station_id", "id")])
    parts = [
        _tagged_keys(observed, [
            ("weather_observed_invalid_station_ids", ~F.col("_st"), *hour),
            ("observed_timestamps_too_old", F.col("timestamp_utc") < F.timestamp_add("DAY", F.lit(-past_days), now), *hour)]),
        _tagged_keys(forecast, [
            ("weather_forecast_invalid_station_ids", ~F.col("_st"), *hour),
            ("forecast_timestamps_too_far_future", F.col("timestamp_utc") > F.timestamp_add("DAY", F.lit(future_days), now), *hour)]),
        _tagged_keys(mart, [
            ("aggregated_invalid_postal_codes", ~F.col("_ar"), *area),
            ("aggregated_unreasonable_station_counts", (F.col("station_count") < 1) | (F.col("station_count") > 100), *area)]),
        _tagged_keys(linked, [
            ("link_table_invalid_postal_area_ids", ~F.col("_ar"), "postal_area_id", "station_id"),
            ("link_table_invalid_station_ids", ~F.col("_st"), "station_id", "postal_area_id")]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# The column tests declared for each table, as table: {column: tests}. A ``range`` is 0 to 1.
# The fact tables have no postal code of their own; its test holds their area id.
_WEATHER_TESTS = {"wmo_station_id": ["not_null"], "timestamp_utc": ["not_null"], "load_dts": ["not_null"]}
_RAW_TESTS = {**_WEATHER_TESTS, "raw": ["not_null"]}
_STAGED_TESTS = {**_WEATHER_TESTS, "confidence_score": ["range"]}
_FACT_TESTS = {**_STAGED_TESTS, "station_id": ["not_null"], "postal_area_id": ["not_null"]}
_MART_TESTS = {"plz": ["not_null"], "timestamp_utc": ["not_null"], "station_count": ["not_null"],
               "data_completeness": ["range"], "confidence_score_avg": ["range"]}
DECLARED_TESTS: dict[str, dict[str, list[str]]] = {
    "raw_observed": _RAW_TESTS,
    "raw_forecast": _RAW_TESTS,
    "station_raw": {"wmo_station_id": ["not_null"], "station_name": ["not_null"], "lat": ["not_null"], "lon": ["not_null"],
                    "load_dts": ["not_null"]},
    "postal_raw": {"plz": ["not_null"], "geometry": ["not_null"], "load_dts": ["not_null"]},
    "dim_postal_area": {"plz": ["not_null", "unique"], "geometry": ["not_null"]},
    "dim_station": {"id": ["not_null", "unique"], "wmo_station_id": ["not_null", "unique"], "station_name": ["not_null"],
                    "geometry": ["not_null"]},
    "link": {"postal_area_id": ["not_null", "unique"], "station_id": ["not_null"], "created_at": ["not_null"]},
    "fact_observed": _FACT_TESTS,
    "fact_forecast": _FACT_TESTS,
    "stg_observed": _STAGED_TESTS,
    "stg_forecast": _STAGED_TESTS,
    "mart_observed": _MART_TESTS,
    "mart_forecast": _MART_TESTS,
}


def _row_tests(tests: dict[str, list[str]]) -> list[Check]:
    return [(f"{test}_{c}", F.col(c).isNull() if test == "not_null" else outside(c, 0, 1))
            for c, kinds in tests.items() for test in kinds if test != "unique"]


def row_checks(table: str) -> list[tuple[str, str, Column]]:
    """(suite, check name, predicate) of all checks that ask one row of a staged, fact or mart table."""
    suites = {"stg_observed": ("observed", observed_checks()), "stg_forecast": ("forecast", forecast_checks()),
              "mart_observed": ("mart_observed", mart_checks()), "mart_forecast": ("mart_forecast", mart_checks())}
    suite, checks = suites.get(table, ("", []))
    return [*((suite, name, pred) for name, pred in checks),
            *((f"declared_{table}", name, pred) for name, pred in _row_tests(DECLARED_TESTS[table]))]


def declared_failures(df: DataFrame, tests: dict[str, list[str]], key1: str, key2: str) -> DataFrame:
    """Failures of one table's column tests: ``check_name, key1, key2``. Null and range tests share a scan; a
    value that is not unique is reported once, as ``key1`` with its count as ``key2``."""
    out = _keyed(check_suite(df, _row_tests(tests), list(dict.fromkeys((key1, key2)))), key1, key2)
    for c, kinds in tests.items():
        if "unique" in kinds:
            repeated = check_unique(df.select(c), c).withColumn("check_name", F.lit(f"unique_{c}"))
            out = out.unionByName(_keyed(repeated, c, "n_records"))
    return out


def _keyed(failures: DataFrame, key1: str, key2: str) -> DataFrame:
    return failures.select("check_name", F.col(key1).cast("string").alias("key1"), F.col(key2).cast("string").alias("key2"))


# the two columns that name a failing row
KEY_COLUMNS = {"raw_observed": ("wmo_station_id", "timestamp_utc"), "raw_forecast": ("wmo_station_id", "timestamp_utc"),
               "station_raw": ("wmo_station_id", "load_dts"), "postal_raw": ("plz", "load_dts"),
               "stg_station": ("wmo_station_id", "station_name"), "stg_postal_area": ("plz", "load_dts"),
               "dim_postal_area": ("id", "plz"), "dim_station": ("id", "wmo_station_id"),
               "link": ("postal_area_id", "station_id"),
               "fact_observed": ("wmo_station_id", "timestamp_utc"), "fact_forecast": ("wmo_station_id", "timestamp_utc"),
               "stg_observed": ("wmo_station_id", "timestamp_utc"), "stg_forecast": ("wmo_station_id", "timestamp_utc"),
               "mart_observed": ("plz", "timestamp_utc"), "mart_forecast": ("plz", "timestamp_utc")}


def dimension_failures(t: dict[str, DataFrame]) -> DataFrame:
    """As ``all_failures``, of the tables that a run rebuilds: stations, areas and their link."""
    suites = {"station": ("stg_station", station_checks()), "postal": ("stg_postal_area", postal_checks())}
    parts = [(name, _keyed(check_suite(t[table], checks, KEY_COLUMNS[table]), *KEY_COLUMNS[table]))
             for name, (table, checks) in suites.items()]
    parts.append(("link", _keyed(link_suite(t["link"], t["dim_station"], t["dim_postal_area"]), *KEY_COLUMNS["link"])))
    parts += [(f"declared_{table}", declared_failures(t[table], DECLARED_TESTS[table], *KEY_COLUMNS[table]))
              for table in ("dim_postal_area", "dim_station", "link")]
    return _named(parts)


def _named(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    out = None
    for name, failures in parts:
        named = failures.select(F.lit(name).alias("suite"), "check_name", "key1", "key2")
        out = named if out is None else out.unionByName(named)
    return out


def all_failures(t: dict[str, DataFrame], as_of: str) -> DataFrame:
    """Failing rows of every suite and declared test over a run's tables (named as in ``KEY_COLUMNS``):
    ``suite, check_name, key1, key2``."""
    suites = {"station": ("stg_station", station_checks()), "postal": ("stg_postal_area", postal_checks()),
              "observed": ("stg_observed", observed_checks()), "forecast": ("stg_forecast", forecast_checks()),
              "mart_observed": ("mart_observed", mart_checks()), "mart_forecast": ("mart_forecast", mart_checks())}
    parts = [(name, _keyed(check_suite(t[table], checks, KEY_COLUMNS[table]), *KEY_COLUMNS[table]))
             for name, (table, checks) in suites.items()]
    parts.append(("link", _keyed(link_suite(t["link"], t["dim_station"], t["dim_postal_area"]), *KEY_COLUMNS["link"])))
    parts.append(("integrity", integrity_suite(t["stg_observed"], t["stg_forecast"], t["stg_station"], t["mart_forecast"],
                                               t["link"], t["dim_station"], t["dim_postal_area"], as_of)))
    parts += [(f"declared_{table}", declared_failures(t[table], tests, *KEY_COLUMNS[table]))
              for table, tests in DECLARED_TESTS.items()]
    return _named(parts)


def store_failures(failures: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Persist failing rows partitioned by check; the rows of all checks of an earlier write are replaced. Without
    any failure the folder holds no data file: read it with ``read_failures``."""
    (failures.write.mode(mode).option("partitionOverwriteMode", "static")
     .partitionBy("check_name").parquet(path))
    return os.path.abspath(path) if "://" not in path else path


def read_failures(failures: DataFrame, path: str) -> DataFrame:
    """What ``store_failures`` wrote of ``failures``, also where that is no row."""
    return failures.sparkSession.read.schema(failures.schema).parquet(path).select(*failures.columns)
